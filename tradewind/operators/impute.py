"""Filling missing amounts from a group's typical ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio, round_to
from tradewind.operators.quantiles import exact_quantiles
from tradewind.scale import materialize


def fill_by_median_ratio(df: DataFrame, num: str, den: str, group: str, places: int = 2) -> DataFrame:
    """Null ``num`` becomes ``round(median(num/den of the group) * den, places)``.

    A group without any known ratio uses the overall median. ``group`` must come
    from a fixed vocabulary (canonical names plus a default), so the medians are
    a handful of rows: they are written once and may be broadcast without a check.
    """
    kind = df.schema[num].dataType
    known = df.select(group, ratio(F.col(num), F.col(den)).alias("_r"))
    medians = materialize(exact_quantiles(known, "_r", [0.5], group), "medians")
    by_group = medians.where("not is_total").select(F.col("group").alias("_g"), F.col("q")[0].alias("_group_median"))
    overall = medians.where("is_total").select(F.col("q")[0]).scalar()
    typical = F.coalesce(F.col("_group_median"), overall)
    filled = round_to(typical * F.col(den).cast("double"), places).cast(kind)
    joined = df.join(F.broadcast(by_group), F.col(group).eqNullSafe(F.col("_g")), "left")
    return joined.select(*[
        F.coalesce(F.col(num), filled).alias(num) if c == num else F.col(c) for c in df.columns])
