"""A gap-free global row number that no single task has to produce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.scale import materialize

_IN_PARTITION = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "row_number") -> DataFrame:
    """1..n in ``order``; make the order total by ending it with a unique key.

    Spark's range-partitioned sort places the rows, each task numbers its own
    run, and the runs are offset by the sizes of those before them. Ties on the
    leading column are split by the unique key, so one value held by a third of
    the rows still spreads over many tasks. The sorted rows are written once,
    which keeps run and place together if a task is repeated.
    """
    placed = materialize(
        df.orderBy(*order)
        .withColumn("_run", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))),
        "sorted")
    runs = placed.groupBy("_run").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_run", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # one row per sort partition, so never more than spark.sql.shuffle.partitions rows
    return (placed.join(F.broadcast(offsets), "_run")
            .withColumn(out, F.col("_before") + F.col("_place") + 1)
            .drop("_run", "_place", "_before"))
