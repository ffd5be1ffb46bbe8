"""Detector scoring against labelled incident windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio
from tradewind.sources.seeds import fixed_rows

SWEEP = (3.0, 3.5, 4.0, 4.5, 5.0)


def incident_days(spark: SparkSession, windows: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(incident, date): one row per labelled day."""
    rows = fixed_rows(spark, windows, ("incident", "lo", "hi"))
    span = F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"), F.expr("interval 1 day"))
    return rows.select("incident", F.explode(span).alias("date"))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def score_detectors(days: DataFrame, incidents: DataFrame, detector: str = "detector") -> DataFrame:
    """Counts, precision, recall, F1 and caught incidents per detector.

    ``days`` has (detector, date, flagged) for every observed day. One join with
    the labels and one aggregation, for any number of detectors.
    """
    truth = incidents.groupBy("date").agg(F.sort_array(F.collect_set("incident")).alias("_in"))
    labelled = truth.agg(F.count("*")).scalar()
    hit = F.col("flagged") & F.col("_in").isNotNull()
    per = days.join(truth, "date", "left").groupBy(detector).agg(
        F.count_if("flagged").alias("flagged"),
        F.count_if(hit).alias("tp"),
        F.count_if(F.col("flagged") & F.col("_in").isNull()).alias("fp"),
        F.flatten(F.collect_set(F.when(F.col("flagged"), F.col("_in")))).alias("_caught"))
    names = incidents.agg(F.sort_array(F.collect_set("incident"))).scalar()
    per = per.withColumn("fn", labelled - F.col("tp")).withColumn("_names", names)
    per = per.withColumn("precision", _zero(ratio(F.col("tp"), F.col("flagged"))))
    per = per.withColumn("recall", _zero(ratio(F.col("tp"), F.col("tp") + F.col("fn"))))
    p, r = F.col("precision"), F.col("recall")
    caught = F.transform("_names", lambda n: F.concat(
        n, F.when(F.array_contains("_caught", n), F.lit(": yes")).otherwise(F.lit(": no"))))
    return per.select(detector, "flagged", "tp", "fp", "fn", "precision", "recall",
                      _zero(ratio(p * r * 2, p + r)).alias("f1"),
                      F.array_join(caught, ", ").alias("incidents_caught"))


def sweep_thresholds(days: DataFrame, incidents: DataFrame, z: str, thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """Score ``abs(z) > t`` for every threshold in one pass over the days."""
    each = days.select("date", F.col(z).alias("_z"),
                       F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    flagged = each.select("threshold", "date",
                          F.coalesce(F.abs("_z") > F.col("threshold"), F.lit(False)).alias("flagged"))
    return score_detectors(flagged, incidents, "threshold")
