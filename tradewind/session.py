"""SparkSession settings the package expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins, merges small shuffle partitions and splits skewed ones.
# forceOptimizeSkewedJoin keeps the split even where it costs another exchange:
# a key that holds a third of the rows is worse than one more shuffle.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sets of months or incidents are small: keep grouping by hash until a task holds many groups
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # A task's memory is that of its rows in sorts and hash tables, ten to twenty times their compressed bytes: these keep a
    # task's share of a scan or an exchange at about half a million rows, whatever the size of the tables.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # a join's side whose measured partitions are all below this is hashed, which spares sorting both sides
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with CONF applied; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # exports run side by side, a pool each
    builder = builder.config("spark.scheduler.mode", "FAIR")
    # recording the caller's line for every column expression makes building large plans slow
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set CONF on a session somebody else built (all entries are runtime settings)."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark
