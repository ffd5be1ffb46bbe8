"""Create-or-replace loading of tables and their row counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Facts that are joined on order_id are bucketed on it, so the order-grain joins need no exchange.
BUCKETED = {"orders": "order_id", "order_items": "order_id", "payments": "order_id", "returns": "order_id"}


def load_tables(tables: Mapping[str, DataFrame], database: str = "raw", buckets: int | None = None,
                location: str | None = None) -> None:
    """Replace ``database.<name>`` by each frame; ``buckets`` clusters the order-grain tables.

    ``location`` is where a database that does not exist yet keeps its tables.
    """
    where = f" location '{location}'" if location else ""
    for name, df in tables.items():
        df.sparkSession.sql(f"create database if not exists {database}{where}")
        writer = df.write.mode("overwrite").format("parquet")
        if buckets and name in BUCKETED:
            writer = writer.bucketBy(buckets, BUCKETED[name]).sortBy(BUCKETED[name])
        writer.saveAsTable(f"{database}.{name}")


def read_tables(spark: SparkSession, names: list[str], database: str = "raw") -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table in one job."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
