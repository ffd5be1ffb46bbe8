"""Shared scratch storage for results that are read more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where none is named, one in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder, unique per call."""
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/tradewind/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Unlike ``checkpoint()`` the copy stays columnar, so later readers still get
    column pruning, filter pushdown and size statistics. It survives executor
    loss because the folder is shared.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
