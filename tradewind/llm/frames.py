"""Small shared parts of the operators: inputs, scratch copies, row mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) and nothing else, so that no other column can clash."""
    return df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def rewrite_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Like ``map_batches`` where ``fn`` keeps the columns; it finds them by place, so any names will do."""
    placed = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return map_batches(placed, fn, placed.schema).toDF(*df.columns)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the session names; where it names none, in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{folder.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: later steps neither repeat the work nor depend on an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
