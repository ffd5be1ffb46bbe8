"""Result writers: published sets of CSV tables, JSON evidence, text reports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.csv import write_csv

MANIFEST = "run string, table_name string, rows long, table_schema string, files array<string>, written_at timestamp"
AT_ONCE = 4  # tables that are written side by side


def export_csv(tables: Mapping[str, DataFrame], folder: str, order: Mapping[str, Sequence[str]] | None = None,
               at_once: int = AT_ONCE) -> dict[str, int]:
    """Publish a set of tables as header CSV under ``folder`` and return their row counts.

    Tables are written side by side, each as a job of its own pool, so that a small one does not wait for the tasks of a large one
    (with the fair scheduler; first come, first served without). Rows are counted while they are written. All files of a set lie in
    one new ``run-`` folder; the last step adds the set to the manifest: tables, rows, schemas and files. Readers go by the manifest
    (``published``), so a set counts as a whole or, if any table failed, not at all, and the set before stays as it was. Tables that
    ``order`` names are written sorted, file by file in the order of the file names.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    folder, run = folder.rstrip("/"), f"run-{uuid.uuid4().hex}"

    def write(name: str, df: DataFrame) -> tuple[str, int]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        seen = Observation(name)
        if order and name in order:
            df = df.orderBy(*order[name])
        write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder}/{run}/{name}")
        return name, seen.get["rows"]

    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(write), name, df) for name, df in tables.items()]
        done, late = wait(jobs, return_when=FIRST_EXCEPTION)
        for job in late:  # only where one failed
            job.cancel()
    counts = dict(job.result() for job in jobs if job in done)
    rows = []
    for name in tables:
        files = spark.read.text(f"{folder}/{run}/{name}").inputFiles()
        rows.append((run, name, counts[name], tables[name].schema.simpleString(), sorted(f.rsplit("/", 1)[1] for f in files)))
    manifest = spark.createDataFrame(rows, MANIFEST.rsplit(", ", 1)[0]).withColumn("written_at", F.current_timestamp())
    manifest.coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return counts


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of the last complete set's tables; empty where none was published."""
    folder = folder.rstrip("/")
    try:
        manifest = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException:
        return {}
    last = manifest.orderBy(F.desc("written_at"), F.desc("run")).limit(1).select("run")
    return {r.table_name: f"{folder}/{r.run}/{r.table_name}" for r in manifest.join(last, "run").collect()}


def write_lines(lines: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write ordered text lines as one text file; for reports of a few hundred lines."""
    lines.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row JSON document."""
    document.coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    """The document that ``write_document`` wrote; bounded as the evidence is."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)
