"""Shared results: one build per state of the inputs."""

import os
import shutil

from pyspark.sql import functions as F

from tradewind import registry
from tradewind.store import file_state, shared


def counted(build):
    calls = []

    def run():
        calls.append(1)
        return build()

    return run, calls


def folder(spark, path, n):
    spark.range(n).withColumn("v", F.col("id") % 7).repartition(2).write.mode("overwrite").parquet(str(path))
    return str(path)


def test_same_inputs_are_built_once_and_changed_files_again(spark, tmp_path):
    path = folder(spark, tmp_path / "in", 100)

    def inputs():
        return [spark.read.parquet(path).where("v < 5")]

    build, calls = counted(lambda: inputs()[0].groupBy("v").count())
    first = sorted(map(tuple, shared("sums", inputs(), build).collect()))
    assert sorted(map(tuple, shared("sums", inputs(), build).collect())) == first and len(calls) == 1
    # another parameter, another meaning, another label: another entry
    shared("sums", inputs(), build, 3)
    shared("sums", [spark.read.parquet(path).where("v < 6")], build)
    shared("other", inputs(), build)
    assert len(calls) == 4
    # a file more; then one file rewritten
    spark.range(5).withColumn("v", F.col("id") % 7).coalesce(1).write.mode("append").parquet(path)
    assert sum(r["count"] for r in shared("sums", inputs(), build).collect()) == sum(c for _, c in first) + 5
    assert len(calls) == 5
    state = file_state(spark, inputs())
    part = next(os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
    stat = os.stat(part)
    os.utime(part, ns=(stat.st_atime_ns, stat.st_mtime_ns + 5_000_000_000))
    assert file_state(spark, inputs()) != state
    shared("sums", inputs(), build)
    assert len(calls) == 6


def test_entries_whose_files_are_gone_are_built_again(spark, tmp_path):
    path = folder(spark, tmp_path / "in", 10)
    build, calls = counted(lambda: spark.read.parquet(path).groupBy("v").count())
    shared("gone", [spark.read.parquet(path)], build)
    kept = shared("gone", [spark.read.parquet(path)], build).inputFiles()[0]
    shutil.rmtree(os.path.dirname(kept.removeprefix("file://")))
    assert shared("gone", [spark.read.parquet(path)], build).count() == 7 and len(calls) == 2


def test_inputs_without_files_are_told_apart_by_content(spark):
    def local(value):
        return spark.createDataFrame([(value,)], "v long")

    build, calls = counted(lambda: spark.range(1))
    one = local(1)
    shared("local", [one], build)
    shared("local", [one], build)
    shared("local", [local(2)], build)
    assert len(calls) == 2


def test_second_groundedness_score_skips_the_evidence(spark, sf_dir, tmp_path, monkeypatch):
    tables = tmp_path / "tables"
    tables.mkdir()
    for name in os.listdir(sf_dir):
        shutil.copy(os.path.join(sf_dir, name), tables / name)
        os.chmod(tables / name, 0o644)
    calls = []
    original = registry.pipeline.gather_evidence
    monkeypatch.setattr(registry.pipeline, "gather_evidence", lambda m: calls.append(1) or original(m))

    def score():
        return sorted(map(str, registry.QUERIES["groundedness_score"](spark, str(tables)).collect()))

    first = score()
    assert score() == first and len(calls) == 1
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").limit(700).coalesce(1)
    orders.write.parquet(str(tmp_path / "fewer"))
    part = next(f for f in os.listdir(tmp_path / "fewer") if f.endswith(".parquet"))
    shutil.copy(tmp_path / "fewer" / part, tables / "orders.parquet")
    spark.catalog.clearCache()
    score()
    assert len(calls) == 2
