"""Results that several queries share, built once per state of their inputs.

An entry is found by what it was made from, not by its name alone: the recipe's label and parameters, the meaning of each input's plan
(Spark's semantic hash, then ``sameSemantics`` on the plans themselves, so a chance collision is no hit), and a fingerprint of every
input file (path, length, time of change), taken anew at each call. A changed, added or removed file, another folder or another
parameter makes another entry. Entries live in the scratch folder as long as the application; one whose files are gone is built again.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.scale import scratch_dir, scratch_path


@dataclass
class Entry:
    inputs: list[DataFrame]
    state: tuple
    path: str


_entries: dict[Hashable, list[Entry]] = {}


def file_state(spark: SparkSession, inputs: Sequence[DataFrame]) -> tuple:
    """Count, bytes and two order-free hashes of the inputs' files as they are now; their content is not read."""
    files = sorted({unquote(f) for df in inputs for f in df.inputFiles()})
    if not files:
        return ()
    listed = spark.read.format("binaryFile").load(files)
    one = F.xxhash64("path", "length", "modificationTime")
    two = F.hash("path", "length", "modificationTime")
    return tuple(listed.agg(F.count("*"), F.sum("length"), F.bit_xor(one), F.sum(two.cast("long"))).first())


def shared(label: str, inputs: Sequence[DataFrame], build: Callable[[], DataFrame], *params: Hashable) -> DataFrame:
    """The result of ``build``, written once for these inputs and parameters and read back by every later call."""
    spark = inputs[0].sparkSession
    key = (spark.sparkContext.applicationId, scratch_dir(spark), label, params, tuple(df.semanticHash() for df in inputs))
    state = file_state(spark, inputs)
    held = _entries.setdefault(key, [])
    for entry in list(held):
        if entry.state == state and all(a.sameSemantics(b) for a, b in zip(entry.inputs, inputs, strict=True)):
            try:
                return spark.read.parquet(entry.path)
            except AnalysisException:  # swept away meanwhile
                held.remove(entry)
    path = scratch_path(spark, label)
    build().write.parquet(path)
    held.append(Entry(list(inputs), state, path))
    return spark.read.parquet(path)
