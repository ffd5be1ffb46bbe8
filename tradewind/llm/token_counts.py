"""Token counts of whole texts by a compiled finite-state tokenizer (see ``tokenizer_machine``).

Null and empty texts have no bytes and no tokens. Rows with equal ids stay separate rows. Special strings inside
a text count as their one token, as the library reads them by default.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm import text as tx
from tradewind.llm.frames import keyed_texts, map_batches
from tradewind.llm.tokenizer_machine import CompiledTokenizer


_compiled: dict[int, CompiledTokenizer] = {}


class _Source:
    """What travels to the tasks."""

    def __init__(self, broadcast):
        self.broadcast = broadcast

    def get(self) -> CompiledTokenizer:
        from tradewind.llm import token_counts as here  # the module of this worker, not a copy of its state

        key = hash(self.broadcast.value)
        if key not in here._compiled:
            here._compiled.clear()
            here._compiled[key] = CompiledTokenizer(self.broadcast.value)
        return here._compiled[key]


def tokenizer_source(spark, path: str) -> _Source:
    """A handle from which each Python worker compiles the tokenizer once; a tokenizer file's size doesn't follow the data."""
    with open(path, encoding="utf-8") as file:
        return _Source(spark.sparkContext.broadcast(file.read()))


def count_tokens(df: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    source = tokenizer_source(df.sparkSession, tokenizer_path)

    def run(batch):
        tokenizer = source.get()
        for lo, hi, data, offsets in tx.parts(batch.column(1)):
            tokens = tokenizer.count_tokens(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(keyed_texts(df, id_col, text_col), run,
                       "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
