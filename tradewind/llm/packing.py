"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A document is its token ids and an end id. Whole sequences are cut off its front; what remains joins a pool of
bounded size. A pool of S tokens gets ``S // size`` full sequences, and its last ``S % size`` tokens go to sequences of
power-of-two lengths, which need no padding. Documents are taken by descending length; each goes to the sequence of the lowest cost (linear
plus quadratic in the length of every piece, as attention costs) that has room for it whole. Those that fit nowhere are cut
to fill the gaps, so every sequence is full.

Pools stay inside the scan's tasks: nothing is shuffled, and a task holds one pool. Sequence ids are the task's number and a
counter, so a task that runs again gives the same ids. Null and empty texts are documents of the end id alone.
Rows with equal ids are separate documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tradewind.llm.frames import keyed_texts
from tradewind.llm.token_ids import encoder_source

POOL = 4096
BATCH_BYTES = 8 << 20
KINDS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
         "sequence_id": pa.int64(), "offset": pa.int64()}
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: (document, start, length, sequence, offset)
Piece = tuple[int, int, int, int, int]


def capacities(total: int, size: int) -> np.ndarray:
    """Lengths of sequences that hold ``total`` tokens without padding."""
    rest = total % size
    tail = [1 << b for b in reversed(range(size.bit_length())) if rest >> b & 1]
    return np.array([size] * (total // size) + tail, np.int64)


def assign(lengths: np.ndarray, size: int, linear: float, quadratic: float) -> list[Piece]:
    """Pieces of the pool's documents; sequences and documents are numbered from 0, starts are within a document's rest."""
    room = capacities(int(lengths.sum()), size)
    whole = room.copy()
    cost = np.zeros(len(room))
    pieces: list[Piece] = []
    left = []

    def put(doc, start, length, sequence):
        pieces.append((doc, start, length, sequence, int(whole[sequence] - room[sequence])))
        room[sequence] -= length
        cost[sequence] += linear * length + quadratic * length * length

    for doc in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[doc])
        fits = np.flatnonzero(room >= length)
        if len(fits):
            put(doc, 0, length, int(fits[np.argmin(cost[fits])]))
        else:
            left.append(doc)
    for doc in left:
        start, length = 0, int(lengths[doc])
        while start < length:
            sequence = int(np.argmax(room))
            part = min(int(room[sequence]), length - start)
            put(doc, start, part, sequence)
            start += part
    return pieces


def pack(df: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 0, linear: float = 1.0,
         quadratic: float = 1 / 1024, pool: int = POOL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document, the piece's place in it, its ids (unsigned 32-bit, little-endian), sequence and offset."""
    source = encoder_source(df.sparkSession, tokenizer_path)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, task = source.get(), TaskContext.get().partitionId() << 33
        sequences = 0
        docs, rests, tokens, before = [], [], [], []  # of the pool
        columns = [[] for _ in KINDS]  # of the pieces that are ready
        ready = 0

        def put(*piece):
            nonlocal ready
            for column, value in zip(columns, piece, strict=True):
                column.append(value)
            ready += 4 * piece[2]

        def batch_of():
            nonlocal ready
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS.values(), strict=True)], list(KINDS))
            for column in columns:
                column.clear()
            ready = 0
            return out

        def empty_pool():
            nonlocal sequences
            used = 0
            lengths = np.array([len(r) // 4 for r in rests], np.int64)
            for doc, start, length, sequence, offset in assign(lengths, size, linear, quadratic):
                put(docs[doc], before[doc] + start, length, rests[doc][4 * start:4 * (start + length)], tokens[doc],
                    task + sequences + sequence, offset)
                used = max(used, sequence + 1)
            sequences += used
            for held in (docs, rests, tokens, before):
                held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                count = len(ids) // 4
                cut = count // size * size
                for start in range(0, cut, size):
                    put(doc_id, start, size, ids[4 * start:4 * (start + size)], count, task + sequences, 0)
                    sequences += 1
                    if ready > BATCH_BYTES:
                        yield batch_of()
                if cut < count:
                    docs.append(doc_id)
                    rests.append(ids[4 * cut:])
                    tokens.append(count)
                    before.append(cut)
                if len(docs) >= pool:
                    empty_pool()
                    yield batch_of()
        empty_pool()
        if ready:
            yield batch_of()

    return keyed_texts(df, id_col, text_col).mapInArrow(run, SCHEMA)
