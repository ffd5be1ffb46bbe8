"""Benchmark decontamination: SimHash windows of an item's size, a multi-index over Hamming blocks, exact verification.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; shingles are five words. For an item of n words
every window of n words of every text counts (the whole text where it is shorter). A window matches an item if the weighted
Jaccard similarity of their shingle multisets is 0.8 or more.

Two windows that similar share eight ninths of their shingles, so windows with fewer of any item's shingles are
skipped by a running count first; that loses nothing. The others get a SimHash. Item fingerprints are indexed by
eight blocks of eight bits: within a radius of 24 bits some block differs in three bits at most, and the index lists each item
under all those values, so no fingerprint within the radius is missed. At the similarity limit fingerprints differ in ten bits
on average with a deviation of three. Candidates within the radius are verified by the exact similarity.

The benchmark is a stated query set: it is read in blocks of bounded bytes, each block goes to all tasks and passes over all
documents. Nothing is shuffled but the best match per document and item. Null and empty texts, and items without words, match
nothing. Items of fewer than five words are one shingle of all their words. Rows with equal ids give one result per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import text as tx
from tradewind.llm.frames import keyed_texts, map_batches, quoted, rewrite_batches

U = np.uint64
SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCK_BITS, BLOCKS = 24, 8, 8
BLOCK_BYTES = 8 << 20
GATE_BITS = 20
SEGMENT = 4096
SCHEMA = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    data = tx.LOWER[data]
    starts, ends = tx.runs(tx.ALNUM[data], offsets)
    return tx.span_hashes(data, starts, ends), tx.row_of(starts, offsets)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    shared = sum((a & b).values())
    return shared / (a.total() + b.total() - shared)


def votes_of(shingles: np.ndarray) -> np.ndarray:
    """Running sums of the signed bits: entry i holds the votes of the first i shingles."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=out[1:])
    return out


def fingerprints(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view(U).ravel()


class SizeGroup:
    """Items of one number of words."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.count = len(items[0][1])
        self.multisets = [Counter(s.tolist()) for _, s in items]
        self.shingles = np.unique(np.concatenate([s for _, s in items]))
        self.fps = fingerprints(np.stack([votes_of(s)[-1] for _, s in items]))
        near = [v for v in range(1 << BLOCK_BITS) if v.bit_count() <= RADIUS // BLOCKS]
        self.index = np.zeros((BLOCKS, 1 << BLOCK_BITS, len(items)), bool)
        for k, fp in enumerate(self.fps.view(np.uint8).reshape(-1, BLOCKS)):
            for block in range(BLOCKS):
                self.index[block, fp[block] ^ np.array(near), k] = True

    def candidates(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) whose fingerprints are within the radius."""
        blocks = fps.view(np.uint8).reshape(-1, BLOCKS)
        listed = reduce(np.logical_or, (self.index[b, blocks[:, b]] for b in range(BLOCKS)))
        window, item = np.nonzero(listed)
        near = np.bitwise_count(fps[window] ^ self.fps[item]) <= RADIUS
        return window[near], item[near]


class Benchmark:
    """A block of items, indexed."""

    def __init__(self, items: list[tuple[int, str]]):
        groups: dict[tuple[int, int], list] = {}
        column = pa.array([t for _, t in items], pa.string())
        for lo, hi, data, offsets in tx.parts(column):
            hashes, row = word_hashes(data, offsets)
            edge = np.searchsorted(row, np.arange(hi - lo + 1))
            for k in range(hi - lo):
                words = hashes[edge[k]:edge[k + 1]]
                if len(words):
                    size = min(SHINGLE, len(words))
                    groups.setdefault((size, len(words)), []).append((items[lo + k][0], tx.shingle_hashes(words, size)))
        self.sizes: dict[int, list[tuple[int, SizeGroup]]] = {}
        for (size, words), members in sorted(groups.items()):
            self.sizes.setdefault(size, []).append((words, SizeGroup(members)))
        self.gates = {}
        for size, members in self.sizes.items():
            every = np.unique(np.concatenate([g.shingles for _, g in members]))
            gate = np.zeros(1 << GATE_BITS, bool)
            gate[(every >> U(64 - GATE_BITS)).astype(np.int64)] = True
            self.gates[size] = gate, every

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, item id, similarity, first word, words): the best window per row and item."""
        hashes, row = word_hashes(data, offsets)
        edge = np.searchsorted(row, np.arange(len(offsets)))
        for size, members in self.sizes.items():
            shingles = tx.shingle_hashes(hashes, size)
            gate, every = self.gates[size]
            hits = np.flatnonzero(gate[(shingles >> U(64 - GATE_BITS)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(every, shingles[hits]), len(every) - 1)
            hits = hits[every[slot] == shingles[hits]]
            hits = hits[row[hits] == row[hits + size - 1]]
            for r in np.unique(row[hits]).tolist():
                own = shingles[edge[r]:edge[r + 1] - size + 1]
                found: dict[int, tuple[float, int, int]] = {}
                seen = np.unique(own)
                for words, group in members:
                    if np.isin(group.shingles, seen, assume_unique=True).any():
                        for item, score, first, n in windows(own, group, size):
                            if score > found.get(item, (0.0, 0, 0))[0]:
                                found[item] = score, first, n
                for item, (score, first, n) in found.items():
                    yield r, item, score, first, n


def windows(own: np.ndarray, group: SizeGroup, size: int) -> Iterator[tuple[int, float, int, int]]:
    """(item id, similarity, first word, words) of the matching windows of a text's shingles."""
    width = min(group.count, len(own))
    need = math.ceil(SIMILARITY / (1 + SIMILARITY) * (width + group.count) - 1e-9)
    known = np.concatenate([[0], np.cumsum(np.isin(own, group.shingles))])
    starts = np.flatnonzero(known[width:] - known[:-width] >= need)
    for lo in range(0, len(starts), SEGMENT):
        some = starts[lo:lo + SEGMENT]
        for run in np.split(some, np.flatnonzero(np.diff(some) > width) + 1):  # votes only where windows are
            votes = votes_of(own[run[0]:run[-1] + width])
            at = run - run[0]
            window, item = group.candidates(fingerprints(votes[at + width] - votes[at]))
            for w, i in zip(run[window].tolist(), item.tolist(), strict=True):
                score = similarity(Counter(own[w:w + width].tolist()), group.multisets[i])
                if score >= SIMILARITY:
                    yield group.ids[i], score, w, width + size - 1


def benchmark_blocks(benchmark: DataFrame, item_col: str, item_text_col: str) -> list:
    """Broadcasts of the items, each of about BLOCK_BYTES whatever the tables' sizes."""
    items = benchmark.select(quoted(item_col).cast("long").alias("item_id"), quoted(item_text_col).cast("string").alias("text"))
    items = items.where("text is not null")
    blocks = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast([(r.item_id, r.text) for r in items.where(block == b).collect()]) for b in range(blocks)]


class Searcher:
    """An index that a task builds from its broadcast when first used."""

    def __init__(self, source):
        self.source, self.index = source, None

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
        """(row of the column, item id, similarity, first word, words)."""
        self.index = self.index or Benchmark(self.source.value)
        for lo, _, data, offsets in tx.parts(column):
            for row, *rest in self.index.matches(data, offsets):
                yield lo + row, *rest


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best window of every document and item that match."""
    texts = keyed_texts(docs, id_col, text_col)

    def search(source):
        searcher = Searcher(source)

        def run(batch):
            found = list(searcher.matches(batch.column(1)))
            if found:
                row, item, score, first, n = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                     pa.array(first, pa.int64()), pa.array(n, pa.int64())], [c.split(" ")[0] for c in SCHEMA.split(", ")])

        return map_batches(texts, run, SCHEMA)

    found = reduce(DataFrame.unionByName, [search(s) for s in benchmark_blocks(benchmark, item_col, item_text_col)])
    best = F.max_by(F.struct("similarity", "first_word", "n_words"), F.struct("similarity", -F.col("first_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that match no item, columns unchanged; each row is judged by its own text."""
    place = docs.columns.index(text_col)
    for source in benchmark_blocks(benchmark, item_col, item_text_col):
        searcher = Searcher(source)

        def run(batch, searcher=searcher):
            clean = np.ones(batch.num_rows, bool)
            for found in searcher.matches(batch.column(place).cast(pa.string())):
                clean[found[0]] = False
            yield batch.filter(pa.array(clean))

        docs = rewrite_batches(docs, run)
    return docs
