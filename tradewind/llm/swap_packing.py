"""Best-fit packing of documents into as few sequences as it can, improved by swaps between underfull sequences.

A document is its token ids and an end id. Only documents longer than a sequence are cut: into full pieces, of which the
first may be shorter. Full pieces are sequences of their own and stay where they are. All other pieces are dealt by a hash of their
place into pools of about ``pool`` pieces, whatever their number, source or partition; a pool is packed by one task.

In a pool, pieces go by descending length to the fullest sequence with room (best fit). If that takes more sequences than the
tokens need, local search follows. It takes the emptiest sequence and moves length out of it into fuller ones: a piece moves, one piece is
exchanged for a shorter one, two for one, or one for two, wherever that leaves the target fuller within its size. Every
step shifts tokens from an emptier to a fuller sequence, so the sum of squared fills grows and the search ends. A sequence that is
empty goes. The search of a pool ends when no packing could need fewer sequences (by a lower bound), when no emptiest sequence has an
exchange left, or after ``EFFORT`` steps; the packing is whole at every step.

Null and empty texts are documents of the end id alone. Rows of equal or null ids are separate documents. Without rows there are no pieces.
The cut pieces are written to the shared folder once; a lost executor costs the pools of its tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import keyed_texts, stored
from tradewind.llm.token_ids import encoder_source

POOL = 4096
EFFORT = 4096  # steps of the search in a pool
CUT = "key long, doc_id long, piece int, start long, length long, ids binary"
PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
BATCH_BYTES = 8 << 20


def cut_lengths(tokens: int, size: int) -> list[int]:
    """Lengths of a document's pieces: full ones, a shorter one first where they don't divide it."""
    rest = tokens % size
    return [rest] * (rest > 0) + [size] * (tokens // size)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences as lists of items; items by descending length, each to the sequence with the least sufficient room."""
    sequences: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r is set if some sequence has room r
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        length = lengths[item]
        wide = rooms >> length
        if wide:
            room = length + (wide & -wide).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            sequences[at].append(item)
        else:
            room, at = size, len(sequences)
            sequences.append([item])
        if room > length:
            by_room[room - length].append(at)
            rooms |= 1 << (room - length)
    return sequences


class Offers:
    """What sequences can give: (sum, sequence) in flat arrays, kept up as single sequences change."""

    def __init__(self, count: int):
        self.items: list[dict[int, tuple]] = [{} for _ in range(count)]
        self.at: list[tuple[int, int]] = [(0, 0)] * count
        self.sums, self.owner, self.used = np.zeros(64, np.int64), np.full(64, -1, np.int64), 0

    def set(self, sequence: int, items: dict[int, tuple]) -> None:
        """Replace what one sequence gives; its old entries lose their owner."""
        lo, hi = self.at[sequence]
        self.owner[lo:hi] = -1
        if self.used + len(items) > len(self.sums):
            alive = np.flatnonzero(self.owner[:self.used] >= 0)
            room = 2 * (len(alive) + len(items)) + 64
            self.sums = np.concatenate([self.sums[alive], np.zeros(room, np.int64)])
            self.owner = np.concatenate([self.owner[alive], np.full(room, -1, np.int64)])
            self.used = len(alive)
            first = np.flatnonzero(np.diff(self.owner[:self.used], prepend=-1))
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), self.used], strict=True):
                self.at[int(self.owner[lo])] = lo, hi
        lo, hi = self.used, self.used + len(items)
        self.sums[lo:hi], self.owner[lo:hi] = list(items), sequence
        self.items[sequence], self.at[sequence], self.used = items, (lo, hi), hi

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.sums[:self.used], self.owner[:self.used]


class Underfull:
    """The underfull sequences of a pool, and exchanges between them."""

    def __init__(self, sequences: list[list[int]], lengths: list[int], size: int):
        self.held, self.lengths, self.size = sequences, lengths, size
        self.fill = np.array([sum(lengths[i] for i in s) for s in sequences], np.int64)
        self.ones, self.twos = Offers(len(sequences)), Offers(len(sequences))
        for at in range(len(sequences)):
            self.note(at)

    def note(self, at: int) -> None:
        """A sequence's distinct lengths and sums of two; distinct lengths add up to at most its size, so they are few."""
        items = sorted(self.held[at], key=lambda i: (self.lengths[i], i))
        ones, twos = {}, {}
        for k, i in enumerate(items):
            if self.lengths[i] not in ones:
                ones[self.lengths[i]] = (i,)
            elif 2 * self.lengths[i] not in twos:
                twos[2 * self.lengths[i]] = (items[k - 1], i)
        single = [p[0] for p in ones.values()]
        for k, i in enumerate(single):
            for j in single[k + 1:]:
                twos[self.lengths[i] + self.lengths[j]] = (i, j)
        self.ones.set(at, ones)
        self.twos.set(at, twos)

    def best_exchange(self, source: int) -> tuple | None:
        """(target, items given, items taken) that adds most to the sum of squared fills, or None.

        ``shift`` tokens move to a target at least as full that has room for them; the sum of squares grows by
        ``2 * shift * (target's fill - source's fill + shift)``.
        """
        best, choice = 0, None
        ahead, room = self.fill - self.fill[source], self.size - self.fill
        room[(ahead < 0) | (np.arange(len(room)) == source)] = 0
        alone = np.zeros(len(room), np.int64), np.arange(len(room))
        for mine, theirs in ((self.ones, None), (self.ones, self.ones), (self.twos, self.ones), (self.ones, self.twos)):
            taken, owner = theirs.arrays() if theirs else alone
            usable = np.flatnonzero((owner >= 0) & (room[owner] > 0))
            taken, owner = taken[usable], owner[usable]
            if not len(taken):
                continue
            most, lead = room[owner], ahead[owner]
            for total, items in mine.items[source].items():
                shift = total - taken
                gain = np.where((shift > 0) & (shift <= most), 2 * shift * (lead + shift), 0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, target = int(gain[k]), int(owner[k])
                    choice = target, items, theirs.items[target][int(taken[k])] if theirs else ()
        return choice

    def exchange(self, source: int, target: int, given: tuple, taken: tuple) -> None:
        for items, a, b in ((given, source, target), (taken, target, source)):
            for i in items:
                self.held[a].remove(i)
                self.held[b].append(i)
                self.fill[a] -= self.lengths[i]
                self.fill[b] += self.lengths[i]
        self.note(source)
        self.note(target)


def least_sequences(lengths: list[int], size: int) -> int:
    """No packing needs fewer: pieces too long to share are counted, the shorter ones must fit into what those leave."""
    count = np.bincount(lengths, minlength=size + 1)
    number, tokens = np.cumsum(count), np.cumsum(count * np.arange(size + 1))
    least = -(-int(tokens[size]) // size)
    for short in range(1, size // 2 + 1):
        alone = int(number[size] - number[size - short])  # longer than size - short
        half = int(number[size - short] - number[size // 2])
        left = half * size - int(tokens[size - short] - tokens[size // 2])
        small = int(tokens[size // 2] - tokens[short - 1])
        least = max(least, alone + half + max(0, -(-(small - left) // size)))
    return least


def local_search(sequences: list[list[int]], lengths: list[int], size: int, effort: int = EFFORT) -> list[list[int]]:
    """The sequences after exchanges between underfull ones, empty ones dropped."""
    least = least_sequences(lengths, size)
    fills = [sum(lengths[i] for i in s) for s in sequences]
    full = [s for s, f in zip(sequences, fills, strict=True) if f == size]
    loose = Underfull([list(s) for s, f in zip(sequences, fills, strict=True) if f < size], lengths, size)
    stuck = np.zeros(len(loose.held), bool)
    for _ in range(effort):
        if len(full) + int((loose.fill > 0).sum()) <= least:
            break
        waiting = np.flatnonzero((loose.fill > 0) & (loose.fill < size) & ~stuck)
        if not len(waiting):
            break
        source = int(waiting[np.argmin(loose.fill[waiting])])
        found = loose.best_exchange(source)
        if found is None:
            stuck[source] = True
        else:
            loose.exchange(source, *found)
            stuck[[source, found[0]]] = False
    return full + [s for s in loose.held if s]


def pack_pool(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences of the items of one pool."""
    return local_search(best_fit(lengths, size), lengths, size)


def cut_documents(df: DataFrame, tokenizer_path: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, piece, start, length, ids) of every piece; keys are unique."""
    source = encoder_source(df.sparkSession, tokenizer_path)
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, key = source.get(), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, start = encoder.encode(text.as_py() or "") + end, 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, size)):
                    rows.append((key, doc_id, piece, start, length, ids[4 * start:4 * (start + length)]))
                    start, key, held = start + length, key + 1, held + 4 * length
                    if held >= BATCH_BYTES:
                        yield as_batch(rows, CUT)
                        rows, held = [], 0
            if rows:
                yield as_batch(rows, CUT)

    return keyed_texts(df, id_col, text_col).mapInArrow(run, CUT)


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[c.split(" ") for c in schema.split(", ")], strict=True)
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


def pack(df: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, pool: int = POOL, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: the document, the piece's number and place in it, its ids (unsigned 32-bit, little-endian), sequence and offset."""
    cut = stored(cut_documents(df, tokenizer_path, size, end_id, id_col, text_col), "pieces")
    whole = cut.where(F.col("length") == size).select("doc_id", "piece", "start", "length", "ids", F.col("key").alias("sequence_id"),
                                                      F.lit(0).cast("long").alias("offset"))
    short = cut.where(F.col("length") < size)
    pools = max(1, -(-short.count() // pool))

    def packed(key, table):
        table = table.sort_by("key")  # so that a task that runs again packs alike
        lengths = table["length"].to_pylist()
        order, sequence, offset = [], [], []
        for number, items in enumerate(pack_pool(lengths, size)):
            at = 0
            for item in items:
                order.append(item)
                sequence.append(-1 - (key[0].as_py() * (1 << 24) + number))
                offset.append(at)
                at += lengths[item]
        out = table.select(["doc_id", "piece", "start", "length", "ids"]).take(pa.array(order, pa.int64()))
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    dealt = short.withColumn("pool", F.pmod(F.xxhash64("key"), F.lit(pools)))
    return whole.unionByName(dealt.groupBy("pool").applyInArrow(packed, PIECES))
