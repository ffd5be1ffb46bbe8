"""Exact removal of bytes that an earlier 100-byte string covers, by sharded suffix arrays.

Texts are dealt into shards by a hash of id and text. Which strings can repeat is found first: in every window of 100 bytes the
32-byte gram of the smallest hash is its anchor, so equal windows have equal anchors at equal places, and windows sharing
an anchor occurrence are neighbours. Hashes of all anchors meet in buckets, and each shard learns which of its anchors occur
again somewhere. Only for those the context (the bytes of all windows of that occurrence) is sent on:

* contexts of an anchor meet in one shard of contexts. Equal contexts need no suffix array: all but the earliest go. For the distinct
  contexts of an anchor a suffix array is built (Larsson-Sadakane) with common prefixes (Kasai); runs of suffixes
  that share 100 bytes are equal windows, and all but the earliest are removed;
* an anchor with more than ``HOT`` occurrences would overfill its shard, so its contexts are dealt by their own content. Their
  sorted windows leave each of these shards as a run, and runs are merged across shards by binary search.

Removed windows return to their text's shard as byte ranges, where they are joined and cut out. Groups are bounded: an anchor
shard by ``HOT`` contexts an anchor, everything else by expected size; equal contexts of a shard travel once.

Order of positions: smaller doc_id, then (for equal ids) smaller text hash, then one row before another, then smaller start; null
ids come last. So of equal rows one stays. Null and empty texts have no bytes; texts under 100 bytes lose nothing.
Matches never cross texts, and are judged on the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import text as tx
from tradewind.llm.frames import keyed_texts
from tradewind.llm.suffix_array import repeated_groups

U = np.uint64
GRAM = 32
SHARD_BYTES, BUCKET_ANCHORS = 4 << 20, 400_000
HOT = 1024
PLACE_BITS, BLOCK = 21, 1 << 17
FACTORS = [U(int(f) | 1) for f in tx.mix(np.arange(1, 9, dtype=U))]
LAST = np.iinfo(np.int64).max

POSITION = [("doc_id", "<i8"), ("text_hash", "<i8"), ("copy", "<u4"), ("start", "<u4"), ("doc", "<u4")]
RECORD = np.dtype([("anchor", "<u8"), *POSITION, ("more", "<u4"), ("at", "<u2"), ("size", "<u2"), ("hot", "u1")])
WINDOW = np.dtype([("w1", "<u8"), ("w2", "<u8"), *POSITION, ("shard", "<i8")])
RANGE = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])


class Texts:
    """The rows of a shard in the order of positions, as one buffer."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        hashes = table.column("text_hash").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, hashes[k]))
        self.rows = [ids[k] for k in order]
        self.doc_id = np.array([LAST if i is None else i for i in self.rows], np.int64)
        self.text_hash = np.array([hashes[k] for k in order], np.int64)
        self.data, self.offsets = tx.flat(table.column("text").combine_chunks().take(pa.array(order, pa.int64())))
        same = np.zeros(len(order), bool)
        same[1:] = (self.doc_id[1:] == self.doc_id[:-1]) & (self.text_hash[1:] == self.text_hash[:-1])
        at = np.arange(len(order))
        self.copy = at - np.maximum.accumulate(np.where(same, 0, at))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, U)
    lanes = np.ndarray((len(data) - 7,), U, np.ascontiguousarray(data), 0, (1,)).copy()
    with np.errstate(over="ignore"):
        return tx.mix(sum(lanes[8 * k:8 * k + n] * FACTORS[k] for k in range(GRAM // 8)))


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, in two passes over blocks of that length."""
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(U).max, U)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def anchors(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of every anchor occurrence, positions in the buffer.

    An occurrence's windows are consecutive, as the leftmost of equal smallest hashes is taken.
    """
    data, offsets, width = texts.data, texts.offsets, length - GRAM + 1
    out = []
    for lo in range(0, max(1, len(data) - length + 1), BLOCK):
        part = data[lo:lo + BLOCK + length - 1]
        hashes = gram_hashes(part)
        if len(hashes) < width:
            continue
        keys = hashes >> U(PLACE_BITS) << U(PLACE_BITS) | np.arange(len(hashes), dtype=U)
        place = (smallest(keys, width) & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = lo + np.arange(len(place))
        # a row's windows end where the row ends
        a, b = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, lo + len(place))
        row_end = np.repeat(offsets[a + 1:b + 1], np.diff(np.clip(offsets[a:b + 1], lo, lo + len(place))))
        whole = np.flatnonzero(starts + length <= row_end)
        place, starts = place[whole], starts[whole]
        if not len(place):
            continue
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(place) - 1)
        out.append((hashes[place[first]], lo + place[first], starts[first], starts[last]))
    if not out:
        return np.zeros(0, U), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def dealt(keys: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, bucket, first, end): places grouped by bucket, the earlier place first."""
    bucket = (tx.mix(keys) % U(count)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return order, bucket[first], first, np.append(first[1:], len(bucket))


def anchor_rows(texts: Texts, shard: int, length: int, buckets: int) -> pa.Table:
    """The hashes of a shard's anchors, packed by bucket."""
    hashes = anchors(texts, length)[0]
    order, bucket, first, end = dealt(hashes, buckets)
    sent = hashes[order]
    return pa.table({"bucket": pa.array(bucket, pa.int64()), "shard": pa.array([shard] * len(bucket), pa.int32()),
                     "hashes": pa.array([sent[a:b].tobytes() for a, b in zip(first, end, strict=True)], pa.binary())})


def flag_repeats(rows: pa.Table) -> pa.Table:
    """For each row of hashes a byte per hash: 0 occurs once, 1 again, 2 more than HOT times."""
    packed = [np.frombuffer(v, U) for v in rows.column("hashes").to_pylist()]
    every = np.concatenate(packed)
    _, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    flags = ((counts > 1).astype(np.uint8) + (counts > HOT))[inverse].astype(np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(p) for p in packed])])
    pieces = [flags[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    some = [k for k, p in enumerate(pieces) if p.any()]
    return pa.table({"shard": rows.column("shard").take(pa.array(some, pa.int64())).combine_chunks(),
                     "bucket": rows.column("bucket").take(pa.array(some, pa.int64())).combine_chunks(),
                     "flags": pa.array([pieces[k].tobytes() for k in some], pa.binary())})


def context_rows(texts: Texts, shard: int, replies: pa.Table, length: int, buckets: int, routes: int) -> pa.Table:
    """Contexts of a shard's repeated anchors, equal ones once, packed by the shard of contexts they go to."""
    empty = {"route": pa.array([], pa.int32()), "shard": pa.array([], pa.int32()),
             **{c: pa.array([], pa.binary()) for c in ("records", "bodies", "members")}}
    if not replies.num_rows:
        return pa.table(empty)
    hashes, place, first, last = anchors(texts, length)
    order, bucket, lo, hi = dealt(hashes, buckets)
    flags = np.zeros(len(hashes), np.uint8)
    reply = dict(zip(replies.column("bucket").to_pylist(), replies.column("flags").to_pylist(), strict=True))
    for b, x, y in zip(bucket.tolist(), lo, hi, strict=True):
        if b in reply:
            flags[order[x:y]] = np.frombuffer(reply[b], np.uint8)
    again = np.flatnonzero(flags)
    doc = tx.row_of(first[again], texts.offsets)
    raw = texts.data.tobytes()
    seen: dict[tuple[int, bytes], int] = {}
    chosen, members = [], []
    for k, d in zip(again.tolist(), doc.tolist(), strict=True):  # in the order of positions: the first of equal ones stands for all
        key = int(place[k] - first[k]), raw[first[k]:last[k] + length]
        found = seen.get(key)
        if found is None:
            seen[key] = len(chosen)
            chosen.append((k, d))
            members.append([])
        else:
            members[found].append((d, int(first[k] - texts.offsets[d])))
    records = np.zeros(len(chosen), RECORD)
    k = np.array([c[0] for c in chosen])
    d = np.array([c[1] for c in chosen])
    records["anchor"], records["hot"] = hashes[k], flags[k] == 2
    records["doc_id"], records["text_hash"], records["copy"] = texts.doc_id[d], texts.text_hash[d], texts.copy[d]
    records["start"], records["doc"] = first[k] - texts.offsets[d], d
    records["at"], records["size"] = place[k] - first[k], last[k] - first[k] + length
    records["more"] = [len(m) for m in members]
    bodies = [body for _, body in seen]
    # hot contexts are dealt by content, the others by their anchor
    keys, hot = records["anchor"].copy(), records["hot"] == 1
    keys[hot] = tx.span_hashes(texts.data, first[k[hot]], last[k[hot]] + length)
    order, route, lo, hi = dealt(keys, routes)
    packs = []
    for a, b in zip(lo, hi, strict=True):
        some = order[a:b].tolist()
        more = np.array([m for i in some for m in members[i]], np.uint32)
        packs.append((records[some].tobytes(), b"".join(bodies[i] for i in some), more.tobytes()))
    return pa.table({"route": pa.array(route, pa.int32()), "shard": pa.array([shard] * len(packs), pa.int32()),
                     **{c: pa.array([p[k] for p in packs], pa.binary()) for k, c in enumerate(("records", "bodies", "members"))}})


def position_order(p: np.ndarray, *before) -> np.ndarray:
    """Places of ``p`` by the given arrays, then by position."""
    return np.lexsort((p["start"], p["copy"], p["text_hash"], p["doc_id"], *before[::-1]))


class Ranges:
    """Byte ranges to remove, by shard."""

    def __init__(self):
        self.found: dict[int, list[np.ndarray]] = {}

    def add(self, shard: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        rows = np.zeros(len(shard), RANGE)
        rows["doc"], rows["start"], rows["end"] = doc, start, end
        order = np.argsort(shard, kind="stable")
        shard, rows = shard[order], rows[order]
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, [s, s + 1])
            self.found.setdefault(s, []).append(rows[a:b])

    def rows(self) -> list[tuple[int, bytes]]:
        return [(s, np.concatenate(r).tobytes()) for s, r in self.found.items()]


def window_ranges(ranges: Ranges, windows: np.ndarray, length: int) -> None:
    """Add the ranges of removed windows, consecutive ones as one."""
    if not len(windows):
        return
    order = np.lexsort((windows["start"], windows["doc"], windows["shard"]))
    w = windows[order]
    start = w["start"].astype(np.int64)
    new = np.concatenate([[True], (w["shard"][1:] != w["shard"][:-1]) | (w["doc"][1:] != w["doc"][:-1])
                          | (start[1:] > start[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(w) - 1)
    ranges.add(w["shard"][first], w["doc"][first], start[first], start[last] + length)


def windows_of(records: np.ndarray, shards: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, record of each, offset in its body) of contexts; hashes are left open."""
    count = records["size"].astype(np.int64) - length + 1
    owner = np.repeat(np.arange(len(records)), count)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    out = np.zeros(len(owner), WINDOW)
    for name, _ in POSITION:
        out[name] = records[name][owner]
    out["start"] += within.astype(np.uint32)
    out["shard"] = shards[owner]
    return out, owner, within


def settle_contexts(rows: pa.Table, length: int, routes: int) -> pa.Table:
    """Ranges from a shard of contexts, and the windows of hot contexts, packed for the merge.

    Ranges pass the merge unchanged on any route, so they are dealt evenly from this shard's own route on.
    """
    own = rows.column("route")[0].as_py()
    records = [np.frombuffer(v, RECORD) for v in rows.column("records").to_pylist()]
    shards = np.repeat(np.array(rows.column("shard").to_pylist(), np.int64), [len(r) for r in records])
    records = np.concatenate(records)
    text = b"".join(rows.column("bodies").to_pylist())
    more = np.frombuffer(b"".join(rows.column("members").to_pylist()), "<u4").reshape(-1, 2)
    size = records["size"].astype(np.int64)
    at = np.cumsum(size) - size
    ranges = Ranges()
    # further members of a shard's contexts come after the one that stands for them
    owner = np.repeat(np.arange(len(records)), records["more"])
    ranges.add(shards[owner], more[:, 0], more[:, 1], more[:, 1].astype(np.int64) + size[owner])
    # equal contexts: all but the earliest
    number: dict[tuple[int, int, bytes], int] = {}
    same = np.array([number.setdefault((a, r, text[b:b + s]), len(number)) for a, r, b, s in zip(
        records["anchor"].tolist(), records["at"].tolist(), at.tolist(), size.tolist(), strict=True)], np.int64)
    order = position_order(records, same)
    first = np.concatenate([[True], same[order][1:] != same[order][:-1]])
    later, distinct = order[~first], order[first]
    ranges.add(shards[later], records["doc"][later], records["start"][later], records["start"][later].astype(np.int64) + size[later])

    data = np.frombuffer(text, np.uint8)
    cold = distinct[records["hot"][distinct] == 0]
    cold = cold[tx.repeated(records["anchor"][cold])]
    if len(cold):
        # the suffix array of the distinct contexts of each anchor, end to end
        body = np.repeat(at[cold], size[cold]) + np.arange(int(size[cold].sum())) - np.repeat(np.cumsum(size[cold]) - size[cold], size[cold])
        joined = data[body]
        windows, owner, within = windows_of(records[cold], shards[cold], length)
        window_at = np.full(len(joined), -1, np.int64)
        window_at[(np.cumsum(size[cold]) - size[cold])[owner] + within] = np.arange(len(windows))
        suffixes, group = repeated_groups(joined, length)
        window = window_at[suffixes]
        group, window = group[window >= 0], window[window >= 0]
        order = position_order(windows[window], group)
        window, group = window[order], group[order]
        removed = np.concatenate([[False], group[1:] == group[:-1]])
        window_ranges(ranges, windows[window[removed]], length)

    hot = distinct[records["hot"][distinct] == 1]
    out = []
    if len(hot):
        windows, owner, within = windows_of(records[hot], shards[hot], length)
        start = at[hot][owner] + within
        windows["w1"] = tx.rolling_hashes(data, start, start + length)
        windows["w2"] = tx.rolling_hashes(data[::-1], len(data) - start - length, len(data) - start)
        kept, removed = merged([sorted_run(windows)])
        window_ranges(ranges, removed, length)
        order, route, lo, hi = dealt(kept["w1"], routes)
        out += [(r, -1, b"", kept[np.sort(order[a:b])].tobytes()) for r, a, b in zip(route.tolist(), lo, hi, strict=True)]
    out += [((own + k) % routes, s, r, b"") for k, (s, r) in enumerate(ranges.rows())]
    route, shard, found, sent = zip(*out, strict=True) if out else ((), (), (), ())
    return pa.table({"route": pa.array(route, pa.int32()), "shard": pa.array(shard, pa.int32()),
                     "ranges": pa.array(found, pa.binary()), "windows": pa.array(sent, pa.binary())})


def sorted_run(windows: np.ndarray) -> np.ndarray:
    return windows[position_order(windows, windows["w1"], windows["w2"])]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two runs sorted by their first hash as one: each window of the shorter finds its place in the longer by binary search."""
    if len(a) < len(b):
        a, b = b, a
    out = np.empty(len(a) + len(b), WINDOW)
    place = np.searchsorted(a["w1"], b["w1"], "right") + np.arange(len(b))
    rest = np.ones(len(out), bool)
    rest[place] = False
    out[place], out[rest] = b, a
    return out


def merged(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest of each window, all others) of sorted runs."""
    while len(runs) > 1:
        runs = [merge(*runs[k:k + 2]) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), 2)]
    windows = runs[0].copy()
    # those with equal first hashes are put in order of second hash and position
    same = windows["w1"][1:] == windows["w1"][:-1]
    tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    windows[tied] = sorted_run(windows[tied])
    first = np.ones(len(windows), bool)
    first[1:] = (windows["w1"][1:] != windows["w1"][:-1]) | (windows["w2"][1:] != windows["w2"][:-1])
    return windows[first], windows[~first]


def merge_windows(rows: pa.Table, length: int) -> pa.Table:
    """All ranges: those already known, and those of windows that occur earlier in another shard."""
    known = rows.filter(pc.greater_equal(rows.column("shard"), 0))
    out = list(zip(known.column("shard").to_pylist(), known.column("ranges").to_pylist(), strict=True))
    runs = [np.frombuffer(w, WINDOW) for w in rows.column("windows").to_pylist() if w]
    if runs:
        ranges = Ranges()
        window_ranges(ranges, merged(runs)[1], length)
        out += ranges.rows()
    return pa.table({"shard": pa.array([s for s, _ in out], pa.int32()), "ranges": pa.array([r for _, r in out], pa.binary())})


def cut_out(texts: Texts, rows: pa.Table) -> pa.Table:
    """Every text with its removed runs and what is left of it."""
    ranges = np.concatenate([np.zeros(0, RANGE)] + [np.frombuffer(r, RANGE) for r in rows.column("ranges").to_pylist()])
    edge = np.zeros(len(texts.data) + 1, np.int32)
    base = texts.offsets[ranges["doc"]]
    np.add.at(edge, base + ranges["start"], 1)
    np.subtract.at(edge, base + ranges["end"], 1)
    removed = np.cumsum(edge[:-1], dtype=np.int32) > 0
    starts, ends = tx.runs(removed, texts.offsets)
    row = tx.row_of(starts, texts.offsets)
    spans: list[list[dict]] = [[] for _ in texts.rows]
    for r, a, b in zip(row.tolist(), starts.tolist(), ends.tolist(), strict=True):
        spans[r].append({"start": a - int(texts.offsets[r]), "end": b - int(texts.offsets[r])})
    kept = [texts.data[a:b][~removed[a:b]].tobytes() for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)]
    return pa.table({"doc_id": pa.array(texts.rows, pa.int64()), "n_bytes": pa.array(np.diff(texts.offsets)),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     "kept": pa.array(kept, pa.binary())})


def remove_repeats(df: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed byte runs of its text, and the bytes that are left."""
    spark = df.sparkSession
    texts = keyed_texts(df, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = total // SHARD_BYTES + 1
    buckets = max(tasks, total // (BUCKET_ANCHORS * (length - GRAM + 2) // 2) + 1)
    routes = max(2 * tasks, 3 * shards)
    keyed = texts.withColumn("text_hash", F.xxhash64("text"))
    shard = F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(shards))
    # one exchange of the texts serves all three passes; shards and routes go to tasks by number, so no task gets many more than another
    dealt_texts = keyed.withColumn("shard", shard.cast("int")).repartitionById(tasks, "shard")

    def shard_of(table: pa.Table) -> int:
        return table.column("shard")[0].as_py()

    def find(table: pa.Table) -> pa.Table:
        return anchor_rows(Texts(table), shard_of(table), length, buckets)

    def gather(table: pa.Table, replies: pa.Table) -> pa.Table:
        return context_rows(Texts(table), shard_of(table), replies, length, buckets, routes)

    def settle(table: pa.Table) -> pa.Table:
        return settle_contexts(table, length, routes)

    def finish(table: pa.Table) -> pa.Table:
        return merge_windows(table, length)

    def cut(table: pa.Table, ranges: pa.Table) -> pa.Table:
        return cut_out(Texts(table), ranges)

    by_shard = dealt_texts.groupBy("shard")
    replies = (by_shard.applyInArrow(find, "bucket long, shard int, hashes binary")
               .groupBy("bucket").applyInArrow(flag_repeats, "shard int, bucket long, flags binary"))
    contexts = by_shard.cogroup(replies.repartitionById(tasks, "shard").groupBy("shard")).applyInArrow(
        gather, "route int, shard int, records binary, bodies binary, members binary")
    settled = contexts.repartitionById(tasks, "route").groupBy("route").applyInArrow(settle, "route int, shard int, ranges binary, windows binary")
    ranges = settled.groupBy("route").applyInArrow(finish, "shard int, ranges binary")
    return by_shard.cogroup(ranges.repartitionById(tasks, "shard").groupBy("shard")).applyInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
