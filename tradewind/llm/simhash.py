"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints x and y differ in at most r bits iff some z lies within half of r of both. Every distinct fingerprint emits all
variants within ``r // 2`` flipped bits. For odd r one side has to go one bit further: two fingerprints exactly r apart
differ in parity, so only those of odd parity emit the next sphere, and of those variants only the ones whose flipped bits
lie in one half of the word (of r differing bits, one half holds ``r // 2 + 1``). All variants of one value meet in one bucket.
Members within ``r // 2`` of it are ``2 * (r // 2)`` apart at most, and within r of the sphere's members, so linking
each member to the bucket's smallest inner member gives only true links, no pairs are listed, and a bucket never holds more
than a ball, however many documents are alike. Every link is verified again by its bit distance.

Variants travel packed, a binary per task and bucket, at ten bytes a variant; a bucket's expected size is a parameter.

Null and empty texts have fingerprint zero and are linked like any other. Rows with equal ids stay separate rows. A null
id is never a component's name unless all ids of the component are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import text as tx
from tradewind.llm.components import components
from tradewind.llm.frames import keyed_texts, map_batches, quoted, stored
from tradewind.llm.xxh64 import hash_spans

U = np.uint64
BITS = 64
SEED = 42
BUCKET_VARIANTS = 500_000
FLUSH_VARIANTS = 4_000_000
ROW, ID, COPIES = "__tw_row", "__tw_id", "__tw_copies"  # beside the columns of any table


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every row over its word shingles, repeats included; zero where there is no word."""
    rows = len(offsets) - 1
    inside = tx.NOT_SPACE[data]
    starts, ends = tx.runs(inside, offsets)
    row = tx.row_of(starts, offsets)
    n_words = tx.per_row(row, rows)
    # words with one space between: keep each word's bytes and one byte after it
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.concatenate([[0], np.cumsum(keep)])
    joined = np.where(inside, tx.LOWER[data], 0x20).astype(np.uint8)[keep]
    starts, ends = place[starts], place[ends]
    out = np.zeros(rows, U)
    if not len(starts):
        return out
    # a shingle starts at every word with size - 1 words after it in the row, or at the first word of a short row
    n_shingles = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    first_word = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    first = np.concatenate([[0], np.cumsum(n_shingles)])
    owner = np.repeat(np.arange(rows), n_shingles)
    word = first_word[owner] + (np.arange(first[-1]) - first[owner])
    last = word + np.minimum(size, n_words[owner]) - 1
    hashes = hash_spans(joined, starts[word], ends[last], SEED)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    filled = np.flatnonzero(n_shingles)
    votes = np.add.reduceat(bits, first[:-1][filled], axis=0, dtype=np.int32)
    packed = np.packbits(2 * votes > n_shingles[filled, None], axis=1, bitorder="little")
    out[filled] = packed.view(U).ravel()
    return out


def fingerprint(keyed: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp) and what else ``keyed`` has: its ``text`` gives way to the fingerprint, a signed long of the same bits."""
    names = [c for c in keyed.columns if c != "text"]
    schema = keyed.select(*names).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batch):
        for lo, hi, data, offsets in tx.parts(batch.column("text")):
            fps = fingerprints_of(data, offsets, size).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in names], pa.array(fps)], [*names, "fp"])

    return map_batches(keyed, run, schema)


def flip_masks(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the ball that all emit, and of the sphere that odd fingerprints add (empty for an even radius)."""
    def masks(count, places):
        return [sum(1 << b for b in chosen) for chosen in combinations(places, count)]

    half = radius // 2
    ball = [m for k in range(half + 1) for m in masks(k, range(BITS))]
    sphere = [] if radius % 2 == 0 else sorted(
        set(masks(half + 1, range(BITS // 2)) + masks(half + 1, range(BITS // 2, BITS))))
    return np.array(ball, U), np.array(sphere, U)


def link_buckets(fps: DataFrame, radius: int, buckets: int) -> DataFrame:
    """(a, b) links of distinct fingerprints ``fp``: pairs within ``radius`` that connect all such pairs."""
    ball, sphere = flip_masks(radius)
    masks = np.concatenate([ball, sphere])
    code_type = np.uint16 if len(masks) <= 1 << 16 else np.uint32

    def pack(variants: list[np.ndarray], codes: list[np.ndarray]):
        z, code = np.concatenate(variants), np.concatenate(codes)
        bucket = (tx.mix(z) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        z, code, bucket = z[order], code[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(cut[1:], len(z))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut]), pa.array([z[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()),
             pa.array([code[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary())], ["bucket", "z", "code"])

    def emit(batches):
        variants, codes, held = [], [], 0
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            for lo in range(0, len(all_fps), 1024):
                x = all_fps[lo:lo + 1024]
                odd = x[np.bitwise_count(x) % 2 == 1]
                for some, chosen, base in ((x, ball, 0), (odd, sphere, len(ball))):
                    variants.append((some[:, None] ^ chosen[None, :]).ravel())
                    codes.append(np.tile(np.arange(base, base + len(chosen), dtype=code_type), len(some)))
                    held += len(variants[-1])
                if held >= FLUSH_VARIANTS:
                    yield from pack(variants, codes)
                    variants, codes, held = [], [], 0
        if held:
            yield from pack(variants, codes)

    def meet(group: pa.Table) -> pa.Table:
        z = np.concatenate([np.frombuffer(v, U) for v in group.column("z").to_pylist()])
        code = np.concatenate([np.frombuffer(v, code_type) for v in group.column("code").to_pylist()])
        inner = code < len(ball)
        zi, xi = z[inner], z[inner] ^ masks[code[inner]]
        order = np.lexsort((xi, zi))
        zi, xi = zi[order], xi[order]
        new = np.concatenate([[True], zi[1:] != zi[:-1]]) if len(zi) else np.zeros(0, bool)
        centres, least = zi[new], xi[new]  # the smallest inner member of each variant
        a, b = [xi], [least[np.cumsum(new) - 1]]
        zo = z[~inner]
        if len(centres) and len(zo):
            slot = np.minimum(np.searchsorted(centres, zo), len(centres) - 1)
            hit = centres[slot] == zo
            a.append(zo[hit] ^ masks[code[~inner][hit]])
            b.append(least[slot[hit]])
        a, b = np.concatenate(a), np.concatenate(b)
        true = (a != b) & (np.bitwise_count(a ^ b) <= radius)
        links = np.unique(np.stack([a[true], b[true]], axis=1), axis=0).view(np.int64)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    return (fps.select("fp").mapInArrow(emit, "bucket long, z binary, code binary")
            .groupBy("bucket").applyInArrow(meet, "a long, b long"))


def group_fingerprints(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root): for each distinct fingerprint of ``fps`` one fingerprint that names its component."""
    spark = fps.sparkSession
    distinct = stored(fps.select("fp").distinct(), "fingerprints")
    ball, sphere = flip_masks(radius)
    per_fp = len(ball) + len(sphere) / 2
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * tasks, int(distinct.count() * per_fp / BUCKET_VARIANTS) + 1)
    member = components(link_buckets(distinct.repartition(tasks, "fp"), radius, buckets))
    return distinct.join(member, distinct["fp"] == member["a"], "left").select("fp", F.coalesce("b", "fp").alias("root"))


def near_duplicates(df: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component's smallest doc_id names it."""
    fps = stored(fingerprint(keyed_texts(df, id_col, text_col), size), "documents-fp")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = stored(group_fingerprints(fps, radius).join(least, "fp"), "roots")
    named = stored(root.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    grouped = stored(root.join(named, "root").select("fp", "component_id"), "groups")
    return fps.join(grouped, "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, the one of the smallest id (then of the smallest row hash), columns unchanged.

    Rows that agree in every column are told apart by nothing: one of them stays.
    """
    row = F.xxhash64(*[quoted(c) for c in df.columns])
    keyed = df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"), row.alias("row"))
    fps = stored(fingerprint(keyed, size).groupBy("doc_id", "row", "fp").agg(F.count("*").alias("copies")), "rows-fp")
    root = stored(group_fingerprints(fps, radius), "roots")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "copies")
    kept = (fps.join(root, "fp").groupBy("root").agg(F.min(first).alias("k"))
            .select(F.col("k.row").alias(ROW), F.col("k.doc_id").alias(ID), F.col("k.copies").alias(COPIES)))
    chosen = df.withColumn(ROW, row).join(stored(kept, "kept"), ROW).where(quoted(id_col).cast("long").eqNullSafe(F.col(ID)))
    columns = [quoted(c) for c in df.columns]
    single = chosen.where(F.col(COPIES) == 1).select(*columns)
    return single.unionByName(chosen.where(F.col(COPIES) > 1).select(*columns).distinct())
