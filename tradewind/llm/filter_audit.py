"""Audit of how five document filters interact, from truth-table survival words.

Each filter fails or passes a document, so a document has one of 32 failure masks. Its survival word is a truth table: bit S is
set if the document survives when just the filters of subset S are applied. Counting, per part and label class, how often
each of the 32 bits is set gives the survivors of every subset, and these 32 numbers give every order of the filters at once: a
filter's removals in an order are the survivors before it less those after it.

Bits are counted in Arrow batches by carry-save adders, for all groups of a batch side by side: three words of weight w become a sum
word of weight w and a carry word of weight 2w, until a group has one word per weight. Batches' counts are summed by Spark, combined
before the exchange, so a source with a third of all rows travels as 32 rows a batch.

Filters: A under ``least_words`` words; B distinct words under 65 % of the words; C more than 5 % of the code points in A-Z; D a mark of
``#$%&*|``; E text identical to that of a smaller id anywhere in the table. For E, documents are counted by (digest, id) and the
smallest id per digest is joined back on digest and id, so that a text with a third of all rows is no hot key. Texts are
compared by their SHA-256.

Null texts are empty, null parts the empty string. Rows with equal ids are documents each; none of them is the other's copy. A null
id is neither smaller nor larger than any other, so it never fails E; it has no label. A label row counts if any of its id's rows says 1.
An empty table has no parts and no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import map_batches, quoted, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
GAP = "[\\x20\\x09-\\x0D]+"

#: survival word of each failure mask: bit S is set if no filter of S fails
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)


def failure_masks(df: DataFrame, text: str, least_words: int) -> DataFrame:
    """The rows with ``mask``: bits 0 to 3 say which of A to D fail."""
    t = quoted(text)
    rows = df.withColumn("_words", F.array_remove(F.split(t, GAP), ""))
    rows = rows.withColumn("_n", F.size("_words")).withColumn("_kinds", F.size(F.array_distinct("_words")))
    capitals = F.length(F.array_join(F.regexp_extract_all(t, F.lit("[A-Z]+"), F.lit(0)), ""))
    tests = (F.col("_n") < least_words, 100 * F.col("_kinds") < 65 * F.col("_n"), 100 * capitals > 5 * F.length(t), t.rlike("[#$%&*|]"))
    mask = sum((F.when(test, F.lit(1 << k)).otherwise(F.lit(0)) for k, test in enumerate(tests)), F.lit(0))
    return rows.withColumn("mask", mask).drop("_words", "_n", "_kinds")


def carry_save(groups: np.ndarray, weights: np.ndarray, words: np.ndarray, count: int) -> np.ndarray:
    """How often each of the 32 bits is set in each of ``count`` groups; a word counts ``weights`` times."""
    total = np.zeros((count, SUBSETS), np.int64)
    pending: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for k in range(int(weights.max()).bit_length() if len(weights) else 0):
        on = (weights >> k & 1) > 0
        pending[k] = [(groups[on], words[on])]
    k = 0
    while pending:
        g, w = (np.concatenate(x) for x in zip(*pending.pop(k, [(np.zeros(0, np.int64), np.zeros(0, np.uint32))]), strict=True))
        while len(g):
            order = np.argsort(g, kind="stable")
            g, w = g[order], w[order]
            size = np.bincount(g, minlength=count)
            place = np.arange(len(g)) - (np.cumsum(size) - size)[g]
            if size.max() == 1:  # what stays at this weight
                total[g] += ((w[:, None] >> np.arange(SUBSETS, dtype=np.uint32)) & 1).astype(np.int64) << k
                break
            by = np.where(size[g] >= 3, 3, 2)  # full adders, a half adder for a last pair
            used = place < size[g] // by * by
            used &= size[g] >= 2
            three, two = used & (by == 3), used & (by == 2)
            a, b, c = w[three].reshape(-1, 3).T
            d, e = w[two].reshape(-1, 2).T
            carried = np.concatenate([g[three][::3], g[two][::2]]), np.concatenate([(a & b) | (c & (a ^ b)), d & e])
            pending.setdefault(k + 1, []).append(carried)
            g, w = (np.concatenate([g[~used], g[three][::3], g[two][::2]]), np.concatenate([w[~used], a ^ b ^ c, d ^ e]))
        k += 1
    return total


def survivors(words: DataFrame) -> DataFrame:
    """(part, good, toxic, subset, n) from (part, good, toxic, mask, n): documents that survive each subset of the filters."""

    def run(batch):
        part, good, toxic, mask, weight = batch.columns
        code = part.dictionary_encode()
        label = good.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + toxic.to_numpy(zero_copy_only=False)
        keys, group = np.unique(code.indices.to_numpy().astype(np.int64) * 4 + label, return_inverse=True)
        counts = carry_save(group, weight.to_numpy(), SURVIVAL[mask.to_numpy()], len(keys))
        each = np.repeat(keys, SUBSETS)
        yield pa.RecordBatch.from_arrays(
            [code.dictionary.take(pa.array(each // 4)), pa.array(each // 2 % 2 == 1), pa.array(each % 2 == 1),
             pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(keys))), pa.array(counts.ravel())],
            ["part", "good", "toxic", "subset", "n"])

    found = map_batches(words.select("part", "good", "toxic", "mask", "n"), run,
                        "part string, good boolean, toxic boolean, subset int, n long")
    return found.groupBy("part", "good", "toxic", "subset").agg(F.sum("n").alias("n"))


def survival_counts(docs: DataFrame, labels: DataFrame, least_words: int = 50, id_col: str = "doc_id", text_col: str = "text",
                    part_col: str = "source") -> DataFrame:
    """(part, good, toxic, subset, n): documents of each part and label class that survive each subset of the filters."""
    narrow = docs.select(quoted(id_col).cast("long").alias("doc_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
                         F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"))
    rows = failure_masks(narrow, "text", least_words).select("doc_id", "part", "mask", F.unhex(F.sha2("text", 256)).alias("digest"))
    # equal rows travel once with their number, so no key is hot but by different ids
    held = stored(rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")), "masks")
    first = held.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("is_first", F.lit(True))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"), F.col("toxic").alias("t")).where(
        "doc_id is not null").groupBy("doc_id").agg(F.max((F.col("q") == 1)).alias("good"), F.max((F.col("t") == 1)).alias("toxic"))
    placed = held.where("doc_id is not null").join(first, ["doc_id", "digest"], "left").join(known, "doc_id", "left")
    late = F.when(F.col("is_first"), F.lit(0)).otherwise(F.lit(1 << FILTERS.index("E")))
    false = F.lit(False)
    words = placed.select("part", F.coalesce("good", false).alias("good"), F.coalesce("toxic", false).alias("toxic"),
                          (F.col("mask") + late).alias("mask"), "n")
    lost = held.where("doc_id is null").select("part", false.alias("good"), false.alias("toxic"), "mask", "n")
    return survivors(words.unionByName(lost))


def orders() -> list[tuple[str, int, int, int, int]]:
    """(order, step, filter's bit, subset before, subset after) of every order of the filters."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(("".join(order), step, bit, before, before | bit))
            before |= bit
    return out


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS)


def audit(docs: DataFrame, labels: DataFrame, least_words: int = 50, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fails the filter, removed earlier), ``unique_fails`` (fails this filter
    only), ``good_lost`` and ``toxic_lost`` (removed here, of these labels), ``shapley`` (the filter's removals over all orders).
    """
    counts = survival_counts(docs, labels, least_words, **columns)

    def of(condition=None):
        n = F.col("n") if condition is None else F.when(condition, F.col("n"))
        return F.coalesce(F.sum(n), F.lit(0))

    per = counts.groupBy("part", "subset").agg(of().alias("every"), of(F.col("good")).alias("good"), of(F.col("toxic")).alias("toxic"))
    # 32 rows a part at most
    tables = per.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "every", "good", "toxic"))).alias("c")).select(
        "part", *[F.col(f"c.{k}").alias(k) for k in ("every", "good", "toxic")])
    names, steps, bits, before, after = (np.array(x) for x in zip(*orders(), strict=True))

    def run(batch):
        rows = batch.num_rows
        every, good, toxic = (np.array(batch.column(k).to_pylist(), np.int64) for k in (1, 2, 3))
        removed = every[:, before] - every[:, after]
        share = {b: removed[:, bits == b].sum(axis=1) for b in set(bits.tolist())}
        fails = every[:, [0]] - every[:, bits]
        others = SUBSETS - 1 - bits
        values = (every[:, after], removed, fails - removed, every[:, others] - every[:, [SUBSETS - 1]],
                  good[:, before] - good[:, after], toxic[:, before] - toxic[:, after],
                  np.stack([share[b] for b in bits.tolist()], axis=1))
        part = batch.column(0).take(pa.array(np.repeat(np.arange(rows), len(steps))))
        yield pa.RecordBatch.from_arrays(
            [part, pa.array(np.tile(names, rows)), pa.array(np.tile(steps.astype(np.int32), rows)),
             *[pa.array(v.ravel()) for v in values]], ["part", "filter_order", "step", *COLUMNS])

    return map_batches(tables, run, SCHEMA)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM texts LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masks GROUP BY ALL),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31 AND len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, range(1, 6) AS r(s)),
audited AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audited
"""
