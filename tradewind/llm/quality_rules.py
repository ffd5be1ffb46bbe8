"""Quality rules whose cutoffs come from labelled holdouts with a guaranteed limit on false rejections.

Two fixed base rules reject first. Each further rule compares one measure of the text with a cutoff per stratum (the
document's language). Labelled good rows that pass the base rules are the holdout. A stratum has one sequence of steps, from
the loosest to the tightest, and a step tightens all rules together; the last is taken whose false rejections, by any rule,
pass an exact binomial test: if the true rate were ``limit`` or more, so few rejections of good rows would have a chance of at
most ``alpha``. Testing along one fixed order and stopping at the first failure needs no correction inside a sequence, and all
rules are counted at once, so only ``alpha`` is divided, by the number of strata that hold enough rows for any test: with
probability ``1 - alpha`` all rules together wrongly reject at most ``limit`` of the good rows in every stratum. A stratum
with fewer than ``least_rows`` has no cutoff and rejects by the base rules alone.

Null and empty texts have no words, so the base rules reject them. Rows are never dropped or merged. A document whose labels
disagree counts as good. Labels without a document, and null ids or labels, are ignored. Null strata form one stratum.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import text as tx
from tradewind.llm.frames import map_batches, quoted, stored

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = tx.lookup(lambda b: chr(b) in "#*$%&|<>")
UPPER = tx.lookup(lambda b: 0x41 <= b <= 0x5A)
DIGITS = tx.lookup(lambda b: 0x30 <= b <= 0x39)

#: rule: (measure, cutoffs from the loosest to the tightest); a row is rejected where the measure is above the cutoff. The
#: grids end at the same step, so shorter ones join the sequence later.
SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.175, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02)
RULES = {
    "symbols": ("symbol_share", SHARES),
    "capitals": ("upper_share", SHARES),
    "digits": ("digit_share", SHARES),
    "lines": ("dup_line_share", SHARES),
    "repeats": ("repeat_share", SHARES[10:]),
    "marks": ("mark_word_share", SHARES),
    "long": ("mean_word", (40.0, 30.0, 25.0, 20.0, 17.5, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0)),
}
MEASURES = ("symbol_share", "upper_share", "digit_share", "dup_line_share", "repeat_share", "mark_word_share", "mean_word")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(
    f"{m} double" for m in MEASURES)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and shares of each row's whole text."""
    rows = len(offsets) - 1
    starts, ends = tx.runs(tx.NOT_SPACE[data], offsets)
    row = tx.row_of(starts, offsets)
    n_words = tx.per_row(row, rows)
    total = np.concatenate([[0], np.cumsum(tx.character_starts(data))])
    chars = np.bincount(row, total[ends] - total[starts], rows).astype(np.int64)

    hashes = tx.span_hashes(data, starts, ends)
    windows = tx.shingle_hashes(hashes, WINDOW)
    owner = row[:len(windows)]
    whole = owner == row[WINDOW - 1:] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    again = at[tx.repeated(tx.mix(windows[at] ^ tx.mix(owner[at].astype(tx.U))))]
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[again] += 1
    np.subtract.at(edge, again + WINDOW, 1)
    n_repeat = np.bincount(row, np.cumsum(edge[:-1]) > 0, rows).astype(np.int64)

    # lines end at \n or at the end of the row
    newline = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], newline + 1]))
    line_ends = np.sort(np.concatenate([newline, offsets[1:]]))
    line_row = np.sort(np.concatenate([np.arange(rows), tx.row_of(newline, offsets)]))
    before = np.concatenate([[0], np.cumsum(np.bincount(starts, minlength=len(data))[:len(data)])])
    filled = before[line_ends] > before[line_starts]  # some word starts there; no word spans a line break
    line_starts, line_ends, line_row = line_starts[filled], line_ends[filled], line_row[filled]
    lines = tx.mix(tx.span_hashes(data, line_starts, line_ends) ^ tx.mix(line_row.astype(tx.U)))
    n_dup = np.bincount(line_row, tx.repeats_earlier(lines), rows).astype(np.int64)
    n_lines = tx.per_row(line_row, rows)

    marks = SYMBOLS[data]
    marked = np.concatenate([[0], np.cumsum(marks)])
    mark_words = np.bincount(row, marked[ends] > marked[starts], rows)
    n_symbols = tx.count_in(marks, offsets)

    def share(a, b):
        return np.divide(a, b, out=np.zeros(rows), where=b > 0)

    return {"n_words": n_words, "word_chars": chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
            "symbol_share": share(n_symbols, chars), "upper_share": share(tx.count_in(UPPER[data], offsets), chars),
            "digit_share": share(tx.count_in(DIGITS[data], offsets), chars), "dup_line_share": share(n_dup, n_lines),
            "repeat_share": share(n_repeat, n_words), "mark_word_share": share(mark_words, n_words),
            "mean_word": share(chars, n_words)}


def at_most(k: int, n: int, p: float) -> float:
    """P(a binomial count of n trials at rate p is k or less), summed exactly."""
    if n <= 0:
        return 1.0
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
             for i in range(min(k, n) + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def certified(rejected: list[int], total: int, limit: float, alpha: float) -> int:
    """How many cutoffs, from the loosest on, pass the test before the first failure."""
    for k, count in enumerate(rejected):
        if at_most(count, total, limit) > alpha:
            return k
    return len(rejected)


def least_rows(limit: float, alpha: float) -> int:
    """The fewest good rows of which none is rejected that pass the test."""
    return max(1, math.ceil(math.log(alpha) / math.log1p(-limit) - 1e-9))


def with_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, counts, measures) of every row."""
    narrow = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(stratum_col).cast("string").alias("stratum"),
                         quoted(text_col).cast("string").alias("text"))
    names = ["doc_id", "stratum", *COUNTS, *MEASURES]

    def run(batch):
        for lo, hi, data, offsets in tx.parts(batch.column(2)):
            found = measure(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 *[pa.array(found[c], pa.int64()) for c in COUNTS], *[pa.array(found[m], pa.float64()) for m in MEASURES]], names)

    return map_batches(narrow, run, SCHEMA)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def cutoffs(measured: DataFrame, labels: DataFrame, limit: float, alpha: float, rules: dict = RULES) -> DataFrame:
    """(stratum, rule, cutoff): the rules of the tightest certified step of each stratum that certifies one."""
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .where("quality = 1").select("doc_id"))
    holdout = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    steps = max(len(grid) for _, grid in rules.values())

    def cutoffs_below(measure_name, grid):
        return reduce(operator.add, [F.when(F.col(measure_name) > float(c), 1).otherwise(0) for c in grid])

    # the grids end together, so a row is rejected by some rule in as many of the last steps as the strictest rule says
    above = reduce(lambda a, b: F.greatest(a, b), [cutoffs_below(*rule) for rule in rules.values()])
    counts = stored(holdout.select("stratum", above.alias("above")).groupBy("stratum", "above")
                    .agg(F.count("*").alias("n")), "histogram")  # bounded by strata x steps
    # how many rows a stratum has says nothing about how many of them are rejected
    strata = (counts.groupBy("stratum").agg(F.sum("n").alias("n")).where(F.col("n") >= least_rows(limit, alpha))
              .agg(F.count("*").alias("strata")).scalar())

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        last = np.zeros(steps + 1, np.int64)
        np.add.at(last, group["above"].to_numpy(), group["n"].to_numpy())
        rejected = [int(last[steps - k:].sum()) for k in range(steps)]
        passed = certified(rejected, int(last.sum()), limit, alpha / max(1, int(group["strata"].iloc[0])))
        out = [(group["stratum"].iloc[0], name, grid[passed - 1 - steps + len(grid)])
               for name, (_, grid) in rules.items() if passed > steps - len(grid)]
        return pd.DataFrame(out, columns=["stratum", "rule", "cutoff"])

    return (counts.withColumn("strata", strata).groupBy("stratum")
            .applyInPandas(choose, "stratum string, rule string, cutoff double"))


def judge(docs: DataFrame, labels: DataFrame, limit: float = 0.02, alpha: float = 0.05, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` with its counts, measures, ``base_failed``, ``kept`` and the rules that rejected it."""
    measured = stored(with_measures(docs, id_col, text_col, stratum_col), "measures")
    chosen = (cutoffs(measured, labels, limit, alpha).groupBy("stratum")
              .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))
    chosen = stored(chosen, "cutoffs")  # a row per stratum: its size is known to the planner
    joined = measured.alias("m").join(chosen.alias("c"), F.col("m.stratum").eqNullSafe(F.col("c.stratum")), "left").select(
        "m.*", "cutoffs")
    over = F.array_compact(F.array(*[
        F.when(F.col(m) > F.try_element_at("cutoffs", F.lit(name)), F.lit(name)) for name, (m, _) in RULES.items()]))
    out = joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.coalesce(over, F.array()))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("cutoffs")
