"""Licence scan: ordered signature rules behind a keyword prefilter.

Words of a whole text (A-Z lower-cased; runs of digits, letters and characters beyond ASCII) are found and hashed by numpy.
A rule runs only on texts that hold its keyword as a word. Detections that lie inside an accepted one are suppressed: rules
are taken by priority, then longer first, then earlier, then by label; partial overlaps stay. The three base
phrases are counted wherever their words stand consecutively and are never suppressed.

Every row is kept. Null and empty texts have no words, null positions, empty label lists and score 0. ``score`` is
the share of a text's words inside base phrases and accepted detections.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm import text as tx
from tradewind.llm.frames import keyed_texts, map_batches
from tradewind.llm.license_rules import RULES, Rule

BASE_PHRASES = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, detections array<struct<label:string,rule:string,first_word:long,end_word:long>>")


class Longest:
    """The largest end among accepted intervals that start at or before a word (a binary indexed tree)."""

    def __init__(self, size: int):
        self.ends = [0] * (size + 2)

    def add(self, start: int, end: int) -> None:
        at = start + 1
        while at < len(self.ends):
            self.ends[at] = max(self.ends[at], end)
            at += at & -at

    def reach(self, start: int) -> int:
        at, end = start + 1, 0
        while at:
            end = max(end, self.ends[at])
            at -= at & -at
        return end


def detect(words: bytes, rules: list[Rule]) -> list[tuple[Rule, int, int]]:
    """Accepted (rule, first word, end word) in words joined by spaces."""
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    found = []
    for rule in rules:
        for m in rule.pattern.finditer(words):
            first = int(np.searchsorted(spaces, m.start()))
            found.append((rule, first, first + m[0].count(b" ") + 1))
    found.sort(key=lambda d: (d[0].priority, d[1] - d[2], d[1], d[0].label))
    kept, longest = [], Longest(len(spaces) + 1)
    for rule, a, b in found:
        if longest.reach(a) < b:
            kept.append((rule, a, b))
            longest.add(a, b)
    return sorted(kept, key=lambda d: (d[1], d[2]))


class Scanner:
    """Rules grouped by the hash of their keyword."""

    def __init__(self, rules=RULES):
        self.by_keyword: dict[int, list[Rule]] = {}
        for rule in rules:
            self.by_keyword.setdefault(int(tx.hash_of(rule.keyword.encode())), []).append(rule)
        self.keywords = np.sort(np.array(list(self.by_keyword), tx.U))
        self.phrases = [([tx.hash_of(w) for w in phrase.split()], label) for phrase, label in BASE_PHRASES]

    def scan(self, data: np.ndarray, offsets: np.ndarray):
        """Per row: (words, base places, first, last, base labels, labels, score, detections)."""
        rows = len(offsets) - 1
        data = tx.LOWER[data]
        starts, ends = tx.runs(tx.ALNUM[data], offsets)
        row = tx.row_of(starts, offsets)
        hashes = tx.span_hashes(data, starts, ends)
        n_words = tx.per_row(row, rows)
        first_of_row = np.concatenate([[0], np.cumsum(n_words)])

        places: list[list[tuple[int, int, str]]] = [[] for _ in range(rows)]
        for phrase, label in self.phrases:
            n = len(hashes) - len(phrase) + 1
            if n <= 0:
                continue
            hit = np.ones(n, bool)
            for k, word in enumerate(phrase):
                hit &= hashes[k:k + n] == word
            hit &= row[:n] == row[len(phrase) - 1:]
            for w in np.flatnonzero(hit):
                at = int(w - first_of_row[row[w]])
                places[row[w]].append((at, at + len(phrase), label))

        slot = np.minimum(np.searchsorted(self.keywords, hashes), len(self.keywords) - 1)
        hits = np.flatnonzero(self.keywords[slot] == hashes)
        keywords: dict[int, set[int]] = {}
        for w in hits:
            keywords.setdefault(int(row[w]), set()).add(int(hashes[w]))

        for r in range(rows):
            kept = []
            if r in keywords:
                lo, hi = first_of_row[r], first_of_row[r + 1]
                joined = b" ".join(data[a:b].tobytes() for a, b in zip(starts[lo:hi], ends[lo:hi], strict=True))
                kept = detect(joined, [rule for k in sorted(keywords[r]) for rule in self.by_keyword[k]])
            base = {label for _, _, label in places[r]}
            inside = np.zeros(n_words[r] + 1, np.int64)
            for a, b in [p[:2] for p in places[r]] + [d[1:] for d in kept]:
                inside[a] += 1
                inside[b] -= 1
            covered = int((np.cumsum(inside) > 0).sum())
            at = [p[0] for p in places[r]]
            yield (int(n_words[r]), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                   ",".join(sorted(base | {d[0].label for d in kept})), covered / int(n_words[r]) if covered else 0.0,
                   [{"label": d[0].label, "rule": d[0].name, "first_word": d[1], "end_word": d[2]} for d in kept])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: word counts, base places, labels, score and the accepted detections."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([
        ("label", pa.string()), ("rule", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    scanner: list[Scanner] = []

    def scan(batch):
        if not scanner:
            scanner.append(Scanner())
        for lo, hi, data, offsets in tx.parts(batch.column(1)):
            columns = zip(*scanner[0].scan(data, offsets), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    return map_batches(keyed_texts(df, id_col, text_col), scan, SCHEMA)
