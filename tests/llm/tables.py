"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

CLASHING = ("kept", "fp", "n_words", "sequence_id", "bucket", "shard", "row", "copies", "text_hash", "score", "offset", "a", "b",
            "__x.y", "spans", "labels", "item_id", "similarity", "stratum", "quality", "length", "start", "route")
WORDS = "the of and to in is it that for on as with his they at be this from have or by one had not but what all were when we there".split()


def prose(seed: int, n: int, words=None) -> str:
    rng = random.Random(seed)
    words = words or [a + b for a in WORDS for b in WORDS]
    out = []
    for _ in range(n):
        out.append(rng.choice(words))
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ",", "!\n", "\t"])
    return " ".join(out)


def awkward(seed: int = 7) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    base = prose(seed, 120)
    texts = [None, "", " \n\t ", "a", "one two three four", base, base, base + " tail", "x " + base, base.replace("the", "THE"),
             prose(seed + 1, 4000), "word " * 3000, "a" * 5000, "été 中文 \U0001f600 " * 30, "line\nline\nline\n\n" * 5]
    for k in range(25):
        cut = rng.randrange(0, 60)
        text = prose(100 + k, rng.randrange(1, 150))
        texts.append(text + " " + base[cut * 5:cut * 5 + 200] + " " + prose(200 + k, rng.randrange(0, 30)) if k % 3 == 0 else text)
    rows = [(k, t, ("en", "de", None)[k % 3], f"src{k % 4}" if k % 5 else None, len(t) if t else 0) for k, t in enumerate(texts)]
    rows += [(None, base, "en", None, None), (5, base, "en", "src1", 1), (5, base, "en", "src1", 1), (5, "other text here", None, None, 3)]
    return rows


def frame(spark, rows: list[tuple], clashing: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING if clashing else ():
        df = df.withColumn(name, F.lit(name))
    return df


def empty(spark):
    return frame(spark, [])
