"""Quality classifier by co-training two views of a document.

The content view is a linear model over hashed byte trigrams and hashed four-grams of the text's shape (letters, capitals, digits,
white space and single marks). The metadata view is a linear model over the document's source and language, its length and how
it is laid out (lines, repeats, shares of symbols, capitals and digits). Both start from labelled documents. In each
round either view labels the unlabelled documents that it is most sure of, good and bad in the labelled proportion, and
they join the other view's training set. Held-out labels then calibrate each view (a logistic curve over its margin) and fit
how the two are combined. A second holdout sets the cutoff: least cost, with at most ``max_false_rejection`` of the good
rows rejected.

The first models are fitted on a bounded sample of labelled rows, the ``labelled`` documents with the smallest hashes of their ids.
In each round every unlabelled document is scored by Spark, and the most and least likely of all of them, ``exchanged`` per view (equal
texts once), join the fit: only their feature vectors, of fixed width, reach the driver. Every document is scored in the end.

Null and empty texts have zero content features and are scored like any other. A document whose labels disagree counts as
good; null ids and labels are ignored. Documents with equal ids are sampled once, scored each. Without labels of both classes
there is nothing to learn: scores are null and every document is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import text as tx
from tradewind.llm.frames import map_batches, quoted, rewrite_batches, stored
from tradewind.llm.quality_rules import measure

U = np.uint64
RAW, SHAPE = 1024, 1024
SOURCES, LANGS = 64, 32
GRID = (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9)
LENGTHS = (1, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 20000)
WORD_SIZES = (2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15, 25)
LINE_SIZES = (10, 20, 40, 60, 80, 120, 200, 400, 1000)
ROUNDS, SURE = 2, 0.95


def shape_of(byte: int) -> int:
    c = chr(byte)
    if byte >= 0x80:
        return ord("z")
    return ord("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c)


SHAPES = np.array([shape_of(b) for b in range(256)], np.uint8)


def grams(data: np.ndarray, offsets: np.ndarray, size: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slot of every ``size`` consecutive bytes, four at most, and which of them lie within one row."""
    n = max(0, len(data) - size + 1)
    key = data[:n].astype(np.uint32)
    for k in range(1, size):
        key <<= np.uint32(8)
        key |= data[k:k + n]
    key *= np.uint32(0x9E3779B1)
    key >>= np.uint32(33 - width.bit_length())
    whole = np.ones(n, bool)
    for k in range(1, size):  # starts from which a row's end is nearer than the gram is long
        late = offsets[1:] - k
        whole[late[(late >= 0) & (late < n)]] = False
    return key.view(np.int32), whole


def content_grams(data, offsets):
    """(slot, within a row) of both families; shape slots follow the raw ones."""
    raw, shape = grams(data, offsets, 3, RAW), grams(SHAPES[data], offsets, 4, SHAPE)
    return raw, (shape[0] + RAW, shape[1])


def content_matrix(data, offsets) -> np.ndarray:
    """Relative frequencies of each family's slots, a row per text."""
    rows = len(offsets) - 1
    out = np.zeros((rows, RAW + SHAPE), np.float32)
    for slot, whole in content_grams(data, offsets):
        row = np.repeat(np.arange(rows), np.diff(offsets))[:len(slot)][whole]
        count = np.bincount(row * (RAW + SHAPE) + slot[whole], minlength=out.size).reshape(out.shape)
        out += count / np.maximum(1, count.sum(axis=1, keepdims=True))
    return out


def content_margin(data, offsets, weights: np.ndarray) -> np.ndarray:
    """The matrix times the weights, without the matrix."""
    out = np.zeros(len(offsets) - 1)
    for slot, whole in content_grams(data, offsets):
        total, count = np.zeros(len(slot) + 1), np.zeros(len(slot) + 1, np.int64)
        np.cumsum(weights[slot] * whole, out=total[1:])
        np.cumsum(whole, out=count[1:])
        lo, hi = np.minimum(offsets[:-1], len(slot)), np.minimum(offsets[1:], len(slot))
        out += (total[hi] - total[lo]) / np.maximum(1, count[hi] - count[lo])
    return out


def hashed(values: list, width: int) -> np.ndarray:
    """Slot of each text; null has its own."""
    data, offsets = tx.flat(pa.array(values, pa.string()))
    slot = (tx.span_hashes(data, offsets[:-1], offsets[1:]) % U(width - 1)).astype(np.int64) + 1
    slot[[v is None for v in values]] = 0
    return slot


def metadata_matrix(data, offsets, sources: list, langs: list) -> np.ndarray:
    """Indicator features: hashed source and language, and each measure against its grid."""
    rows = len(offsets) - 1
    m = measure(data, offsets)
    lines = tx.count_in(data == 0x0A, offsets) + 1
    chars = tx.count_in(tx.character_starts(data), offsets)
    columns = [np.eye(SOURCES, dtype=np.float32)[hashed(sources, SOURCES)], np.eye(LANGS, dtype=np.float32)[hashed(langs, LANGS)]]
    for name in ("symbol_share", "upper_share", "digit_share", "dup_line_share", "repeat_share", "mark_word_share"):
        columns.append(m[name][:, None] > np.array(GRID))
    columns.append(m["n_words"][:, None] >= np.array(LENGTHS))
    columns.append(m["mean_word"][:, None] > np.array(WORD_SIZES))
    columns.append((chars / lines)[:, None] > np.array(LINE_SIZES))
    return np.concatenate([np.asarray(c, np.float32).reshape(rows, -1) for c in columns], axis=1)


def sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, np.float64)))


@dataclass
class Linear:
    """A linear margin; the scaling of the features is folded into the weights."""

    weights: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.astype(x.dtype) + self.bias

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> "Linear":
        """Logistic regression with equal weight of both classes, by Adam on all rows; rows with y < 0 are left out.

        Features are scaled inside the sums, so that no scaled copy of the matrix is made.
        """
        mean = x.mean(axis=0, dtype=np.float64)
        spread = np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x) / len(x) - mean * mean, 0.0))
        scale = 1 / (spread + spread.mean() * 0.5 + 1e-9)
        good, bad = y == 1, y == 0
        share = good * (0.5 / max(1, good.sum())) + bad * (0.5 / max(1, bad.sum()))
        w, b = np.zeros(x.shape[1]), 0.0
        first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for t in range(1, steps + 1):
            v = w * scale
            error = share * (sigmoid(x @ v.astype(np.float32) - mean @ v + b) - good)
            total = error.sum()
            g = np.append((error.astype(np.float32) @ x - total * mean) * scale + penalty * w, total)
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            move = 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
            w -= move[:-1]
            b -= move[-1]
        weights = w * scale
        return cls(weights, float(b - mean @ weights))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Coefficients (intercept last) of a small logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    content: Linear
    metadata: Linear
    content_curve: np.ndarray
    metadata_curve: np.ndarray
    blend: np.ndarray
    cutoff: float

    def blended(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of being good: content, metadata, both."""
        a = content * self.content_curve[0] + self.content_curve[1]
        b = metadata * self.metadata_curve[0] + self.metadata_curve[1]
        return sigmoid(a), sigmoid(b), sigmoid(np.clip(a, -12, 12) * self.blend[0] + np.clip(b, -12, 12) * self.blend[1] + self.blend[2])

    def score(self, data, offsets, sources, langs):
        return self.blended(content_margin(data, offsets, self.content.weights) + self.content.bias,
                            self.metadata.margin(metadata_matrix(data, offsets, sources, langs)))


class CoTraining:
    """Two views' training sets, which grow by what the other view is sure of; folds 0 and 1 train, 2 calibrates, 3 sets the cutoff."""

    def __init__(self, rows: pa.Table):
        self.ids = rows["doc_id"].to_numpy()
        self.views = [matrix(rows["content"], np.float16), matrix(rows["metadata"], np.uint8)]
        self.truth = rows["quality"].to_numpy()
        self.fold = rows["fold"].to_numpy()
        self.labels = [np.where(self.fold < 2, self.truth, -1) for _ in self.views]

    def teachable(self) -> bool:
        return (len(set(self.truth[self.fold < 2].tolist())) == 2 and len(set(self.truth[self.fold == 2].tolist())) == 2
                and bool(((self.truth == 1) & (self.fold == 3)).any()))

    def fit_views(self) -> list[Linear]:
        return [Linear.fit(x, y) for x, y in zip(self.views, self.labels, strict=True)]

    def learn(self, chosen: pa.Table, rows: pa.Table) -> None:
        """What one view chose (doc_id, view, label) joins the other's training set; ``rows`` has the features of documents new to both."""
        new = len(rows)
        self.ids = np.concatenate([self.ids, rows["doc_id"].to_numpy()])
        self.truth, self.fold = np.append(self.truth, np.full(new, -1)), np.append(self.fold, np.full(new, -1))
        self.labels = [np.append(y, np.full(new, -1)) for y in self.labels]
        for k, kind in enumerate((np.float16, np.uint8)):
            if new:
                self.views[k] = np.concatenate([self.views[k], matrix(rows[("content", "metadata")[k]], kind)])
        place = {d: k for k, d in enumerate(self.ids.tolist())}
        for doc, view, label in zip(*(chosen[c].to_pylist() for c in ("doc_id", "view", "label")), strict=True):
            if doc in place:
                self.labels[1 - view][place[doc]] = label

    def blend(self, models: list[Linear], max_false_rejection: float) -> Model:
        """Calibrated views, how they combine, and the cutoff."""
        margins = [m.margin(x) for m, x in zip(models, self.views, strict=True)]
        held, y = self.fold == 2, self.truth
        curves = [logistic(m[held][:, None], y[held]) for m in margins]
        both = np.column_stack([np.clip(m[held] * c[0] + c[1], -12, 12) for m, c in zip(margins, curves, strict=True)])
        model = Model(*models, *curves, logistic(both, y[held]), 0.0)
        last = model.blended(*margins)[2]
        good, bad = (np.sort(last[(y == label) & (self.fold == 3)]) for label in (1, 0))
        model.cutoff = best_cutoff(good, bad, max_false_rejection)
        return model


def best_cutoff(good: np.ndarray, bad: np.ndarray, max_false_rejection: float, weight: int = 5) -> float:
    """The cutoff of least cost on sorted holdout scores, a wrongly rejected row counting ``weight`` wrongly kept ones.

    The middle of a range of equal cost is taken; the share of rejected good rows never exceeds the limit.
    """
    scores = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[0.0], (scores[1:] + scores[:-1]) / 2])
    lost = np.searchsorted(good, cuts)
    cost = weight * lost + len(bad) - np.searchsorted(bad, cuts)
    allowed = lost <= max_false_rejection * len(good)
    least = np.flatnonzero(allowed & (cost == cost[allowed].min()))
    return float(cuts[least[len(least) // 2]])


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"),
                       quoted(source_col).cast("string").alias("source"), quoted(lang_col).cast("string").alias("lang"))


FEATURES = "doc_id long, quality int, content binary, metadata binary"


def features_of(rows: DataFrame) -> pa.Table:
    """(doc_id, quality, content, metadata, fold) of few documents, each id once."""

    def run(batch):
        for lo, hi, data, offsets in tx.parts(batch.column(1)):
            some = batch.slice(lo, hi - lo)
            content = content_matrix(data, offsets).astype(np.float16)
            metadata = metadata_matrix(data, offsets, some.column(2).to_pylist(), some.column(3).to_pylist()).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(4), pa.array([r.tobytes() for r in content], pa.binary()),
                 pa.array([r.tobytes() for r in metadata], pa.binary())], ["doc_id", "quality", "content", "metadata"])

    found = map_batches(rows, run, FEATURES)
    found = found.groupBy("doc_id", "quality").agg(F.min(F.struct("content", "metadata")).alias("x")).select("doc_id", "quality", "x.*")
    return found.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4))).orderBy("doc_id").toArrow()


def surest(narrow: DataFrame, known: DataFrame, models: list[Linear], good: int, bad: int) -> pa.Table:
    """(doc_id, view, label): what each view is surest of among all documents without a label, at most ``good`` and ``bad`` of them.

    All documents are scored. Documents of equal margins, as copies are, stand for one.
    """
    content, metadata = models

    def run(batch):
        for lo, hi, data, offsets in tx.parts(batch.column(1)):
            some = batch.slice(lo, hi - lo)
            margins = (content_margin(data, offsets, content.weights) + content.bias,
                       metadata.margin(metadata_matrix(data, offsets, some.column(2).to_pylist(), some.column(3).to_pylist())))
            yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array(m, pa.float64()) for m in margins]], ["doc_id", "content", "metadata"])

    margins = map_batches(narrow.where("doc_id is not null"), run, "doc_id long, content double, metadata double")
    open_ = margins.join(known.select("doc_id"), "doc_id", "left_anti")
    ranked = stored(open_.groupBy("content", "metadata").agg(F.min("doc_id").alias("doc_id")), "margins")
    edge = float(np.log(SURE / (1 - SURE)))
    chosen = []
    for view, name in enumerate(("content", "metadata")):
        for label, sure, order, count in ((1, F.col(name) >= edge, F.desc(name), good), (0, F.col(name) <= -edge, F.asc(name), bad)):
            chosen.append(ranked.where(sure).orderBy(order, "doc_id").limit(count).select(
                "doc_id", F.lit(view).alias("view"), F.lit(label).alias("label")))
    union = chosen[0]
    for more in chosen[1:]:
        union = union.unionByName(more)
    return union.toArrow()


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 4000, exchanged: int = 150, max_false_rejection: float = 0.01,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> Model | None:
    """The model. The driver holds at most ``labelled + 2 * ROUNDS * exchanged`` feature vectors of fixed width."""
    narrow = _narrow(docs, id_col, text_col, source_col, lang_col)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")))
    ids = narrow.select("doc_id").where("doc_id is not null").distinct()
    sample = stored(ids.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "sample")
    rows = features_of(narrow.join(sample, "doc_id").select(*narrow.columns, "quality"))
    if not rows.num_rows:
        return None
    state = CoTraining(rows)
    del rows
    if not state.teachable():
        return None
    share = float(state.truth[state.fold < 2].mean())
    models = state.fit_views()
    for _ in range(ROUNDS):
        chosen = surest(narrow, known, models, max(1, int(exchanged * share)), max(1, int(exchanged * (1 - share))))
        new = sorted(set(chosen["doc_id"].to_pylist()) - set(state.ids.tolist()))
        if not chosen.num_rows:
            break
        # as many ids as views choose in a round, at most
        wanted = F.broadcast(docs.sparkSession.createDataFrame([(d, -1) for d in new], "doc_id long, quality int"))
        state.learn(chosen, features_of(narrow.join(wanted, "doc_id").select(*narrow.columns, "quality")))
        models = state.fit_views()
    return state.blend(models, max_false_rejection)


def matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Rows of packed numbers as one matrix."""
    out = None
    for k, row in enumerate(column):
        values = np.frombuffer(row.as_buffer(), kind)
        out = np.zeros((len(column), len(values)), np.float32) if out is None else out
        out[k] = values
    return out


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang") -> DataFrame:
    """(doc_id, content_score, metadata_score, score, kept) of every row."""

    def run(batch):
        for lo, hi, data, offsets in tx.parts(batch.column(1)):
            some = batch.slice(lo, hi - lo)
            if model is None:
                found, kept = [np.full(hi - lo, np.nan)] * 3, np.ones(hi - lo, bool)
            else:
                found = model.score(data, offsets, some.column(2).to_pylist(), some.column(3).to_pylist())
                kept = found[2] >= model.cutoff
            yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array(f, pa.float64(), from_pandas=True) for f in found],
                                              pa.array(kept)], ["doc_id", "content_score", "metadata_score", "score", "kept"])

    return map_batches(_narrow(docs, id_col, text_col, source_col, lang_col), run,
                       "doc_id long, content_score double, metadata_score double, score double, kept boolean")


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text", source_col: str = "source",
              lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the model keeps, columns unchanged."""
    if model is None:
        return docs
    places = [docs.columns.index(c) for c in (text_col, source_col, lang_col)]

    def run(batch):
        text, source, lang = (batch.column(p).cast(pa.string()) for p in places)
        kept = [model.score(data, offsets, source.slice(lo, hi - lo).to_pylist(), lang.slice(lo, hi - lo).to_pylist())[2]
                for lo, hi, data, offsets in tx.parts(text)]
        yield batch.filter(pa.array(np.concatenate(kept) >= model.cutoff))

    return rewrite_batches(docs, run)
