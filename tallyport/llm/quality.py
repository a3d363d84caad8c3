"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, chosen pairs of features have one over a
coarse grid. Boosting goes round all features again and again: each turn fits a tree of
at most four leaves to the bins of one feature, against the current errors, and adds a
small part of it to the table. Pairs follow in the same way, on the errors that single
features leave. A score is a sum of looked-up additions through the logistic function,
vectorised over a batch.

Features come from the text alone. The model is fitted on at most MAX_TRAIN labelled
documents, the first by the hash of their id, which is the only sample taken; every
document is scored from its whole text, in one pass without a shuffle.

Defined cases: null and empty texts have the features of no words and get a score like
any other; labels without id or quality are ignored and several labels of one id are
averaged (1 from one half on); without labels of both kinds every score is the share
of good labels, one half if there are none. A null id is not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm.common import packed, table, unpacked

THRESHOLD = 0.3
MAX_TRAIN = 20_000
BINS, GRID, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
FEATURES = ("log_words", "word_length", "distinct", "repeats", "upper", "digits", "stops", "symbols", "non_ascii",
            "line_rate", "same_lines", "top_word")

_BYTE = np.arange(256)
_UPPER, _LOWER = (_BYTE >= 65) & (_BYTE <= 90), (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT, _STOP = (_BYTE >= 48) & (_BYTE <= 57), np.isin(_BYTE, list(b".,;:?"))
_SPACE, _HIGH = np.isin(_BYTE, list(b" \t\n\r\x0b\x0c")), _BYTE >= 128
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _STOP | _SPACE | _HIGH)


def features(text: str | None) -> list[float]:
    data = text.encode() if text else b""
    words = data.split()
    n, counts = len(words), np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, solid = counts[_UPPER | _LOWER | _HIGH].sum(), max(1, counts[~_SPACE].sum())
    by_word: dict[bytes, int] = {}
    for w in words:
        by_word[w] = by_word.get(w, 0) + 1
    lines = data.split(b"\n") if data else []
    many = max(1, n)
    return [
        np.log1p(n), counts[~_SPACE].sum() / many, len(by_word) / many,
        sum(map(bytes.__eq__, words, words[1:])) / many, counts[_UPPER].sum() / max(1, letters),
        counts[_DIGIT].sum() / solid, counts[_STOP].sum() / solid, counts[_SYMBOL].sum() / solid, counts[_HIGH].sum() / solid,
        len(lines) / many, 1 - len(set(lines)) / max(1, len(lines)), max(by_word.values(), default=0) / many,
    ]


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, int]:
    """The gain and place of the best cut of ordered bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    at = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[at]), at + 1) if len(gain) else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0) -> np.ndarray:
    """A step function over the bins: 2 ** depth leaves at most."""
    gain, at = _best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The better of: cut rows, then each part by columns; or the other way round."""
    options = []
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, at = _best_cut(a.sum(1), b.sum(1))
        out, gain = np.zeros_like(a), 0.0
        for part in (slice(0, at), slice(at, None)):
            out[part] = _tree(a[part].sum(0), b[part].sum(0), 1)[None, :]
            gain += _best_cut(a[part].sum(0), b[part].sum(0))[0]
        options.append((gain, out.T if turned else out))
    return max(options, key=lambda o: o[0])


class AdditiveModel:
    """Edges of bins, one table for each feature, one for each chosen pair."""

    def __init__(self, prior: float = 0.5):
        clipped = min(max(prior, 1e-3), 1 - 1e-3)
        self.base = float(np.log(clipped / (1 - clipped)))
        self.edges: list[np.ndarray] = []
        self.grid: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        if len(y) == 0 or y.min() == y.max():
            return self
        cut = lambda col, n: np.unique(np.quantile(col, np.arange(1, n) / n))
        self.edges = [cut(c, BINS) for c in x.T]
        self.grid = [cut(c, GRID) for c in x.T]
        bins = [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]
        cells = [np.searchsorted(e, c, side="right") for e, c in zip(self.grid, x.T)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        total = np.full(len(y), self.base)

        def errors():
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for f, t in enumerate(self.tables):
                g, h = errors()
                step = RATE * _tree(np.bincount(bins[f], g, len(t)), np.bincount(bins[f], h, len(t)))
                t += step
                total += step[bins[f]]

        def squares(i, j):
            g, h = errors()
            shape = (len(self.grid[i]) + 1, len(self.grid[j]) + 1)
            at = cells[i] * shape[1] + cells[j]
            n = shape[0] * shape[1]
            return np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape), at

        every = [(i, j) for i in range(x.shape[1]) for j in range(i)]
        strongest = sorted(every, key=lambda p: -_pair_tree(*squares(*p)[:2])[0])[:PAIRS]
        self.pairs = [(i, j, np.zeros((len(self.grid[i]) + 1, len(self.grid[j]) + 1))) for i, j in strongest]
        for _ in range(PAIR_ROUNDS):
            for i, j, t in self.pairs:
                g, h, at = squares(i, j)
                step = RATE * _pair_tree(g, h)[1]
                t += step
                total += step.ravel()[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            total += t[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for i, j, t in self.pairs:
            total += t[np.searchsorted(self.grid[i], x[:, i], side="right"), np.searchsorted(self.grid[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> AdditiveModel:
    """The model of the labelled documents that are not held out, `max_train` of them at most."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out(F.col("doc_id")))
    wanted = marks.groupBy(F.col("doc_id").alias("marked_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("good"))
    chosen = F.broadcast(wanted.orderBy(F.xxhash64("marked_id"), "marked_id").limit(max_train))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("marked_id")).select("good", "text")

    def work(batches):
        for batch in batches:
            x = feature_matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("good"), *map(pa.array, x.T.copy())], ["good", *FEATURES])

    schema = ", ".join(f"{n} double" for n in ("good", *FEATURES))
    seen = texts.mapInArrow(work, schema).limit(max_train).toPandas().to_numpy(np.float64).reshape(-1, 1 + len(FEATURES))
    seen = seen[np.lexsort(seen.T)]
    y = seen[:, 0]
    return AdditiveModel(float(y.mean()) if len(y) else 0.5).fit(seen[:, 1:], y)


def scored(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD, carry: list[str] | None = None,
           only_kept: bool = False) -> DataFrame:
    """doc (the row, or its columns in `carry`), score, predicted; only the accepted rows if asked for."""
    columns = carry or docs.columns
    rows = packed(docs)
    doc_type = T.StructType([docs.schema[c] for c in columns])

    def work(batches):
        for batch in batches:
            doc = batch.column("doc")
            score = model.score(feature_matrix(doc.field("text").to_pylist()))
            out = doc if columns == [f.name for f in doc.type] else pa.StructArray.from_arrays(
                [doc.field(c) for c in columns], fields=[doc.type.field(c) for c in columns])
            predicted = (score >= threshold).astype(np.int32)
            made = pa.RecordBatch.from_arrays([out, pa.array(score), pa.array(predicted)], ["doc", "score", "predicted"])
            yield made.filter(pa.array(predicted == 1)) if only_kept else made

    schema = T.StructType([T.StructField("doc", doc_type), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(work, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier accepts, unchanged."""
    return scored(docs, fit(docs, labels), threshold, only_kept=True).select(*unpacked(docs))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")), carry=["doc_id"])
    return out.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")
