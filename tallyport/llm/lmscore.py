"""Language-model scores by masked pseudo-likelihood.

Every token is predicted from the words on both its sides by a small network, and the
logarithms of these conditional probabilities are summed over a document.

Tokens are words, and hash buckets for the words that are too rare to be one. Both grow
with the corpus: LIKE_HEAPS times the root of its length in words are kept, the most frequent
ones, VOCABULARY at least, and a fourth as many buckets.

The network has a vector for each token on the left and on the right; their sum through
tanh is the hidden layer, from which the masked token is predicted by a softmax in three
steps: its class, its group within the class, itself within the group. So each of all
tokens has its own probability in each context, and these sum up to one. The first
OWN_CLASS words have a class each, the others lie in classes by frequency.

Trained on every token of the corpus, by sums over all of it, in three steps:

1. Class triples (left, token, right) are counted, and the layers of the classes are
   trained on the counts.
2. The gradient by the hidden layer is summed for each token as a left and as a right
   neighbour. A Newton step takes each token's vectors from those of its class; the
   curvature is that of the class.
3. The hidden layer is summed for each token as the masked one. The output layers of groups
   and tokens are the linear discriminant of these means, with the covariance of the class.

Sums are whole numbers (of 2^-FRACTION), so they don't depend on the order of tasks. Word
counts and sums of documents stay on the cluster; what reaches the driver, and each task, is
the vocabulary and three vectors a token.

Defined cases: a null text or one without words has no tokens, log_prob 0 and a null
mean; a document's edges are a context token of their own; words with equal counts are
ranked by their bytes; an empty corpus gives no rows.
"""

from __future__ import annotations

from itertools import repeat
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm import shingles
from tallyport.llm.common import Stage, lower_ascii, table

VOCABULARY, BUCKETS, LIKE_HEAPS = 4_096, 1_024, 4
CLASSES, OWN_CLASS, BUCKET_CLASSES = 64, 40, 8
HIDDEN, STEPS, RATE = 32, 250, 0.03
SIDE = CLASSES + 1  # context classes: all classes, and the edge of a document
TRIPLES = SIDE * SIDE * CLASSES
# Occurrences that the vector of the class, or of the group, counts for against a token's own.
PRIOR_SIDE, PRIOR_OUT, RIDGE = 300.0, 100.0, 0.1
FRACTION = 12
# Tokens that are sorted at once, and whose vectors are held at once.
AT_ONCE, IN_CACHE = 262_144, 16_384
# Occurrences a task sums up for each token it may send a sum of.
OCCURRENCES = 96


class Vocabulary(dict):
    """Token of each word; then come the buckets, then the edge of a document."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.words = max(VOCABULARY, len(words))
        self.buckets = max(BUCKETS, self.words // 4)
        self.edge = self.words + self.buckets

    def __reduce__(self):
        return Vocabulary, (list(self),)


def token_classes(words: int = VOCABULARY, buckets: int = BUCKETS) -> np.ndarray:
    """Class of each token: the first words have their own, then come bands of rank, then hash buckets."""
    rank = np.arange(OWN_CLASS, words)
    bands = CLASSES - OWN_CLASS - BUCKET_CLASSES
    band = np.floor(np.log(rank / OWN_CLASS) / np.log(words / OWN_CLASS) * bands).astype(int)
    bucket = np.arange(buckets) * BUCKET_CLASSES // buckets
    return np.concatenate([np.arange(OWN_CLASS), OWN_CLASS + band, CLASSES - BUCKET_CLASSES + bucket])


def tokens(text: str | None, vocabulary: Vocabulary) -> np.ndarray:
    words = shingles.lower_words(text)
    found = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
    rare = np.flatnonzero(found < 0)
    if len(rare):
        found[rare] = [vocabulary.words + xxhash.xxh3_64_intdigest(words[i]) % vocabulary.buckets for i in rare.tolist()]
    return found


def windows(flat: np.ndarray, edge: int, most: int):
    """(places, left, token, right) of all tokens, `most` at a time. `flat`: documents between edges."""
    at = np.flatnonzero(flat != edge)
    for part in (at[i : i + most] for i in range(0, len(at), most)):
        yield part, flat[part - 1], flat[part], flat[part + 1]


class WindowNetwork:
    """log p(class | left class, right class), trained on triple counts."""

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, rate: float = RATE, seed: int = 0):
        grid = counts.reshape(SIDE * SIDE, CLASSES).astype(np.float64)
        seen = np.flatnonzero(grid.sum(1))
        rng = np.random.default_rng(seed)
        share = (grid.sum(0) + 1) / (grid.sum() + CLASSES)
        self.weights = [rng.normal(0, 0.3, (SIDE, hidden)), rng.normal(0, 0.3, (SIDE, hidden)), np.zeros(hidden),
                        rng.normal(0, 0.1, (hidden, CLASSES)), np.log(share)]
        if len(seen):
            self._train(grid[seen] / grid.sum(), seen // SIDE, seen % SIDE, steps, rate)

    def _forward(self, left, right):
        from_left, from_right, shift, out, base = self.weights
        h = np.tanh(from_left[left] + from_right[right] + shift)
        z = h @ out + base
        z -= z.max(1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(1, keepdims=True))

    def _train(self, target, left, right, steps, rate):
        """Adam on the exact gradient over all contexts."""
        mass = target.sum(1, keepdims=True)
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        pick = [(np.arange(SIDE)[:, None] == side[None, :]).astype(np.float64) for side in (left, right)]
        for step in range(1, steps + 1):
            h, logp = self._forward(left, right)
            dz = np.exp(logp) * mass - target
            dh = (dz @ self.weights[3].T) * (1 - h * h)
            for k, g in enumerate((pick[0] @ dh, pick[1] @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                scale = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-10
                self.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / scale

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer and p of each class, for each pair of context classes."""
        at = np.arange(SIDE * SIDE)
        h, logp = self._forward(at // SIDE, at % SIDE)
        return h, np.exp(logp)


def vocabulary_size(total: int) -> int:
    """Words kept of a corpus of `total` words."""
    return max(VOCABULARY, LIKE_HEAPS * isqrt(total))


def frequent_words(docs: DataFrame, stage: Stage) -> list[str]:
    """The most frequent words of the corpus, as many as are tokens, by falling count."""
    words = docs.select(F.explode(F.split(lower_ascii(F.col("text")), r"[\x20\x09-\x0D]+")).alias("word")).filter("word <> ''")
    counted = stage.keep(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    # How many words have each count: some thousand rows, whatever the corpus.
    by_count = sorted(((r.n, r.words) for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    size = left = vocabulary_size(sum(n * k for n, k in by_count))
    least = 1
    for n, k in by_count:
        if left > 0:
            least, left = n, left - k
    kept = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size).select("word").toArrow()
    stage.drop(counted)
    return kept["word"].to_pylist()


def tokenised(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(tokens): the tokens of each document and the edge behind them, as 32-bit numbers."""

    def work(batches):
        for batch in batches:
            found = [np.append(tokens(t, vocabulary), vocabulary.edge).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["tokens"])

    return docs.select("text").mapInArrow(work, "tokens binary")


def corpus_windows(batches, edge: int, most: int = 2 * IN_CACHE):
    """windows() of all documents in batches of tokenised()."""
    first = np.array(edge, "<i4").tobytes()
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            flat = np.frombuffer(b"".join([first, *batch.column("tokens").slice(i, 512).to_pylist()]), "<i4")
            yield from windows(flat, edge, most)


def count_triples(tokenised_docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Counts of all class triples, then of all tokens, over the whole corpus."""
    edge, classes = vocabulary.edge, np.append(token_classes(vocabulary.words, vocabulary.buckets), CLASSES)

    def work(batches):
        total = np.zeros(TRIPLES + edge, np.int64)
        for _, left, token, right in corpus_windows(batches, edge, AT_ONCE):
            total[:TRIPLES] += np.bincount((classes[left] * SIDE + classes[right]) * CLASSES + classes[token], minlength=TRIPLES)
            total[TRIPLES:] += np.bincount(token, minlength=edge)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["at", "n"])

    parts = tokenised_docs.mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TRIPLES + edge, np.int64)
    counts[parts["at"].to_numpy()] = parts["n"].to_numpy()
    return counts


class Sums:
    """Adds up vectors by number: the sum of a task's, in whole numbers of 2^-FRACTION."""

    def __init__(self, rows: int):
        self.total = np.zeros((rows, HIDDEN))

    def add(self, at: np.ndarray, vectors: np.ndarray) -> None:
        """`at` in rising order."""
        if not len(at):
            return
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        self.total[at[first]] += np.add.reduceat(vectors, first, axis=0)

    def batches(self):
        every = np.flatnonzero(self.total.any(1))
        for at in (every[i : i + IN_CACHE] for i in range(0, len(every), IN_CACHE)):
            whole = np.rint(self.total[at] * 2.0**FRACTION).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *map(pa.array, whole.T.copy())], ["at", *SUM_COLUMNS])


SUM_COLUMNS = [f"s{i}" for i in range(HIDDEN)]


def summed(tokenised_docs: DataFrame, work, rows: int, total: int) -> np.ndarray:
    """The sums that the tasks' Sums give, over the whole corpus of `total` tokens.

    A task sends a sum for each token it meets, so tasks are merged to OCCURRENCES for each row.
    """
    merged = tokenised_docs.coalesce(max(1, total // (OCCURRENCES * rows)))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ["at", *SUM_COLUMNS]])
    parts = merged.mapInArrow(work, schema).groupBy("at").agg(*[F.sum(c).alias(c) for c in SUM_COLUMNS]).toArrow()
    out = np.zeros((rows, HIDDEN))
    out[parts["at"].to_numpy()] = np.stack([parts[c].to_numpy() for c in SUM_COLUMNS], axis=1) / 2.0**FRACTION
    return out


class Model:
    """Log-probabilities of tokens in their places; `fit` trains the layers of the tokens, after those of the classes."""

    def __init__(self, vocabulary: Vocabulary, counts: np.ndarray):
        self.vocabulary, self.classes = vocabulary, token_classes(vocabulary.words, vocabulary.buckets)
        self.by_token, self.triples = counts[TRIPLES:].astype(np.float64), counts[:TRIPLES].reshape(SIDE * SIDE, CLASSES)
        self.network = WindowNetwork(counts[:TRIPLES])
        from_left, from_right, shift, out, base = self.network.weights
        context = np.append(self.classes, CLASSES)
        self.left, self.right = (from_left[context] + shift).astype(np.float32), from_right[context].astype(np.float32)
        self.class_layer = self._single(out.T, base)
        self.set_outputs(np.zeros((len(self.classes), HIDDEN)), np.zeros((CLASSES, HIDDEN, HIDDEN)))

    @property
    def log_triple(self) -> np.ndarray:
        """log p of each class triple, by the vectors of the classes: those of the words that have a class of their own."""
        from_left, from_right, shift, _, _ = self.network.weights
        at = np.arange(SIDE * SIDE)
        h = np.tanh((from_left + shift).astype(np.float32)[at // SIDE] + from_right.astype(np.float32)[at % SIDE])
        return np.stack([self._picked(self.class_layer, h, np.full(len(h), c)) for c in range(CLASSES)], axis=1).ravel()

    def hidden(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        h = self.left.take(left, axis=0)
        h += self.right.take(right, axis=0)
        return np.tanh(h, out=h)

    # -- vectors of the neighbours

    def side_sums(self, tokenised_docs: DataFrame) -> np.ndarray:
        """Gradient of the log-likelihood by the hidden layer's input, summed by left token, then by right token."""
        edge, classes = self.vocabulary.edge, np.append(self.classes, CLASSES)
        h, p = self.network.contexts()
        slope, usual, out = (1 - h * h).astype(np.float32), (p @ self.network.weights[3].T).astype(np.float32), self.class_layer[0]

        def work(batches):
            sums = Sums(2 * edge)
            for _, left, token, right in corpus_windows(batches, edge):
                context = classes[left] * SIDE + classes[right]
                gradient = out.take(classes[token], axis=0)
                gradient -= usual.take(context, axis=0)
                gradient *= slope.take(context, axis=0)
                for side, first in ((left, 0), (right, edge)):
                    order = np.argsort(side)
                    at = side[order]
                    some = slice(*np.searchsorted(at, (OWN_CLASS, edge)))
                    sums.add(at[some] + first, gradient.take(order[some], axis=0))
            yield from sums.batches()

        return summed(tokenised_docs, work, 2 * edge, int(self.by_token.sum()))

    def set_sides(self, sums: np.ndarray) -> None:
        """A Newton step from the vectors of the class, for the tokens that share one."""
        h, p = self.network.contexts()
        steep = (1 - h * h)[:, :, None] * self.network.weights[3][None, :, :]
        mean = np.einsum("khc,kc->kh", steep, p)
        mass = self.triples.sum(1).astype(np.float64)
        for side, vectors in ((0, self.left), (1, self.right)):
            of = np.arange(SIDE * SIDE) // SIDE if side == 0 else np.arange(SIDE * SIDE) % SIDE
            for c in range(OWN_CLASS, CLASSES):
                own, at = np.flatnonzero(self.classes == c), np.flatnonzero((of == c) & (mass > 0))
                if not len(at):
                    continue
                share = mass[at] / mass[at].sum()
                curve = np.einsum("khc,kc,kgc->hg", steep[at], p[at] * share[:, None], steep[at], optimize=True)
                curve -= np.einsum("kh,k,kg->hg", mean[at], share, mean[at], optimize=True)
                curve += RIDGE * np.trace(curve) / HIDDEN * np.eye(HIDDEN) + 1e-9 * np.eye(HIDDEN)
                step = np.linalg.solve(curve, sums[own + side * len(self.classes)].T).T
                vectors[own] += (step / (self.by_token[own] + PRIOR_SIDE)[:, None]).astype(np.float32)

    # -- output layers

    def output_sums(self, tokenised_docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer summed by token, and its products summed by class."""
        edge, starts = self.vocabulary.edge, np.searchsorted(self.classes, np.arange(CLASSES + 1))

        def work(batches):
            sums, products = Sums(edge + CLASSES * HIDDEN), np.zeros((CLASSES, HIDDEN, HIDDEN))
            for _, left, token, right in corpus_windows(batches, edge):
                order = np.argsort(token)
                order = order[np.searchsorted(token[order], OWN_CLASS) :]
                token, h = token[order], self.hidden(left[order], right[order])
                sums.add(token, h)
                ends = np.searchsorted(token, starts)
                for c in range(OWN_CLASS, CLASSES):
                    own = h[ends[c] : ends[c + 1]]
                    products[c] += own.T @ own
            sums.total[edge:] = products.reshape(-1, HIDDEN)
            yield from sums.batches()

        found = summed(tokenised_docs, work, edge + CLASSES * HIDDEN, int(self.by_token.sum()))
        return found[:edge], found[edge:].reshape(CLASSES, HIDDEN, HIDDEN)

    @staticmethod
    def _discriminant(mean, spread, n, sums):
        """(weights, biases): log-linear in the hidden layer, for children with n rows and sums of it."""
        apart = (sums - n[:, None] * mean) / (n + PRIOR_OUT)[:, None]
        weights = np.linalg.solve(spread, apart.T).T
        share = np.maximum(n, 0.5)
        return weights, np.log(share / share.sum()) - 0.5 * (weights * apart).sum(1) - weights @ mean

    def set_outputs(self, sums: np.ndarray, products: np.ndarray) -> None:
        """Groups of the tokens of a class, alike in what stands beside them, and their layers. Groups of a class are numbered in a row."""
        self.group, self.inside = np.zeros(len(self.classes), np.int64), np.zeros(len(self.classes), np.int64)
        self.group_layers, self.token_layers, self.first_group = {}, [], np.zeros(CLASSES + 1, np.int64)
        for c in range(CLASSES):
            own = np.flatnonzero(self.classes == c)
            self.first_group[c] = len(self.token_layers)
            n, by_own = self.by_token[own], sums[own]
            mean = by_own.sum(0) / max(n.sum(), 1)
            spread = products[c] / max(n.sum(), 1) - np.outer(mean, mean)
            spread += (RIDGE * np.trace(spread) / HIDDEN + 1e-6) * np.eye(HIDDEN)
            # By their place along the direction in which the tokens differ most, cut into groups.
            apart = (by_own - n[:, None] * mean) / (n + PRIOR_OUT)[:, None]
            axis = np.linalg.eigh((apart * n[:, None]).T @ apart)[1][:, -1]
            order = np.argsort(apart @ axis, kind="stable")
            groups = max(1, isqrt(len(own)))
            number = np.empty(len(own), np.int64)
            number[order] = np.arange(len(own)) * groups // max(1, len(own))
            members = [np.flatnonzero(number == g) for g in range(groups)]
            if groups > 1:
                self.group_layers[c] = self._single(*self._discriminant(
                    mean, spread, np.array([n[m].sum() for m in members]), np.stack([by_own[m].sum(0) for m in members])))
            for m in members:
                self.group[own[m]], self.inside[own[m]] = len(self.token_layers), np.arange(len(m))
                mid = by_own[m].sum(0) / max(n[m].sum(), 1)
                self.token_layers.append(self._single(*self._discriminant(mid, spread, n[m], by_own[m])) if len(m) > 1 else None)
        self.first_group[CLASSES] = len(self.token_layers)

    @staticmethod
    def _single(weights, biases):
        return weights.astype(np.float32), biases.astype(np.float32)[:, None]

    # -- scores

    @staticmethod
    def _picked(layer, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log p of child `at` of a layer."""
        z = layer[0] @ h.T
        z += layer[1]
        z -= z.max(0)
        own = z[at, np.arange(z.shape[1])]
        return own - np.log(np.exp(z, out=z).sum(0))

    def log_probs(self, flat: np.ndarray) -> np.ndarray:
        """log p of each token of `flat` between its neighbours, 0 at the edges."""
        out = np.zeros(len(flat))
        for place, left, token, right in windows(flat, self.vocabulary.edge, AT_ONCE):
            group = self.group[token]
            order = np.argsort(group)
            place, token, left, right, group = place[order], token[order], left[order], right[order], group[order]
            ends = np.searchsorted(group, self.first_group)
            # The words with a class of their own together, then one class after the other.
            for c, a, z in [(None, 0, ends[OWN_CLASS]), *[(c, ends[c], ends[c + 1]) for c in range(OWN_CLASS, CLASSES)]]:
                for i in range(a, z, IN_CACHE):
                    some = slice(i, min(z, i + IN_CACHE))
                    out[place[some]] = self._of_class(c, token[some], group[some], self.hidden(left[some], right[some]))
        return out

    def _of_class(self, c: int | None, token: np.ndarray, group: np.ndarray, h: np.ndarray) -> np.ndarray:
        """log p of tokens of a class, sorted by group; `c` None: of words with a class of their own."""
        found = self._picked(self.class_layer, h, self.classes[token]).astype(np.float64)
        if c is None:
            return found
        if c in self.group_layers:
            found += self._picked(self.group_layers[c], h, group - self.first_group[c])
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
            layer = self.token_layers[group[a]]
            if layer is not None:
                found[a:b] += self._picked(layer, h[a:b], self.inside[token[a:b]])
        return found

    def scores(self, texts: list[str | None]) -> list[tuple[int, float]]:
        """(number of tokens, log-probability) of each text."""
        out, parts = [], []
        edge = np.array([self.vocabulary.edge])

        def flush():
            logs = self.log_probs(np.concatenate([edge, *[x for p in parts for x in (p, edge)]]))
            ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
            out.extend((len(p), float(logs[e - len(p) : e].sum())) for p, e in zip(parts, ends))
            parts.clear()

        size = 0
        for text in texts:
            parts.append(tokens(text, self.vocabulary))
            size += len(parts[-1])
            if size >= AT_ONCE:
                flush()
                size = 0
        if parts:
            flush()
        return out

    def score(self, text: str | None) -> tuple[int, float]:
        return self.scores([text])[0]


def train(docs: DataFrame) -> Model:
    stage = Stage(docs.sparkSession, "lm")
    vocabulary = Vocabulary([w.encode() for w in frequent_words(docs, stage)])
    corpus = stage.keep(tokenised(docs, vocabulary))
    model = Model(vocabulary, count_triples(corpus, vocabulary))
    model.set_sides(model.side_sums(corpus))
    model.set_outputs(*model.output_sums(corpus))
    stage.drop(corpus)
    return model


def scored(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """The row's columns in `carry` (all by default) as doc, n_tokens, log_prob."""
    columns = carry or docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), "text")

    def work(batches):
        for batch in batches:
            found = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                ["doc", "n_tokens", "log_prob"])

    schema = T.StructType([rows.schema["doc"], T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())])
    return rows.mapInArrow(work, schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs), carry=["doc_id"])
    return out.select("doc.doc_id", "n_tokens", "log_prob",
                      (F.col("log_prob") / F.nullif(F.col("n_tokens"), F.lit(0))).alias("mean_log_prob"))
