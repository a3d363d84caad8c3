"""Language identification: script ranges narrow the candidates, Viterbi labels spans.

Training (Spark): letter words of labelled documents (lower-cased runs of letters) are
cut into character grams of GRAM characters, word-boundary marks included; counts per
(language, gram) are summed with map-side combining, and each language keeps its
MAX_GRAMS commonest grams (a documented bound on the model; counting covers every
training document). Each language also learns which writing systems its letters use.

Prediction (Arrow batches inside Spark tasks, model broadcast; its size is bounded by
languages x MAX_GRAMS): every letter word gets a log-likelihood per language from its
grams (add-one smoothing, unseen grams at the smoothing floor). Languages whose script
share for the word's script is below MIN_SCRIPT_SHARE are not candidates for that word
(if no language is, all are). A Viterbi pass over the words of the whole text, with a
SWITCH penalty for changing language between neighbouring words, labels spans; the
document's language is the one labelling most words (ties: greater summed likelihood,
then the smaller code), its score the share of words it labels. Documents are run in
groups of similar length so that the pass is vectorised over documents.

Defined cases: null text, or a text without letters: `und`, score 0. Very long texts are
read whole. Repeated rows get equal answers. Without training rows every prediction
is `und`. Extra columns are carried where the caller asks for them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyport.session import Tables

GRAM = 3
MAX_GRAMS = 20_000
# Labelled documents per language that train the model: a bounded, documented sample. At
# most 1,000 (Spark's window group limit), so that each task keeps only its own first rows
# before the shuffle, and a language with most rows is no hot group.
TRAIN_PER_LANGUAGE = 1_000
SWITCH = 6.0
MIN_SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
# Padded words x documents of one lockstep Viterbi group.
CELLS = 1 << 18
# Characters of text labelled at once in a task.
SLICE_CHARS = 2_000_000
# Texts in one Arrow batch of the registered query.
BATCH_ROWS = 1_000

# Named code-point ranges of writing systems (start, end inclusive).
SCRIPTS = [
    ("latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x4E00, 0x9FFF), (0x3400, 0x4DBF)]),
]
OTHER = len(SCRIPTS)

LETTER_WORD = r"\p{L}+"


def held_out(doc_id: Column) -> Column:
    """crc32 of the decimal id mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _grams(word: str) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1)]


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> dict:
    """The model from training rows of `docs` (doc_id, text, lang), counted in one pass, collected once.

    The training rows are the `per_language` rows of each language with the smallest hash of
    their id (a bounded sample, the only one); their ids reach the texts by a broadcast of at
    most `per_language` x languages keys, so no text is shuffled.
    """
    train = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    keys = train.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("pick"))
    chosen = keys.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("pick", "doc_id"))) \
        .where(F.col("r") <= per_language).select("lang", "pick")
    sample = train.withColumn("pick", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), ["lang", "pick"], "left_semi")
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTER_WORD), F.lit(0))).alias("w"))
    marked = words.select("lang", F.concat(F.lit("<"), F.col("w"), F.lit(">")).alias("m"))
    grams = marked.select("lang", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("m") - GRAM + 1, F.lit(1))), lambda i: F.substring("m", i, GRAM))).alias("gram"))
    counts = grams.groupBy("lang", "gram").count().collect()
    totals: dict[str, int] = {}
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in counts:
        totals[r["lang"]] = totals.get(r["lang"], 0) + r["count"]
        by_lang.setdefault(r["lang"], []).append((-r["count"], r["gram"]))
    kept = [(lang, g, -n) for lang, rows in by_lang.items() for n, g in sorted(rows)[:MAX_GRAMS]]
    return {"langs": sorted(totals), "totals": {k: (v, 0) for k, v in totals.items()}, "grams": kept}


class Model:
    """Log-likelihoods of grams per language, script masks, in numpy."""

    def __init__(self, fitted: dict):
        self.langs = fitted["langs"]
        lang_ix = {lang: i for i, lang in enumerate(self.langs)}
        vocab = sorted({g for _, g, _ in fitted["grams"]})
        self.row = {g: i for i, g in enumerate(vocab)}
        self.index = pd.Index(vocab, dtype=object)
        size = max(1, len(vocab))
        counts = np.zeros((len(vocab) + 1, len(self.langs)))
        for lang, gram, n in fitted["grams"]:
            counts[self.row[gram], lang_ix[lang]] = n
        totals = np.array([fitted["totals"][lang][0] for lang in self.langs], float)
        self.logp = np.log((counts + 1.0) / (totals + size)[None, :])
        self.unseen = len(vocab)
        bounds = sorted((a, b, s) for s, (_, ranges) in enumerate(SCRIPTS) for a, b in ranges)
        self.starts = np.array([a for a, _, _ in bounds])
        self.ends = np.array([b for _, b, _ in bounds])
        self.script_of = np.array([s for _, _, s in bounds])
        # Script shares of each language from its single-letter grams.
        self.char_script: dict[str, int] = {}
        share = np.zeros((OTHER + 1, len(self.langs)))
        for lang, gram, n in fitted["grams"]:
            for ch in gram.strip("<>"):
                share[self.script(ch), lang_ix[lang]] += n
        share /= np.maximum(share.sum(axis=0, keepdims=True), 1)
        mask = share >= MIN_SCRIPT_SHARE
        self.allowed = np.where(mask.any(axis=1, keepdims=True), mask, True)
        self.cache: dict[str, np.ndarray] = {}

    def script(self, word: str) -> int:
        """The writing system of a word's first letter (words are runs of letters)."""
        got = self.char_script.get(word[0])
        if got is None:
            point = ord(word[0])
            at = int(np.searchsorted(self.starts, point, side="right")) - 1
            got = int(self.script_of[at]) if at >= 0 and point <= self.ends[at] else OTHER
            self.char_script[word[0]] = got
        return got

    def emissions(self, words) -> np.ndarray:
        """words x languages log-likelihoods of distinct words; non-candidates at minus infinity."""
        out = np.empty((len(words), len(self.langs)))
        todo = []
        for k, w in enumerate(words):
            got = self.cache.get(w)
            if got is None:
                todo.append(k)
            else:
                out[k] = got
        if todo:
            grams = [_grams(words[k]) for k in todo]
            sizes = np.fromiter(map(len, grams), np.int64, len(grams))
            found = self.index.get_indexer([g for gs in grams for g in gs])
            flat = np.where(found < 0, self.unseen, found)
            sums = np.add.reduceat(self.logp[flat], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
            allowed = self.allowed[[self.script(words[k]) for k in todo]]
            fresh = np.where(allowed, sums, -np.inf)
            out[todo] = fresh
            if len(self.cache) < 200_000:
                self.cache.update(zip((words[k] for k in todo), fresh))
        return out


def viterbi(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """Best label path of each document (words x languages score matrices), in lockstep over documents."""
    paths: list[np.ndarray] = [np.zeros(0, int)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    order = [i for i in order if len(scores[i])]
    groups, group = [], []
    for i in order:
        # Documents of similar length side by side; a group holds at most CELLS padded words.
        if group and (len(group) + 1) * len(scores[i]) > CELLS:
            groups.append(group)
            group = []
        group.append(i)
    groups += [group] if group else []
    for group in groups:
        longest, n_lang = len(scores[group[-1]]), scores[group[-1]].shape[1]
        lengths = np.array([len(scores[i]) for i in group])
        e = np.full((longest, len(group), n_lang), 0.0)
        for j, i in enumerate(group):
            e[: lengths[j], j] = scores[i]
        value = e[0].copy()
        back = np.zeros((longest, len(group), n_lang), np.int32)
        back[0] = np.arange(n_lang)
        for t in range(1, longest):
            best = value.argmax(axis=1)
            stay = value >= value[np.arange(len(group)), best][:, None] - switch
            back[t] = np.where(stay, np.arange(n_lang)[None, :], best[:, None])
            nxt = np.where(stay, value, value.max(axis=1, keepdims=True) - switch) + e[t]
            # Finished documents keep their last values.
            live = (t < lengths)[:, None]
            value = np.where(live, nxt, value)
        # Back from each document's own end, all documents of the group at once.
        at = np.arange(len(group))
        state = value.argmax(axis=1)
        path = np.zeros((longest, len(group)), np.int64)
        for t in range(longest - 1, -1, -1):
            live = t < lengths
            path[t] = state
            if t:
                state = np.where(live, back[t, at, state], state)
        for j, i in enumerate(group):
            paths[i] = path[: lengths[j], j]
    return paths


def label(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    words = [regex.findall(LETTER_WORD, t.lower()) if t else [] for t in texts]
    if not model.langs:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    # Each distinct word of the batch is scored once.
    flat = [w for ws in words for w in ws]
    codes, distinct = pd.factorize(pd.Series(flat, dtype=object)) if flat else (np.zeros(0, np.int64), [])
    table = model.emissions(list(distinct))
    ends = np.cumsum([len(ws) for ws in words])
    scores = [table[codes[e - len(ws) : e]] for ws, e in zip(words, ends)]
    paths = viterbi(scores, SWITCH)
    names = np.array(model.langs, dtype=object)
    rank = np.argsort(np.argsort(names))  # smaller code first on full ties
    langs, shares = [], []
    for s, path in zip(scores, paths):
        if not len(path):
            langs.append(UNDETERMINED)
            shares.append(0.0)
            continue
        n = np.bincount(path, minlength=len(model.langs))
        sums = np.where(np.isfinite(s), s, 0).sum(axis=0)
        best = max(range(len(model.langs)), key=lambda k: (n[k], sums[k], -rank[k]))
        langs.append(model.langs[best])
        shares.append(float(n[best] / len(path)))
    return langs, shares


OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, fitted: dict, carry: list[str]) -> DataFrame:
    """`carry` columns of `docs`, lang_pred, score; one row per row of `docs`, no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fitted)
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
    schema = T.StructType(fields + list(OUT.fields))

    def run(batches):
        model = Model(shared.value)
        for batch in batches:
            # Slices of at most SLICE_CHARS characters (one text at least) bound the words held at once.
            sizes = batch["text"].str.len().fillna(0).to_numpy()
            starts = [0]
            total = 0
            for k, size in enumerate(sizes):
                if total and total + size > SLICE_CHARS:
                    starts.append(k)
                    total = 0
                total += size
            for a, b in zip(starts, starts[1:] + [len(batch)]):
                part = batch.iloc[a:b]
                langs, shares = label(model, list(part["text"]))
                out = part.drop(columns=["text"])
                out["lang_pred"], out["score"] = langs, shares
                yield out

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col("text").cast("string").alias("text"))
    got = rows.mapInPandas(run, schema)
    return got.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "lang_pred", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark)
    # The job's own session: Arrow batches of a bounded number of texts.
    tables.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs = tables.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = predict(docs, fit(docs), carry=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
