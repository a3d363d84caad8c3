"""Filter interaction audit over a sparse document-term matrix.

Five filters judge every document; the audit tells, for every order in which they
could be applied, what each step removes, what it would have removed but an earlier
step already did, what only it catches, and what good and toxic documents it costs.

How the counts of words come about: every distinct word of the corpus gets an integer
id, its 64-bit hash, proven unique over the whole vocabulary by one global pass (words
that share a first hash take a second one); each document becomes a row of a sparse
document-term matrix, and each Arrow batch of rows becomes a CSR shard (index pointers,
sorted term ids, counts) in numpy. No pair of document and word is shuffled or written. A row's sum
is its number of words (filter A), its number of non-zeros its distinct words (B).
The remaining flags (C, D from the text, E from a table-wide digest of the text) are
attached per row and the rows are reduced to counts of (part, flags) before the 120
orders are spread out, so that no step past the matrix grows with the documents.

Filters, failing when: A under 50 words; B 100 * distinct words < 65 * words;
C 100 * upper-case A-Z > 5 * code points; D any of `#$%&*|`; E the same text as a row of
smaller doc_id anywhere in the table (whether that row is removed or not).

Defined cases: a null text is empty (no words: fails A, not B). Words are maximal runs
without space, tab, LF, VT, FF, CR, case kept. A null doc_id is never smaller than
another, so such rows never fail E and never make others fail it. A null source is the
part ''. Labels: a doc_id counts as good (toxic) if any of its label rows says so;
rows without label are neither. Repeated rows (same doc_id, text and source) are all
counted, each once. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyport.llm.common import WORD, Stage
from tallyport.operators.hotkeys import skew_join
from tallyport.session import Tables

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]

# Fixed thresholds of the five filters.
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
MARKS = "[#$%&*|]"

# Term ids are 64-bit word hashes; the vocabulary pass finds first hashes that two words
# share, which then take their second hash (at most MAX_COLLIDED of them, a literal).
SECOND_SEED = 7
MAX_COLLIDED = 10_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def collided(docs: DataFrame) -> list[int]:
    """First hashes shared by two different words anywhere in the corpus.

    The vocabulary pass: distinct (first, second) hash pairs of all words, combined on the
    map side, then grouped by the first. Expected empty below some 10^9 distinct words.
    """
    # Repeats are removed by the map-side side of `distinct`, in a hash table per task.
    words = docs.select(F.explode(_words(F.col("text"))).alias("w"))
    pairs = words.select(F.xxhash64("w").alias("h"), F.xxhash64("w", F.lit(SECOND_SEED)).alias("h2"))
    shared = pairs.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("words")).where("words > 1")
    found = [r["h"] for r in shared.limit(MAX_COLLIDED + 1).collect()]
    if len(found) > MAX_COLLIDED:
        raise ValueError(f"more than {MAX_COLLIDED} colliding word hashes: use a wider hash")
    return found


def term_ids(text: Column, clashes: list[int]) -> Column:
    """array<long>: the term id of every word of a text, in order, repeats kept."""
    ids = F.transform(_words(text), lambda w: F.xxhash64(w))
    if not clashes:
        return ids
    bad = F.array(*[F.lit(h) for h in clashes])
    return F.transform(_words(text), lambda w: F.when(F.array_contains(bad, F.xxhash64(w)),
                                                      F.xxhash64(w, F.lit(SECOND_SEED))).otherwise(F.xxhash64(w)))


CSR_OUT = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                        T.StructField("n_words", T.LongType()), T.StructField("n_terms", T.LongType())])


def csr(lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, data) of rows whose term ids are `flat` cut at `lengths`; indices sorted per row."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((flat, row))
    row, ids = row[order], flat[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])] if len(ids) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    data = np.diff(np.r_[starts, len(ids)])
    indptr = np.r_[0, np.cumsum(np.bincount(row[starts], minlength=len(lengths)))]
    return indptr, ids[starts], data


def _csr_stats(batches):
    """Each Arrow batch of rows (k1, k2, ids) becomes one CSR shard; row sums and non-zeros come out."""
    for batch in batches:
        lists = batch["ids"]
        lengths = np.fromiter((len(x) for x in lists), np.int64, len(lists))
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
        indptr, _, data = csr(lengths, flat)
        sums = np.add.reduceat(np.r_[data, 0], indptr[:-1]) * (np.diff(indptr) > 0)
        yield pd.DataFrame({"k1": batch["k1"], "k2": batch["k2"], "n_words": sums.astype(np.int64),
                            "n_terms": np.diff(indptr).astype(np.int64)})


def matrix_stats(docs: DataFrame) -> DataFrame:
    """(k1, k2, n_words, n_terms): row sums and non-zeros of the document-term matrix, one row per key."""
    ids = docs.select(*_keys(), term_ids(F.col("text"), collided(docs)).alias("ids"))
    stats = ids.mapInPandas(_csr_stats, CSR_OUT)
    # Copies of one key have the same text, so the same row.
    return stats.groupBy("k1", "k2").agg(F.max("n_words").alias("n_words"), F.max("n_terms").alias("n_terms"))


def _keys() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k1"),
            F.xxhash64(F.col("doc_id").isNull(), "text", "source").alias("k2")]


def flags(docs: DataFrame, labels: DataFrame, stage: Stage) -> DataFrame:
    """One row per key: part, copies, the five failures, good and toxic.

    The rows of one key (no text) are written once; a text shared by a large share of
    them meets its first doc_id by broadcast where its rows lie, the rest by shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    attrs = docs.select(*_keys(), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                        F.unhex(F.sha2(text, 256)).alias("digest"),
                        (100 * upper > UPPER_PERCENT * F.length(text)).alias("fc"),
                        F.regexp_like(text, F.lit(MARKS)).alias("fd"))
    per_key = stage.keep(attrs.groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ("doc_id", "part", "digest", "fc", "fd")],
                                                       F.count(F.lit(1)).alias("copies")))
    first = per_key.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    marked = skew_join(per_key, first, "digest").withColumn("fe", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL") \
        .groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    return marked.join(lab, "doc_id", "left").select(
        "k1", "k2", "part", "copies", "fc", "fd", "fe",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("bad", F.lit(False)).alias("bad"))


def _bits(letters: str) -> int:
    return sum(1 << LETTERS.index(x) for x in letters)


def _steps() -> Column:
    """The 600 (order, step) pairs with the flag bits of the step's filter, of those before it and of both."""
    return F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(_bits(o[s - 1])).alias("own"),
                              F.lit(_bits(o[: s - 1])).alias("before"), F.lit(_bits(o[:s])).alias("upto"))
                     for o in ORDERS for s in range(1, 6)])


def audit(docs: DataFrame, labels: DataFrame, stage: Stage) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    stats = matrix_stats(docs)
    rows = flags(docs, labels, stage).join(stats, ["k1", "k2"])
    fails = {"A": F.col("n_words") < LEAST_WORDS, "B": 100 * F.col("n_terms") < DISTINCT_PERCENT * F.col("n_words"),
             "C": F.col("fc"), "D": F.col("fd"), "E": F.col("fe")}
    mask = sum(F.when(fails[x], 1 << i).otherwise(0) for i, x in enumerate(LETTERS))
    counted = stage.keep(rows.groupBy("part", mask.alias("mask")).agg(
        F.sum("copies").alias("n"), F.sum(F.when(F.col("good"), F.col("copies")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("bad"), F.col("copies")).otherwise(0)).alias("n_bad")))
    spread = counted.select("*", F.inline(_steps()))
    fail = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = fail & ~earlier

    def total(cond: Column, of: str = "n") -> Column:
        return F.sum(F.when(cond, F.col(of)).otherwise(0)).cast("long")

    per_step = spread.groupBy("part", "filter_order", "step").agg(
        total(F.col("mask").bitwiseAND(F.col("upto")) == 0).alias("kept"), total(here).alias("removed"),
        total(fail & earlier).alias("redundant"), total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(here, "n_good").alias("good_lost"), total(here, "n_bad").alias("toxic_lost"))
    return per_step.withColumn("filter", F.substring("filter_order", F.col("step"), 1)) \
        .withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")).cast("long")) \
        .withColumn("step", F.col("step").cast("int"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark)
    docs = tables.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    labels = tables.parquet(f"{sf_dir}/labels.parquet")
    out = audit(docs, labels, Stage(tables.spark, "audit"))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                      "good_lost", "toxic_lost", "shapley")


OP12_SQL = r"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
firsts AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
lab AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT w.part,
    (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 5 * length(w.t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN coalesce(w.doc_id > firsts.m, false) THEN 16 ELSE 0 END) AS mask,
    coalesce(lab.good, false) AS good, coalesce(lab.bad, false) AS bad
  FROM w JOIN firsts ON w.t = firsts.t LEFT JOIN lab ON w.doc_id = lab.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
perms AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
          WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step FROM perms, range(1, 6) r(s)),
parts AS (SELECT DISTINCT part FROM f),
x AS (
  SELECT f.part, s.filter_order, s.step, f.good, f.bad, f.mask,
    (f.mask >> (strpos('ABCDE', substr(s.filter_order, s.step, 1)) - 1)) % 2 = 1 AS fail,
    list_bool_or([(f.mask >> (strpos('ABCDE', substr(s.filter_order, i, 1)) - 1)) % 2 = 1 FOR i IN range(1, s.step)]) AS earlier,
    list_bool_or([(f.mask >> (strpos('ABCDE', substr(s.filter_order, i, 1)) - 1)) % 2 = 1 FOR i IN range(1, s.step + 1)]) AS gone,
    f.mask = (1 << (strpos('ABCDE', substr(s.filter_order, s.step, 1)) - 1)) AS alone
  FROM f, steps s),
agg AS (
  SELECT part, filter_order, step,
    CAST(count(*) FILTER (WHERE NOT coalesce(gone, false)) AS BIGINT) AS kept,
    CAST(count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false)) AS BIGINT) AS removed,
    CAST(count(*) FILTER (WHERE fail AND coalesce(earlier, false)) AS BIGINT) AS redundant,
    CAST(count(*) FILTER (WHERE alone) AS BIGINT) AS unique_fails,
    CAST(count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false) AND good) AS BIGINT) AS good_lost,
    CAST(count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false) AND bad) AS BIGINT) AS toxic_lost
  FROM x GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM agg
"""
