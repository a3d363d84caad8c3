"""Substring dedup: words in windows of 20 that also start earlier, by level-wise doubling.

A window's candidates are found at half its length first; those repeated there alone are
extended to the whole length.

Level 10. Of the eleven 10-word grams in a 20-word window the one with the least hash,
rightmost on ties, is its anchor. Equal windows have equal anchors at equal offsets, so
a window whose anchor occurs once in the corpus has no equal and is done. Only anchors
are counted, about one for six words.

Level 20. Consecutive windows that share one anchor place are a run. The first run of
an anchor in corpus order repeats nothing earlier. The windows of every other run are
compared with the first run's at the same offset, one row for each run instead of one
for each window; what agrees is a repeat. Windows that differ from the first run's go
on by themselves: the first place of each is found and the later ones are repeats.

Words of repeated windows are removed; nothing is left to extend after level 20, the
window length asked for. Hot windows are summed on the map side, then met in joins that
adaptive execution splits. A Bloom filter of fixed size keeps most anchors that occur
once, and most documents without a repeated one, out of the shuffles; exact steps follow
it.

Defined cases: a null text has no words; texts below the window length lose nothing;
order is doc_id (null last), then text hash, then place; rows that agree in doc_id and
text are one document, treated alike, but of those with a null id and one text all but
one are later copies and lose every word of their windows. A window is identified by a 64-bit hash together
with its anchor's 64-bit hash and offset.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm import shingles
from tallyport.llm.common import WORD, Stage, copies_apart, length_like, maybe_in, row_key, sketch, table, unpacked

WINDOW = 20
KEY = [T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]
ANCHORS = T.StructType([*KEY, T.StructField("anchor", T.LongType()), T.StructField("at", T.IntegerType())])
RUNS = T.StructType([*KEY, T.StructField("anchor", T.LongType()), T.StructField("at", T.IntegerType()),
                     T.StructField("windows", T.ArrayType(T.LongType()))])


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window: the hash of its anchor gram, and where that gram starts."""
    half = window // 2
    values, width = shingles.grams(hashes, half), window - half + 1
    if len(values) < width:
        return values[:0], np.zeros(0, np.int64)
    least = shingles.window_minima(values, width)
    # The rightmost gram that equals the least one: walk left to right over the offsets.
    at = np.zeros(len(least), np.int64)
    for offset in range(width):
        np.copyto(at, offset, where=values[offset : offset + len(least)] == least)
    return least, at + np.arange(len(least))


def run_starts(at: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(at, prepend=-1)) if len(at) else np.zeros(0, np.int64)


def _repeat(batch: pa.RecordBatch, names: list[str], counts: list[int]) -> list[pa.Array]:
    at = pa.array(np.repeat(np.arange(len(counts)), counts))
    return [batch.column(n).take(at) for n in names]


def anchor_rows(rows: DataFrame, window: int, with_key: bool) -> DataFrame:
    """A row for each run: its anchor, with the document and place if asked for."""

    def work(batches):
        for batch in batches:
            values, places = [], []
            for text in batch.column("text").to_pylist():
                words = shingles.plain_words(text)
                least, at = anchors(shingles.word_hashes(words, len(words)), window)
                starts = run_starts(at)
                values.append(least[starts])
                places.append(at[starts].astype(np.int32))
            if not values:
                continue
            anchor = pa.array(np.concatenate(values).view(np.int64))
            if with_key:
                keys = _repeat(batch, ["k1", "k2"], [len(v) for v in values])
                yield pa.RecordBatch.from_arrays([*keys, anchor, pa.array(np.concatenate(places))], ANCHORS.fieldNames())
            else:
                yield pa.RecordBatch.from_arrays([anchor], ["anchor"])

    schema = ANCHORS if with_key else T.StructType([ANCHORS["anchor"]])
    given = rows if with_key else rows.select("text")
    return given.mapInArrow(work, schema)


def extended_runs(met: DataFrame, window: int) -> DataFrame:
    """(k1, k2, doc, places) -> the runs at these anchor places.

    `windows` holds the hash of the window that starts o words before the anchor at
    index o, null where the run has no such window.
    """

    def work(batches):
        for batch in batches:
            counts, anchor, place, lists = [], [], [], []
            for text, wanted in zip(batch.column("doc").field("text").to_pylist(), batch.column("places").to_pylist()):
                words = shingles.plain_words(text)
                hashes = shingles.word_hashes(words, len(words))
                least, at = anchors(hashes, window)
                whole = shingles.grams(hashes, window).view(np.int64)
                starts = run_starts(at)
                ends = np.append(starts[1:], len(at))
                chosen = np.isin(at[starts], wanted)
                counts.append(int(chosen.sum()))
                for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist()):
                    p = int(at[a])
                    row = [None] * (p - a + 1)
                    row[p - b + 1 :] = whole[a:b].tolist()[::-1]
                    anchor.append(least[a])
                    place.append(p)
                    lists.append(row)
            keys = _repeat(batch, ["k1", "k2"], counts)
            arrays = [*keys, pa.array(np.array(anchor, np.uint64).view(np.int64)), pa.array(place, pa.int32()),
                      pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, RUNS.fieldNames())

    return met.mapInArrow(work, RUNS)


def repeated_anchors(texts: DataFrame, window: int, stage: Stage) -> DataFrame:
    """(k1, k2, anchor, at, is_first): the runs whose anchor occurs more than once."""
    counted = anchor_rows(texts, window, with_key=False).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    rough = sketch(counted.filter("n > 1"), ["anchor"])
    likely = stage.keep(maybe_in(anchor_rows(texts, window, with_key=True), ["anchor"], rough).filter("maybe").drop("maybe"))
    place = F.struct("k1", "k2", "at")
    first = likely.groupBy("anchor").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written, so that the join has two plain shuffles and a hot anchor can be split among tasks.
    first = stage.keep(first)
    alive = stage.keep(likely.join(first, "anchor").select("k1", "k2", "anchor", "at", (place == F.col("first")).alias("is_first")))
    stage.drop(likely)
    stage.drop(first)
    return alive


def repeated_starts(doubtful: DataFrame, alive: DataFrame, window: int, stage: Stage) -> DataFrame:
    """(k1, k2, starts): first words of windows that also start earlier. `doubtful` has k1, k2, doc."""

    def runs(of: DataFrame) -> DataFrame:
        places = of.groupBy("k1", "k2").agg(F.collect_set("at").alias("places")).hint("shuffle_hash")
        return extended_runs(doubtful.join(places, ["k1", "k2"]), window)

    first = stage.keep(runs(alive.filter("is_first")).groupBy("anchor").agg(F.first("windows").alias("first_windows")))
    met = runs(alive.filter("NOT is_first")).join(first, "anchor")
    # Offsets at which the run agrees with the first run, and those left for a search of their own.
    offsets = F.sequence(F.lit(0), F.size("windows") - 1)
    there, here = lambda o: F.get("first_windows", o), lambda o: F.get("windows", o)
    same = F.filter(offsets, lambda o: here(o) == there(o))
    other = F.filter(offsets, lambda o: here(o).isNotNull() & ~(here(o).eqNullSafe(there(o))))
    sorted_out = stage.keep(met.select(
        "k1", "k2", "anchor", "at", F.transform(same, lambda o: F.col("at") - o).alias("same"),
        F.transform(other, lambda o: F.struct(o.alias("o"), here(o).alias("window"))).alias("other")))
    agreed = sorted_out.filter(F.size("same") > 0).select("k1", "k2", F.col("same").alias("starts"))
    single = sorted_out.select("k1", "k2", "anchor", "at", F.explode("other").alias("x")).select(
        "k1", "k2", "anchor", "x.o", "x.window", (F.col("at") - F.col("x.o")).alias("start"))
    keys = ["anchor", "o", "window"]
    place = F.struct("k1", "k2", "start")
    earliest = single.groupBy(*keys).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    earliest = stage.keep(earliest)
    later = single.join(earliest, keys).filter(place > F.col("first")).select("k1", "k2", F.array("start").alias("starts"))
    return agreed.unionByName(later).groupBy("k1", "k2").agg(F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))


def judged(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc (the row), n_words, n_removed, kept (the kept words joined by spaces).

    `docs` needs doc_id and text; `doc` is the row as given.
    """
    stage = Stage(docs.sparkSession, "substring")
    alive = repeated_anchors(docs.select(*row_key(), "text"), window, stage)
    # Documents without a repeated anchor are finished where they are read.
    rows = copies_apart(docs, stage, ids=False)
    asked = maybe_in(rows.filter("NOT is_copy").drop("is_copy"), ["k1", "k2"], sketch(alive, ["k1", "k2"]))
    doubtful = asked.filter("maybe").drop("maybe")
    starts = repeated_starts(doubtful, alive, window, stage)
    met = doubtful.join(starts.hint("shuffle_hash"), ["k1", "k2"], "left").select("doc", "starts")
    # All windows of a copy are in the row before it.
    last = F.regexp_count(F.col("doc.text"), F.lit(WORD)) - window
    copies = rows.filter("is_copy").select("doc", F.when(last >= 0, F.sequence(F.lit(0), last)).alias("starts"))
    clear = asked.filter("NOT maybe").select("doc", F.lit(None).cast("array<int>").alias("starts"))

    def work(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("doc").field("text").to_pylist(), batch.column("starts").to_pylist()):
                words = shingles.plain_words(text)
                n_words.append(len(words))
                if found:
                    at = np.array(found)
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + window, -1)
                    keep = np.cumsum(edges[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            figures = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *figures], ["doc", "n_words", "n_removed", "kept"])

    schema = T.StructType([met.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType())])
    return met.unionByName(clear).unionByName(copies).mapInArrow(work, schema)


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the words that repeat; texts that lose none stay as they are."""
    out = judged(docs, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    return out.select(*unpacked(docs, text=text, **length_like(docs, text)))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
v AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS n FROM v) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + unnest(range(20)) AS p FROM r),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p)
      GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
