"""Benchmark decontamination by winnowing.

The least k-gram hash of every window of w consecutive k-grams is kept, for documents
and for benchmark items. A shared span of k + w - 1 = 10 words holds a whole window on
both sides, so both keep the same hash: no such span is missed. The fingerprints of
both are joined; then each hit is extended on the words themselves, which drops chance
hits and gives the words that lie in shared spans. An item of fewer words than a span
is one window of its own length: all grams of that length are its documents'
fingerprints.

Fingerprints of the benchmark are broadcast when they are counted to be few, otherwise
the join shuffles both sides; a fingerprint that is in very many documents stays one
row for each of them, and adaptive execution splits it.

Defined cases: a null text has no words and an item without words no window; rows that
agree in doc_id and text are one document, treated alike; item ids that repeat count
once each in n_items, their windows taken together; items with a null id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm import shingles
from tallyport.llm.common import lower_ascii, packed, row_key, table, unpacked

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10
GRAM = 5
# Benchmark fingerprints that are still broadcast: about 50 MB.
BROADCAST_FINGERPRINTS = 1_000_000


def fingerprints(words: list[bytes], short: list[int], span: int, gram: int, item: bool) -> np.ndarray:
    """Distinct fingerprints of one text; `short` are the lengths of items below a span.

    The length is mixed into the hashes of short items, so they meet no other ones.
    """
    n = len(words)
    hashes = shingles.word_hashes(words, n)
    found = []
    if n >= span:
        found.append(shingles.window_minima(shingles.grams(hashes, gram), span - gram + 1))
    for m in short:
        if n == m if item else n >= m:
            found.append(shingles.grams(hashes, m) + np.uint64(m) * shingles.STEP)
    return np.unique(np.concatenate(found)) if found else hashes[:0]


def _fingerprint_rows(rows: DataFrame, ids: list[str], short: list[int], span: int, gram: int, item: bool) -> DataFrame:
    def work(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [fingerprints(shingles.alnum_words(t), short, span, gram, item) for t in texts]
            if found:
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                prints = pa.array(np.concatenate(found).view(np.int64))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in ids], prints], [*ids, "fingerprint"])

    given = rows.select(*ids, "text")
    schema = T.StructType([*[given.schema[i] for i in ids], T.StructField("fingerprint", T.LongType())])
    return given.mapInArrow(work, schema)


def short_lengths(items: DataFrame, span: int) -> list[int]:
    """The lengths below a span that items have: fewer than `span` numbers."""
    n_words = F.regexp_count(lower_ascii(F.col("text")), F.lit(ALNUM_WORD))
    short = items.select(n_words.alias("n")).filter(F.col("n").between(1, span - 1)).distinct()
    return sorted(r.n for r in short.collect())


def hit_mask(words: list[bytes], items: list[tuple], span: int) -> tuple[np.ndarray, set]:
    """Which words lie in a window of an item, and which items have one that occurs.

    Places are found by the hash of the window and confirmed on its words.
    """
    n = len(words)
    ends = np.zeros(n + 1, np.int64)
    hashes = shingles.word_hashes(words, n)
    windows: dict[int, dict] = {}
    wanted: dict[int, list] = {}
    for item, text in items:
        own = shingles.alnum_words(text)
        m = min(len(own), span)
        if m:
            wanted.setdefault(m, []).append(shingles.grams(shingles.word_hashes(own, len(own)), m))
            for i in range(len(own) - m + 1):
                windows.setdefault(m, {}).setdefault(tuple(own[i : i + m]), set()).add(item)
    found = set()
    for m, known in windows.items():
        for p in np.flatnonzero(np.isin(shingles.grams(hashes, m), np.concatenate(wanted[m]))).tolist():
            ids = known.get(tuple(words[p : p + m]))
            if ids:
                found |= ids
                ends[p] += 1
                ends[p + m] -= 1
    return np.cumsum(ends[:n]) > 0, found


def judged(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM,
           broadcast_fingerprints: int = BROADCAST_FINGERPRINTS) -> DataFrame:
    """doc (the row), n_words, n_hit, items (ids of the benchmark that occur, as sorted text)."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    short = short_lengths(items, span)
    prints = _fingerprint_rows(items, ["item_id"], short, span, gram, item=True).dropDuplicates()
    if prints.count() <= broadcast_fingerprints:
        prints = F.broadcast(prints)
    of_docs = _fingerprint_rows(docs.select(*row_key(), "text"), ["k1", "k2"], short, span, gram, item=False)
    pairs = of_docs.join(prints, "fingerprint").groupBy("k1", "k2", "item_id").agg(F.lit(1).alias("one"))
    cited = pairs.join(items.withColumnRenamed("text", "item_text"), "item_id").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("item_id", "item_text")).alias("candidates")
    )
    met = packed(docs, *row_key()).join(cited.hint("shuffle_hash"), ["k1", "k2"], "left").select("doc", "candidates")

    def extend(batches):
        for batch in batches:
            n_words, n_hit, ids = [], [], []
            texts = batch.column("doc").field("text").to_pylist()
            for text, candidates in zip(texts, batch.column("candidates").to_pylist()):
                words = shingles.alnum_words(text)
                mask, found = hit_mask(words, [(c["item_id"], c["item_text"]) for c in candidates or ()], span)
                n_words.append(len(words))
                n_hit.append(int(mask.sum()))
                ids.append(sorted(map(str, found)))
            counts = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *counts], ["doc", "n_words", "n_hit", "items"])

    schema = T.StructType([met.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    return met.mapInArrow(extend, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in which no window of the benchmark occurs, unchanged."""
    return judged(docs, benchmark, **options).filter("n_hit = 0").select(*unpacked(docs))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "benchmark")).select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS win
      FROM (SELECT *, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)),
v AS (SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS win
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
            FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)),
h AS (SELECT doc_id, p, m, item_id FROM v JOIN i USING (m, win)),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, p + unnest(range(m)) AS q FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
