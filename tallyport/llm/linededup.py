"""Line dedup over overlapping windows of three lines.

Every line is hashed, every three consecutive hashes make one window hash, and the
first place of each repeated window is found over all documents. A later occurrence
is removed: the lines that its windows cover are merged and cut out.

DataFrame functions only. A window that a third of all documents share is summed on
the map side before it is shuffled, and met again in a join that adaptive execution
can split. Texts are shuffled once, unsorted.

Defined cases: lines are what line feeds part, compared exactly; a null text stays
null and has no lines, the empty text has one; documents of fewer than three lines
have no window and stay whole; places are ordered by doc_id (null last), text hash and
line; of rows that agree in doc_id and text one comes first, the others lose all
lines of their windows. A document may end up with the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import Stage, copies_apart, length_like, let, row_key, table, unpacked

LINES = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def covered_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(k1, k2, covered): the line numbers, from 0, that later occurrences cover."""
    hashes = F.transform(lines_of(F.col("text")), F.md5)

    def windows(hash_):
        starts = F.sequence(F.lit(0), F.size(hash_) - lines)
        join = lambda i: F.unhex(F.md5(F.concat(*[F.get(hash_, i + j) for j in range(lines)])))
        return F.when(F.size(hash_) >= lines, F.transform(starts, join))

    found = docs.select(*row_key(), F.posexplode(let(hashes, windows)).alias("line", "window"))
    place = F.struct("k1", "k2", "line")
    first = found.groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Written, so that the join has two plain shuffles and a hot window can be split among tasks.
    first = Stage(docs.sparkSession, "lines").keep(first)
    later = found.join(first, "window").filter(place > F.col("first"))
    spread = F.flatten(F.transform(F.collect_set("line"), lambda s: F.array(*[s + j for j in range(lines)])))
    return later.groupBy("k1", "k2").agg(F.array_distinct(spread).alias("covered"))


def judged(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """doc (the row), n_lines, n_removed, kept (the text without covered lines)."""
    covered = covered_lines(docs, lines).hint("shuffle_hash")
    rows = copies_apart(docs, Stage(docs.sparkSession, "lines")).join(covered, ["k1", "k2"], "left")
    text = F.col("doc.text")
    # All windows of a copy are in the row before it.
    n = F.size(lines_of(text))
    rows = rows.withColumn("covered", F.when(F.col("is_copy") & (n >= lines), F.sequence(F.lit(0), n - 1)).otherwise(F.col("covered")))
    parts = F.struct(
        lines_of(text).alias("lines"),
        F.array_except(F.sequence(F.lit(0), F.size(lines_of(text)) - 1), "covered").alias("keep"),
    )
    kept = let(parts, lambda s: F.array_join(F.transform(s["keep"], lambda i: F.get(s["lines"], i)), "\n"))
    return rows.select(
        "doc",
        F.when(text.isNull(), 0).otherwise(F.size(lines_of(text))).alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).alias("n_removed"),
        F.when(F.col("covered").isNull(), text).otherwise(kept).alias("kept"),
    )


def dedup_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """`docs` without the lines that repeat earlier ones; n_chars follows the text."""
    out = judged(docs, lines)
    return out.select(*unpacked(docs, text=F.col("kept"), **length_like(docs, F.col("kept"))))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select(
        "doc.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i, lines[i + 1] || chr(10) || lines[i + 2] || chr(10) || lines[i + 3] AS win
      FROM (SELECT doc_id, lines, unnest(range(greatest(len(lines) - 2, 0))) AS i FROM l)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM later),
n AS (SELECT doc_id, i, lines[i + 1] AS line FROM (SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM l)),
k AS (SELECT doc_id, CAST(count(*) AS INT) AS n_kept, string_agg(line, chr(10) ORDER BY i) AS kept
      FROM n ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l.lines), 0) AS INT) AS n_lines,
       CAST(coalesce(len(l.lines), 0) - coalesce(n_kept, 0) AS INT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d JOIN l USING (doc_id) LEFT JOIN k USING (doc_id)
"""
