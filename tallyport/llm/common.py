"""Helpers shared by the corpus operators: tables, words, staged frames."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.text import let  # noqa: F401

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, *A_TO_Z)


def packed(docs: DataFrame, *extra: Column) -> DataFrame:
    """The whole row as one struct `doc`, so that no column of `docs` clashes with ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *extra)


def row_key() -> list[Column]:
    """k1, k2: never null, ordered as doc_id (null last), different for different texts of one id.

    Rows that agree in doc_id and text share a key; copies_apart tells them from each other.
    """
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("k1"),
        F.xxhash64("doc_id", "text").alias("k2"),
    ]


def unpacked(docs: DataFrame, **given: Column) -> list[Column]:
    """The columns of `docs` out of the struct, those in `given` replaced."""
    return [given.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]


def length_like(docs: DataFrame, text: Column) -> dict[str, Column]:
    """n_chars for a changed text, where `docs` has that column."""
    return {"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}


def copies_apart(docs: DataFrame, stage: Stage, ids: bool = True) -> DataFrame:
    """(k1, k2, doc, is_copy): is_copy for all rows of a key but one; with `ids` false only where doc_id is null.

    Rows that share a key get a number, written before it is used.
    """
    rows = packed(docs, *row_key(), F.col("doc_id").isNull().alias("no_id"))
    keys = rows if ids else rows.filter("no_id")
    shared = stage.keep(keys.groupBy("k1", "k2", "no_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    on = ["k1", "k2", "no_id"]
    single = rows.join(shared, on, "left_anti").withColumn("is_copy", F.lit(False))
    numbered = stage.keep(rows.join(shared, on, "left_semi").withColumn("number", F.monotonically_increasing_id()))
    first = numbered.groupBy(*on).agg(F.min("number").alias("first"))
    marked = numbered.join(first, on).withColumn("is_copy", F.col("number") > F.col("first")).drop("number", "first")
    return single.unionByName(marked).drop("no_id")


SKETCH_BITS = 1 << 25


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(77)), F.lit(SKETCH_BITS))


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A Bloom filter of the keys as a table of at most SKETCH_BITS / 64 words: at most 8 MB, whatever the rows."""
    at = rows.select(_slot(keys).alias("slot"))
    return at.groupBy(F.shiftright("slot", 6).alias("sketch_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("sketch_bits"))


def maybe_in(rows: DataFrame, keys: list[str], filter_: DataFrame) -> DataFrame:
    """`rows` with `maybe`: false only if the filter shows that the keys are not in it.

    Saves shuffling most rows that an exact join would drop; the more rows a filter of
    this size stands for, the less it saves. Exact steps must follow.
    """
    marked = rows.withColumn("slot", _slot(keys)).withColumn("sketch_word", F.shiftright("slot", 6))
    bit = F.expr("shiftright(coalesce(sketch_bits, 0L), cast(slot & 63 AS int)) & 1L")
    met = marked.join(F.broadcast(filter_), "sketch_word", "left")
    return met.withColumn("maybe", bit == 1).drop("slot", "sketch_word", "sketch_bits")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyport-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a folder of our own only where none is set and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folder()


class Stage:
    """Tables written between the steps of one operator.

    They lie in the shared folder, so a lost executor costs only its running tasks.
    `keep` writes a frame and reads it back, `drop` deletes an earlier one. What the
    result still reads is deleted when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._made = 0
        atexit.register(self._end)

    def keep(self, rows: DataFrame, compression: str | None = None) -> DataFrame:
        self._made += 1
        path = f"{self.folder}/{self._made}"
        rows.write.parquet(path, compression=compression)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        kept.stage_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        self._delete(kept.stage_path)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def _end(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            self._delete(self.folder)
