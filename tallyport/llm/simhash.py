"""SimHash near-dedup with deletion-variant signatures.

A document's fingerprint has a bit where over half the hashes of its word shingles
have it. Fingerprints that differ in at most 3 bits are linked. Cut into two halves, at
least one half of such a pair differs in one bit at most. So each fingerprint is
indexed by its halves with one bit wildcarded, 64 keys in all; pairs that share a key
are joined and verified on all 64 bits. A pair that meets at several keys is taken at
one: at the lowest bit where a half is equal, at the differing bit otherwise, and in
the second half only if the first half differs in more than one bit.

Equal fingerprints are one class before anything is joined, so copies make no pairs,
however many there are. Links join distinct fingerprints only, are verified inside the
join, and are contracted to components on the cluster.

Defined cases: a null text or one without words has fingerprint zero, linked like any
other; fewer words than a shingle make one shingle of the whole sequence. Null ids are
left out of the least id; a component of null ids has a null id. Rows that repeat are
in one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.llm import shingles
from tallyport.llm.common import Stage, packed, row_key, table, unpacked
from tallyport.llm.components import components

SHINGLE = 3
DISTANCE = 3
HASH_SEED = 42
BITS = 64


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Bit set if in over half of the shingles' XXH64, repeats counted."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    pieces = (joined[a:b] for a, b in zip(begins[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()))
    n = len(words) - k + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, HASH_SEED) for p in pieces), np.uint64, n)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(k1, k2, doc_id, fp) for each row; fp is the fingerprint as a signed long."""

    def work(batches):
        for batch in batches:
            found = [fingerprint(shingles.lower_words(t), shingle) for t in batch.column("text").to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in ("k1", "k2", "doc_id")], fp], ["k1", "k2", "doc_id", "fp"])

    given = docs.select(*row_key(), "doc_id", "text")
    schema = T.StructType([*[given.schema[i] for i in ("k1", "k2", "doc_id")], T.StructField("fp", T.LongType())])
    return given.mapInArrow(work, schema)


def near_links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp) distinct -> (a, b), a < b, that differ in at most `distance` bits.

    Two halves of 32 bits; holds for distances up to 3.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one wildcard bit hold for at most 3 bits")
    slot = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1)))
    half = "(CASE WHEN slot < 32 THEN fp ELSE shiftrightunsigned(fp, 32) END & 4294967295L)"
    keyed = classes.select("fp", slot.alias("slot")).select(
        "fp", F.expr(f"(cast(slot AS long) << 32) | ({half} & ~(1L << (slot % 32)))").alias("variant")
    )
    a, b = keyed.select("variant", F.col("fp").alias("a")), keyed.select("variant", F.col("fp").alias("b"))
    # Which bit of its half the variant leaves out, and how the halves of the pair differ.
    bit, second = "(shiftrightunsigned(variant, 32) % 32)", "variant >= (32L << 32)"
    low, high = "((a ^ b) & 4294967295L)", "shiftrightunsigned(a ^ b, 32)"
    here, there = f"(CASE WHEN {second} THEN {high} ELSE {low} END)", low
    once = f"(({here} = 0 AND {bit} = 0) OR {here} <> 0) AND (NOT {second} OR bit_count({there}) > 1)"
    # Spark sizes the 64 rows of a fingerprint as one, so left to itself it broadcasts them all.
    return a.join(b.hint("merge"), "variant").filter(f"a < b AND bit_count(a ^ b) <= {int(distance)} AND {once}").select("a", "b")


def judged(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(k1, k2, doc_id, fp, root, component_id) for each row of `docs`; root is a fingerprint of the component."""
    stage = Stage(docs.sparkSession, "simhash")
    marked = stage.keep(fingerprints(docs, shingle))
    classes = stage.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(classes.select("fp"), distance), stage)
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written, so that the join has two plain shuffles and a hot fingerprint can be split among tasks.
    return marked.join(stage.keep(named.join(ids, "root").select("fp", "root", "component_id")), "fp")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component stays: that with the least doc_id, then the least text hash.

    Of rows that agree in doc_id and text one stays.
    """
    groups = judged(docs, shingle, distance)
    first = groups.groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("first")).select("first.*")
    kept = packed(docs, *row_key()).join(first.hint("shuffle_hash"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return kept.select(*unpacked(docs))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
