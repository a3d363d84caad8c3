"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is one line of words: its documents in a seeded permuted order, the line
repeated as often as the target asks, the last time in part. The line is cut into
blocks, a number of equal blocks for each source. A binary tree deals the blocks to
output shards: each node draws half of its blocks without replacement, so the numbers
of blocks by source that go left are a multivariate hypergeometric draw, and all
quotas hold exactly. A shard's blocks are disjoint stretches of the sources' lines.
Rows of a shard are then put into a seeded order.

DataFrame functions only. A source is split into buckets of its permuted order before
anything is ordered, so a source with a third of all rows is many small sorts. One task
sees the sources or the blocks, never documents: the sources of the table, and
BLOCKS_PER_SHARD blocks a shard, so at most a million. Shards grow in number with the
corpus, up to MOST_SHARDS.

Defined cases: a null text or one without words has size 0 and is never drawn; a null
source is a source of its own, last in order; rows with equal doc_id and size may swap
places, which changes no figure; an empty table gives no rows. Null ids are ordered as
the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.llm.common import WORD, Stage, table

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
ROWS_PER_BUCKET = 2_000
# Words of an output shard, about 25 MB of text, and the most shards there are.
WORDS_PER_SHARD, MOST_SHARDS = 4_000_000, 1 << 16
BLOCKS_PER_SHARD = 16


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n_rows) -> with place, weight and target.

    Targets share the sum of all sizes by weight; one that would pass `most` times its
    source stops there, and the others share what is left. Ordered by the level at which
    they stop, the stopped sources are a prefix, found with running sums.
    """
    by_name, all_rows = W.orderBy(F.col("source").asc_nulls_last()), W.partitionBy(F.lit(0))
    steps = W.partitionBy(F.lit(0)).orderBy("stop_level", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("stop_level", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
    )
    before = F.coalesce(F.sum("most").over(steps.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(steps.rowsBetween(0, W.unboundedFollowing))
    stopped = ranked.withColumn("stops", F.col("stop_level") <= (F.col("total") - before) / left)
    level = (F.col("total") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0.0)).over(all_rows)) / F.sum(
        F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))
    ).over(all_rows)
    return stopped.withColumn(
        "target", F.when(F.col("stops"), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * level))
    ).select("source", "source_size", "n_rows", "place", "weight", "target", "total")


def _hex_share(key: Column) -> Column:
    """The first 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def targets_of(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row for each source: source_targets and quota, the target in whole words."""
    rows = docs.select(F.col("source").alias("source"), words_in(F.col("text")).alias("size"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    return source_targets(sizes, weights, most).withColumn("quota", F.round("target").cast("long"))


def lay_out(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED,
            rows_per_bucket: int = ROWS_PER_BUCKET, carry: list[str] | None = None, targets: DataFrame | None = None,
            reached: bool = False) -> DataFrame:
    """Each document's place in its source's line, and the words taken from it.

    Returns doc (the row, or its columns in `carry`), size, source_size, target, place (of the source),
    quota (words of the source in the mix), start (first word in the line), taken. With `reached`
    buckets that start behind the quota, from which no word is taken, are left out before
    anything is shuffled.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"),
        F.col("source").alias("source"),
        words_in(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )
    found = targets_of(docs, weights, most) if targets is None else targets
    t = found.withColumn("buckets", F.ceil(F.col("n_rows") / rows_per_bucket)).select(F.col("source").alias("t_source"), "source_size", "target", "place", "quota", "buckets", "total")
    placed = (
        rows.join(t, rows.source.eqNullSafe(t.t_source))
        .withColumn("bucket", F.floor(_hex_share(F.col("key")) * F.col("buckets")))
        .drop("t_source", "buckets", "source")
    )
    # Where each bucket starts: sizes summed by bucket first, so one source is a few rows.
    sums = placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    starts = sums.select(
        "place", "bucket",
        (F.sum("words").over(W.partitionBy("place").orderBy("bucket")) - F.col("words")).alias("bucket_start"),
    )
    # A row for each ROWS_PER_BUCKET documents, so it goes to the documents where they lie.
    begun = placed.join(F.broadcast(starts), ["place", "bucket"])
    if reached:
        begun = begun.filter("size > 0 and (quota >= source_size or bucket_start < quota)")
    in_bucket = W.partitionBy("place", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, 0)
    out = begun.withColumn("start", F.col("bucket_start") + F.sum("size").over(in_bucket) - F.col("size"))
    size, start, whole = F.col("size"), F.col("start"), F.expr("quota div greatest(source_size, 1)")
    part = F.greatest(F.lit(0), F.least(start + size, F.col("quota") - whole * F.col("source_size")) - start)
    return out.withColumn("taken", whole * size + part).select(
        "doc", "key", "size", "source_size", "target", "place", "quota", "start", "taken", "total"
    )


def deal_blocks(sources: DataFrame, shards: int, blocks_per_shard: int = BLOCKS_PER_SHARD,
                seed: str = SEED) -> DataFrame:
    """(place, quota, total) -> (place, block, n_blocks, shard): the splitting tree.

    `shards` must be a power of two. Each level halves every node by a seeded order of
    its blocks: a draw without replacement.
    """
    levels = shards.bit_length() - 1
    if shards != 1 << levels:
        raise ValueError("shards must be a power of two")
    block_words = F.greatest(F.lit(1), F.ceil(F.col("total") / (shards * blocks_per_shard)))
    blocks = (
        sources.filter("quota > 0")
        .withColumn("n_blocks", F.ceil(F.col("quota") / block_words))
        .select("place", "n_blocks", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("block"), F.lit(0).alias("shard"))
    )
    for level in range(levels):
        draw = F.md5(F.concat_ws(":", F.lit(seed), F.lit(level), F.col("place"), F.col("block")))
        node = W.partitionBy("shard")
        right = F.row_number().over(node.orderBy(draw, "place", "block")) * 2 > F.count(F.lit(1)).over(node) + level % 2
        blocks = blocks.withColumn("right", right).select(
            "place", "n_blocks", "block", (F.col("shard") * 2 + F.col("right").cast("int")).alias("shard")
        )
    return blocks


def shards_for(words: int) -> int:
    """A power of two of shards of WORDS_PER_SHARD words or fewer, while they are at most MOST_SHARDS."""
    return min(MOST_SHARDS, 1 << max(0, -(-words // WORDS_PER_SHARD) - 1).bit_length())


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, shards: int | None = None,
        blocks_per_shard: int = BLOCKS_PER_SHARD, seed: str = SEED, targets: DataFrame | None = None,
        with_start: bool = False) -> DataFrame:
    """The mix: a row for each stretch of a document that lies in one block.

    Returns the columns of `docs`, with the text cut to the stretch where it is not
    whole, n_chars (if there) set to its length, and mix_pass, mix_block, mix_words,
    mix_shard, mix_order; `with_start` adds mix_place and mix_start, the document's place
    in lay_out. Shards are partitions, each in its seeded order.
    """
    targets = Stage(docs.sparkSession, "mix").keep(targets_of(docs, weights, most)) if targets is None else targets
    shards = shards or shards_for(int(targets.agg(F.sum("source_size")).first()[0] or 0))
    laid = lay_out(docs, weights, most, seed, targets=targets, reached=True)
    dealt = deal_blocks(targets.select("place", "quota", "total"), shards, blocks_per_shard, seed)
    per_source = dealt.groupBy("place").agg(F.first("n_blocks").alias("n_blocks"))
    passes = (
        laid.filter("size > 0 and taken > 0").join(per_source, "place")
        .withColumn("pass", F.explode(F.expr("sequence(0L, (taken - 1) div size)")))
        .withColumn("from_word", F.expr("pass * source_size + start"))
        .withColumn("to_word", F.expr("least(from_word + size, quota)"))
    )
    blocks_of = F.expr("sequence(((from_word + 1) * n_blocks - 1) div quota, (to_word * n_blocks - 1) div quota)")
    pieces = (
        passes.withColumn("block", F.explode(blocks_of))
        .withColumn("low", F.expr("greatest(from_word, (block * quota) div n_blocks) - from_word"))
        .withColumn("high", F.expr("least(to_word, ((block + 1) * quota) div n_blocks) - from_word"))
        .join(dealt.drop("n_blocks"), ["place", "block"])
    )
    words = F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0))
    text = F.when((F.col("low") == 0) & (F.col("high") == F.col("size")), F.col("doc.text")).otherwise(
        F.array_join(F.slice(words, (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int")), " ")
    )
    given = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    columns = [given.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.col("key"), F.col("pass"), F.col("block")))
    out = pieces.select(
        *columns, F.col("pass").alias("mix_pass"), F.col("block").alias("mix_block"),
        (F.col("high") - F.col("low")).alias("mix_words"), F.col("shard").alias("mix_shard"), order.alias("mix_order"),
        *([F.col("place").alias("mix_place"), F.col("start").alias("mix_start")] if with_start else []),
    )
    return out.repartition(shards, "mix_shard").sortWithinPartitions("mix_shard", "mix_order")


def drawn(docs: DataFrame, **given) -> DataFrame:
    """doc_id, size, source_size, target, taken (the words of it in the written mix) for each document; `given` as for mix."""
    stage = Stage(docs.sparkSession, "mix")
    targets = stage.keep(targets_of(docs))
    # Written as a mix is: shards in their order, texts cut. What is drawn is counted in the texts.
    mixed = stage.keep(mix(docs, targets=targets, with_start=True, **given), compression="zstd")
    words = mixed.groupBy(F.col("mix_place").alias("place"), F.col("mix_start").alias("start")).agg(F.sum(words_in(F.col("text"))).alias("words"))
    # A document without words starts where the next one does.
    taken = F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(0).cast("long")
    return lay_out(docs, carry=["doc_id"], targets=targets).drop("taken").join(words, ["place", "start"], "left").select(
        "doc.doc_id", "size", "source_size", "target", taken.alias("taken"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawn(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS most,
             CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
o AS (SELECT *, most / weight <= (total - coalesce(sum(most) OVER (ORDER BY most / weight, place
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stops FROM w),
t AS (SELECT *, CASE WHEN stops THEN most ELSE least(most, weight * (total - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ())
             / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ()) END AS target FROM o),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS quota FROM t),
l AS (SELECT d.*, q.source_size, q.target, q.quota, quota // greatest(source_size, 1) AS whole,
             sum(size) OVER (PARTITION BY q.place ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS start
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(start + size, quota - whole * source_size) - start) AS BIGINT) AS taken
FROM l
"""
