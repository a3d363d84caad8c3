"""A corpus pipeline out of the operators in tallyport.llm, one stage after another.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents; the last
one adds the place of each row in the mix. `run` writes every stage's rows to the
shared folder and reads them back, so a lost executor costs one stage's tasks at most.

What a stage drops or cuts: documents the quality classifier rejects; lines of repeated
three-line windows; all documents of a near-copy group but one; documents in which a
benchmark window occurs; and, in the mix, what the targets leave out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyport.llm import decontaminate, linededup, mixing, quality, simhash
from tallyport.llm.common import Stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
]

# The classifier is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each one's rows written and read again by the next."""
    stage = Stage(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for _, step in STAGES:
        kept = stage.keep(step(spark, docs, sf_dir))
        if before is not None:
            stage.drop(before)
        docs = before = kept
    return docs
