"""Tag questions as they arrive in a log directory.

The tags need no state, so the batch functions serve the stream unchanged and the
file sink with its checkpoint writes each question once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyport.operators.questions import DEFAULT_RULES, Rules, needed_jobs, tag_type, with_params

QUESTION_SCHEMA = "question_id string, asked_at timestamp, question string"


def tagged(questions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return needed_jobs(with_params(tag_type(questions, rules)), rules)


def run_available(
    spark: SparkSession, source: str, target: str, checkpoint: str, rules: Rules = DEFAULT_RULES
) -> StreamingQuery:
    """Tag all questions that are new since the last run, then stop."""
    stream = spark.readStream.schema(QUESTION_SCHEMA).json(source)
    return (
        tagged(stream, rules)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
