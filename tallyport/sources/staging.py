"""Frames that several later steps read, written once in a folder the caller gives."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Keep = Callable[[DataFrame, str], DataFrame]


def in_place(rows: DataFrame, name: str) -> DataFrame:
    """Keep nothing: every reader computes the frame; Spark reuses equal exchanges of one query."""
    return rows


class Staging:
    """Tables in a folder of their own below `root`, deleted when the block ends.

    with Staging(spark, "/shared/tmp") as stage:
        remove_worst_sellers(shop, stored, keep=stage.keep).write.parquet(...)

    `root` has to be a folder that all executors reach; staged tables survive their loss.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = f"{root}/staging-{uuid.uuid4().hex}"

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
