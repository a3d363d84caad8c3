"""JDBC source and sink; needs a driver jar on the cluster, so untested here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    lower: int | None = None, upper: int | None = None, partitions: int = 32, **properties: str,
) -> DataFrame:
    """A table over JDBC, read in parallel ranges when a partition column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(rows: DataFrame, url: str, table: str, batch: int = 2000, **properties: str) -> None:
    """Replace the rows of a table; it keeps its definition and indexes."""
    (
        rows.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("batchsize", batch)
        .options(**properties)
        .mode("overwrite")
        .save()
    )
