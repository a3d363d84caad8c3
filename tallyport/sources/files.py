"""File and table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyport.operators.ingest import (
    category_translation,
    clean_geolocation,
    clean_reviews,
    split_wide,
    with_sequence,
)
from tallyport.schemas import BASE_TABLES, text_schema

# Review text may span lines and contain quotes.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], multiline: bool = False) -> DataFrame:
    """CSV with a header, every column as text; ingest casts and parses afterwards.

    multiline lets quoted text contain line breaks, at the price of one task per file.
    """
    reader = spark.read.schema(text_schema(list(columns))).options(**CSV_OPTIONS)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.option("multiLine", str(multiline).lower()).csv(paths)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV from its first line."""
    return spark.read.options(header="true").csv(path).columns


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide export rows in file order; the header decides the column order."""
    return with_sequence(read_csv(spark, path, header_of(spark, path)))


def first_existing(spark: SparkSession, patterns: Sequence[str], every: bool = False) -> list[str]:
    """The first file of the first path or glob that matches anything, on any Hadoop file system.

    Two versions of an export are not mixed; `every` takes all matches of that pattern,
    for exports in parts.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(conf).globStatus(path)
        if found:
            matches = sorted(str(status.getPath()) for status in found)
            return matches if every else matches[:1]
    return []


def write_table(rows: DataFrame, name: str) -> None:
    """Replace a catalogue table as a whole."""
    rows.write.mode("overwrite").format("parquet").saveAsTable(name)


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_csv_report(rows: DataFrame, path: str) -> None:
    """One CSV file with a header, for reports that are small by construction."""
    rows.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Create the nine base tables that do not exist yet, with declared schemas."""
    for name, schema in BASE_TABLES.items():
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.catalog.createTable(f"{database}.{name}", source="parquet", schema=schema)


def table_names(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames available to spark.sql under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def load_all(
    spark: SparkSession, wide_csv: str, reviews: Sequence[str], geolocation: Sequence[str], root: str,
    dictionary: dict[str, str],
) -> dict[str, DataFrame]:
    """Wide export, reviews and geolocation CSVs to nine Parquet tables under `root`.

    The wide CSV is parsed once into a Parquet staging copy; the six splits then
    read only their own columns of it, and it is deleted at the end.
    """
    staging = f"{root}/_staging"
    write_parquet(read_wide_csv(spark, wide_csv), f"{staging}/wide")
    tables = split_wide(spark.read.parquet(f"{staging}/wide"))
    for kind, patterns, clean in (
        ("order_reviews", reviews, clean_reviews),
        ("geolocation", geolocation, clean_geolocation),
    ):
        files = first_existing(spark, patterns)
        if not files:
            raise FileNotFoundError(f"no {kind} file matches {list(patterns)}")
        raw = read_csv(spark, files, BASE_TABLES[kind].fieldNames(), multiline=kind == "order_reviews")
        tables[kind] = clean(with_sequence(raw))
    for name, rows in tables.items():
        write_parquet(rows, f"{root}/{name}")
    translation = category_translation(spark.read.parquet(f"{root}/products"), dictionary)
    write_parquet(translation, f"{root}/product_category_name_translation")
    delete_path(spark, staging)
    return {name: spark.read.parquet(f"{root}/{name}") for name in BASE_TABLES}

