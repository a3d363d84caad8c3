"""Spark session set-up shared by tests, benchmark and applications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime SQL settings every job relies on. Results depend on the time zone only;
# the others keep hot join keys from ending in one task.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Used where the caller sets nothing. A task that joins and groups narrow rows holds some
# twenty times the bytes it reads from a shuffle, in sorts and hash tables side by side.
JOB_DEFAULTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def job_session(spark: SparkSession) -> SparkSession:
    """A session for one job: our defaults, the caller's SQL settings, then ours. The caller's session stays as it is."""
    own = spark.newSession()
    given = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}
    for key, value in (JOB_DEFAULTS | given | JOB_SETTINGS).items():
        if own.conf.get(key, None) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


# Stored input per shuffle partition. Queries read a fraction of the columns, so a
# partition shuffles far less than this.
INPUT_PER_PARTITION = 512 * 1024 * 1024


def shuffle_partitions(stored_bytes: int, configured: int, per_partition: int = INPUT_PER_PARTITION) -> int:
    """Shuffle partitions to start with; never fewer than the session asks for."""
    return max(configured, -(-stored_bytes // per_partition))


class Tables:
    """Opens the tables of one job and starts its shuffles with partitions that fit them.

    Only tables that the job opens count, by the size Spark's own plan has for them.
    Adaptive execution merges partitions that turn out small but does not split evenly
    large ones, so the starting number has to follow the data.
    """

    def __init__(self, spark: SparkSession, per_partition: int = INPUT_PER_PARTITION):
        self.spark = job_session(spark)
        self.per_partition = per_partition
        self.configured = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.stored: dict[str, int] = {}

    def _opened(self, name: str, frame: DataFrame) -> DataFrame:
        self.stored[name] = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        wanted = shuffle_partitions(sum(self.stored.values()), self.configured, self.per_partition)
        self.spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
        return frame

    def parquet(self, path: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return self._opened(path, reader.parquet(path))

    def table(self, name: str) -> DataFrame:
        return self._opened(name, self.spark.table(name))


def local_session(app: str = "tallyport", cores: str | int = "*",
                  shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
