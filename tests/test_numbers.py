import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tallyport import star_roles
from tallyport.functions.numbers import exact_avg, exact_sum, percent, ratio, round_half_up
from tallyport.session import Tables, shuffle_partitions
from tallyport.star_roles import from_star


def test_exact_sum_does_not_depend_on_row_order(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(5), rng.randrange(10**9) / 100) for _ in range(3000)]
    want = {}
    for key, value in rows:
        want.setdefault(key, []).append(Decimal(str(value)))
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, v double").repartition(7)
        got = {r.k: (r.s, r.a) for r in frame.groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
        assert got == {k: (float(sum(v)), float(sum(v)) / len(v)) for k, v in want.items()}


def test_sums_of_nothing_are_null(spark):
    frame = spark.createDataFrame([(1, None)], "k int, v double")
    row = frame.groupBy("k").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
    assert (row.s, row.a) == (None, None)


def test_rounding_is_half_up_on_the_decimal_value(spark):
    values = [0.285, 1.005, -0.285, 92.25, 2.5, 125.125, 1e-12, 123456.785]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(round_half_up(F.col("v"), 2)).collect()]
    assert got == [float(Decimal(str(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]


def test_division_by_zero_is_null(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)).alias("r"), percent(F.lit(1), F.lit(3)).alias("p"), percent(F.lit(None), F.lit(3)).alias("n")
    ).first()
    assert (row.r, row.p, row.n) == (None, 33.3, None)


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(10**6, 8) == 8
    assert shuffle_partitions(10**12, 200) == 1863
    assert shuffle_partitions(10**14, 200) == 186_265
    assert shuffle_partitions(10**14, 200_000) == 200_000


def test_each_job_has_its_own_sizes(spark, tmp_path):
    """Two roots in one session start their shuffles with their own numbers; the caller's session keeps its settings."""
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    spark.range(10).write.parquet(small)
    spark.range(10).write.parquet(large)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    one, two = Tables(spark), Tables(spark)
    one.parquet(small)
    two.parquet(large)
    two._opened("larger", two.spark.range(10**12))  # known size of 8 TB
    assert one.spark.conf.get(key) == "4" and int(two.spark.conf.get(key)) == -(-8 * 10**12 // 2**29)
    assert spark.conf.get(key, None) == before


def test_shuffle_reads_of_a_job_are_small_unless_the_caller_says_otherwise(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    assert Tables(spark).spark.conf.get(key) == "16m" and spark.conf.get(key) == before
    caller = spark.newSession()
    caller.conf.set(key, "8m")
    assert Tables(caller).spark.conf.get(key) == "8m"


def test_star_jobs_start_with_partitions_of_their_own_size(spark, tmp_path, monkeypatch):
    star_root = str(tmp_path)
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 1.0D AS o_totalprice, "
              "timestamp'1997-01-01' AS o_orderdate, 'x' AS o_orderpriority FROM range(10)").write.parquet(f"{star_root}/orders.parquet")
    sizes = Tables(spark, 64 * 1024 * 1024)
    sizes._opened("lines", sizes.spark.range(10**9))  # known size of 8 GB
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(sizes.spark.conf.get(key)) == -(-8 * 10**9 // 2**26)
    assert from_star(spark, star_root).orders.sparkSession.conf.get(key) == "4"
    monkeypatch.setattr(star_roles, "INPUT_PER_PARTITION", 100)
    assert int(from_star(spark, star_root).orders.sparkSession.conf.get(key)) > 4
