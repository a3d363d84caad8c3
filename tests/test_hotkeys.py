"""A join with one key on a third of the rows: same rows as the plain join, even tasks."""

from pyspark.sql import functions as F

from tallyport.operators import hotkeys


def tables(spark):
    fact = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"),
                                      F.col("id").alias("v"))
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k long, v long"))
    dim = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return fact, dim


def test_same_rows_as_plain_join(spark):
    fact, dim = tables(spark)
    assert hotkeys.hot_keys(fact, "k") == [7]
    got = sorted(tuple(r) for r in hotkeys.skew_join(fact, dim, "k").collect())
    assert got == sorted(tuple(r) for r in fact.join(dim, "k").collect())


def test_hot_rows_do_not_shuffle(spark):
    fact, dim = tables(spark)
    joined = hotkeys.skew_join(fact, dim, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    counts = sorted(r["count"] for r in per_task)
    assert counts[-1] < 2 * counts[len(counts) // 2] + 10_000 // len(counts) + 1


def test_no_hot_key_and_empty(spark):
    fact, dim = tables(spark)
    cold = fact.where("k <> 7")
    assert hotkeys.hot_keys(cold, "k", share=0.5) == []
    assert hotkeys.skew_join(cold.limit(0), dim, "k").count() == 0
