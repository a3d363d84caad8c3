"""Theta sketch rollup: exact below its size, within the stated bound above, merged over any subset."""

from pyspark.sql import functions as F

from tallyport.operators import sketches


def sketch_rows(spark, lg_k):
    # 6 months, 3 states; customer i buys in month i % 6 and i % 6 + 1, state by i % 3; one state holds a third.
    rows = [(f"2017-0{m + 1}", f"S{i % 3}", i) for i in range(6000) for m in {i % 6, min(i % 6 + 1, 5)}]
    rows += [("2017-01", "S0", None)]
    frame = spark.createDataFrame(rows, "ym string, customer_state string, customer_unique_id long")
    return frame.where("customer_unique_id IS NOT NULL").groupBy("ym", "customer_state").agg(
        F.theta_sketch_agg("customer_unique_id", lg_k).alias("customers")), rows


def test_exact_below_size(spark):
    sk, rows = sketch_rows(spark, 14)
    got = {r.customer_state: r.unique_customers for r in sketches.distinct_customers(sk, ["customer_state"], 14).collect()}
    assert got == {s: len({c for _, st, c in rows if st == s and c is not None}) for s in ("S0", "S1", "S2")}
    total = sketches.distinct_customers(sk, [], 14).first()
    assert total.unique_customers == 6000


def test_within_bound_above_size(spark):
    sk, rows = sketch_rows(spark, 6)
    for r in sketches.distinct_customers(sk, ["customer_state"], 6).collect():
        exact = len({c for _, st, c in rows if st == r.customer_state and c is not None})
        assert abs(r.unique_customers - exact) <= r.error_bound
    months = {m: {c for ym, _, c in rows if ym == m and c is not None} for m in {x[0] for x in rows}}
    for r in sketches.returning_customers(sk, 6).collect():
        exact = len(months[r.ym] & months[r.next_ym])
        assert abs(r.returning - exact) <= r.error_bound


def test_returning_exact(spark):
    sk, rows = sketch_rows(spark, 14)
    months = {m: {c for ym, _, c in rows if ym == m and c is not None} for m in {x[0] for x in rows}}
    got = {(r.ym, r.next_ym): r.returning for r in sketches.returning_customers(sk, 14).collect()}
    order = sorted(months)
    assert got == {(a, b): len(months[a] & months[b]) for a, b in zip(order, order[1:])}
