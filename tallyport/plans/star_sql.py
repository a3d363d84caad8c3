"""SQL counterparts of the registered queries, for an independent check in DuckDB.

They are written the plain way: row-by-row joins that fan out, DISTINCT counts and
decimal sums, where the Spark jobs reduce before joining. Equal results therefore
check that the reductions are exact.
"""

from __future__ import annotations

from tallyport.operators.anomaly import GMV_HINT, SCORE_HINT, STATE_HINT
from tallyport.operators.questions import DEFAULT_REPORTS, SHORT_LENGTH
from tallyport.operators.reviews import NO_THEME, NO_THEME_SUMMARY
from tallyport.plans import star

YEAR = star.YEAR

# --- commerce roles as CTEs --------------------------------------------------

ROLES = {
    "o": """o AS (
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS bought,
               CASE WHEN CAST(round(o_totalprice * 100) AS BIGINT) % 45 <> 44
                    THEN o_orderdate + to_days(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 45 AS INTEGER)) END AS done,
               o_orderdate + to_days(30) AS due,
               strftime(o_orderdate, '%Y-%m') AS ym
        FROM orders)""",
    "d": "d AS (SELECT * FROM o WHERE order_status = 'F')",
    "i": """i AS (
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_quantity * round(l_tax * 100) * 0.5 AS freight
        FROM lineitem)""",
    "p": """p AS (
        SELECT p_partkey AS product_id, CASE WHEN p_size <> 50 THEN p_type END AS original,
               CASE WHEN p_size <> 50 THEN
                 CASE p_type WHEN 'ECONOMY' THEN 'economy_goods' WHEN 'LARGE' THEN 'large_goods'
                   WHEN 'MEDIUM' THEN 'medium_goods' WHEN 'PROMO' THEN 'promotion_goods'
                   WHEN 'SMALL' THEN 'small_goods' ELSE p_type END END AS category,
               CAST(length(p_name) AS DOUBLE) AS name_length, CAST(p_size % 5 AS DOUBLE) AS photos,
               p_size * 250.0::DOUBLE AS weight, CAST(p_size + 10 AS DOUBLE) AS len,
               CAST(p_size % 20 + 2 AS DOUBLE) AS height, CAST(p_size % 30 + 6 AS DOUBLE) AS width
        FROM part)""",
    "c": """c AS (
        SELECT c_custkey AS customer_id, c_custkey // 2 AS unique_id, CAST(c_custkey % 1000 AS INTEGER) AS zip,
               c_mktsegment AS city, n_name AS customer_state, c_nationkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "s": """s AS (
        SELECT s_suppkey AS seller_id, CAST(s_suppkey % 1500 AS INTEGER) AS zip, 'SELLER CITY' AS city,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "pay": """pay AS (
        SELECT o_orderkey AS order_id, 1 AS seq, o_orderpriority AS payment_type,
               CAST(o_custkey % 14 + 1 AS INTEGER) AS installments, o_totalprice AS value FROM orders
        UNION ALL
        SELECT o_orderkey, 2, 'VOUCHER', 1, 10.0 FROM orders WHERE o_custkey % 5 = 0)""",
    "r": """r AS (
        SELECT l_orderkey || '-' || l_returnflag AS review_id, l_orderkey AS order_id,
               CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 3 ELSE 5 END AS score
        FROM lineitem GROUP BY l_orderkey, l_returnflag)""",
    "t": """t AS (
        SELECT d0.doc_id AS review_id, d0.doc_id AS order_id,
               CAST(1 + 2 * quality + 2 * (1 - toxic) AS INTEGER) AS score, source AS title, text AS message
        FROM documents d0 LEFT JOIN labels l0 ON d0.doc_id = l0.doc_id)""",
    # One row per text review and item of its order.
    "rows": """rows AS (
        SELECT t.review_id, t.score, t.message, p.category
        FROM t JOIN o ON t.order_id = o.order_id JOIN i ON i.order_id = o.order_id
        JOIN p ON p.product_id = i.product_id WHERE t.message IS NOT NULL)""",
    "n": f"""n AS (
        SELECT *, strip_accents(lower(message)) AS norm
        FROM rows)""",
}
NEEDS = {"d": ["o"], "rows": ["o", "i", "p", "t"], "n": ["rows"]}


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def money(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def tenths(x: str, digits: int = 1) -> str:
    return f"(CAST(sum(CAST({x} AS DECIMAL(18,{digits}))) AS DOUBLE) / nullif(count({x}), 0))"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def with_roles(roles: str, body: str, *ctes: str) -> str:
    """WITH the named roles (and what they need), further CTEs, then the body."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for role in roles.split():
        add(role)
    parts = [ROLES[name] for name in order] + list(ctes)
    return f"WITH {', '.join(parts)} {body}" if parts else body


# --- rollups as CTEs ---------------------------------------------------------

_ROLLUP_ROLES = {
    "mv_monthly_sales": "d i", "mv_state_sales": "d i c", "mv_category_sales": "d i p",
    "mv_delivery_perf": "d c", "mv_seller_perf": "d i s r", "mv_payment_dist": "d pay",
}
_ROLLUP_BODY = {
    "mv_monthly_sales": f"""
        SELECT ym, {money('price')} AS total_gmv, count(DISTINCT order_id) AS total_orders,
               {rnd(money('price') + ' / count(DISTINCT order_id)', 2)} AS avg_basket, {money('freight')} AS total_freight
        FROM d JOIN i USING (order_id) GROUP BY ym""",
    "mv_state_sales": f"""
        SELECT ym, customer_state, {money('price')} AS total_gmv, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT unique_id) AS unique_customers
        FROM d JOIN i USING (order_id) JOIN c USING (customer_id) GROUP BY ym, customer_state""",
    "mv_category_sales": f"""
        SELECT ym, category AS product_category_english, {money('price')} AS total_gmv,
               count(DISTINCT order_id) AS total_orders, {rnd(money('price') + ' / count(price)', 2)} AS avg_price
        FROM d JOIN i USING (order_id) JOIN p USING (product_id) GROUP BY ym, category""",
    "mv_delivery_perf": f"""
        SELECT ym, customer_state,
               {rnd("CAST(sum(datediff('day', bought, done)) AS DOUBLE) / count(*)", 1)} AS avg_delivery_days,
               {rnd("sum(CASE WHEN done <= due THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)", 1)} AS on_time_rate,
               {big("sum(CASE WHEN done > due THEN 1 ELSE 0 END)")} AS delayed_orders
        FROM d JOIN c USING (customer_id) WHERE done IS NOT NULL AND due IS NOT NULL GROUP BY ym, customer_state""",
    "mv_seller_perf": f"""
        SELECT ym, seller_id, seller_state, {money('price')} AS total_gmv, count(DISTINCT d.order_id) AS total_orders,
               {rnd("CAST(sum(score) AS DOUBLE) / count(score)", 2)} AS avg_review_score
        FROM d JOIN i ON d.order_id = i.order_id JOIN s USING (seller_id) LEFT JOIN r ON r.order_id = d.order_id
        GROUP BY ym, seller_id, seller_state""",
    "mv_payment_dist": f"""
        SELECT ym, payment_type, count(*) AS total_transactions,
               {rnd("CAST(sum(installments) AS DOUBLE) / count(installments)", 1)} AS avg_installments,
               {money('value')} AS total_value
        FROM d JOIN pay USING (order_id) GROUP BY ym, payment_type""",
}
M, ST, CAT, DEL, SEL, PAYM = _ROLLUP_BODY

SQL: dict[str, str] = {name: with_roles(_ROLLUP_ROLES[name], body) for name, body in _ROLLUP_BODY.items()}


def on(rollup: str, body: str, *ctes: str, roles: str = "") -> str:
    """A query over one rollup, which the body calls mv."""
    return with_roles(f"{_ROLLUP_ROLES[rollup]} {roles}", body, f"mv AS ({_ROLLUP_BODY[rollup]})", *ctes)


def on_many(rollups: list[str], body: str, *ctes: str, roles: str = "") -> str:
    needed = " ".join(_ROLLUP_ROLES[r] for r in rollups)
    return with_roles(f"{needed} {roles}", body, *[f"{r} AS ({_ROLLUP_BODY[r]})" for r in rollups], *ctes)


SQL["mv_seller_perf_exact"] = with_roles(
    "d i s r",
    f"""SELECT ym, seller_id, seller_state, {money('gmv')} AS total_gmv, count(*) AS total_orders,
               {rnd("CAST(sum(score_sum) AS DOUBLE) / sum(scored)", 2)} AS avg_review_score
        FROM sale JOIN s USING (seller_id) LEFT JOIN stars USING (order_id) GROUP BY ym, seller_id, seller_state""",
    """sale AS (SELECT ym, d.order_id, seller_id, sum(CAST(price AS DECIMAL(18,2))) AS gmv
         FROM d JOIN i ON d.order_id = i.order_id GROUP BY ALL)""",
    "stars AS (SELECT order_id, sum(score) AS score_sum, count(score) AS scored FROM r GROUP BY order_id)",
)
SQL["rollup_row_counts"] = on_many(
    list(_ROLLUP_BODY),
    " UNION ALL ".join(f"SELECT '{r}' AS rollup, count(*) AS row_count FROM {r}" for r in _ROLLUP_BODY),
)

# --- metrics on rollups ------------------------------------------------------

_ALL = "ym, total_gmv, total_orders, avg_basket, total_freight"
SQL["monthly_series"] = on(M, f"SELECT {_ALL} FROM mv ORDER BY ym")
SQL["monthly_last_n"] = on(M, f"SELECT {_ALL} FROM mv ORDER BY ym DESC LIMIT 12")
SQL["monthly_of_year"] = on(
    M, f"SELECT ym, total_gmv, total_orders, avg_basket FROM mv WHERE ym LIKE '{YEAR}%' ORDER BY ym"
)
SQL["state_sales_of_year"] = on(
    ST,
    f"""SELECT customer_state, {money('total_gmv')} AS total_gmv, {big('sum(total_orders)')} AS total_orders,
        {big('sum(unique_customers)')} AS unique_customers FROM mv WHERE ym LIKE '{YEAR}%'
        GROUP BY customer_state ORDER BY total_gmv DESC, customer_state""",
)
SQL["top_states"] = on(
    ST,
    f"""SELECT 'state_sales' AS metric, customer_state AS label, {money('total_gmv')} AS value,
        {big('sum(total_orders)')} AS count FROM mv WHERE ym LIKE '{YEAR}%'
        GROUP BY customer_state ORDER BY value DESC, label LIMIT 3""",
)
_DELIVERY = f"""SELECT customer_state, {rnd(tenths('on_time_rate'), 1)} AS avg_on_time,
    {rnd(tenths('avg_delivery_days'), 1)} AS avg_delivery_days, {big('sum(delayed_orders)')} AS total_delayed FROM mv"""
SQL["delivery_by_state"] = on(DEL, f"{_DELIVERY} GROUP BY customer_state ORDER BY avg_on_time NULLS FIRST, 1")
SQL["delivery_by_region_states"] = on(
    DEL,
    f"""{_DELIVERY} WHERE customer_state IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name = 'AMERICA') GROUP BY customer_state ORDER BY avg_on_time NULLS FIRST, 1""",
)
SQL["worst_delivery_states"] = on(
    DEL,
    f"""SELECT customer_state, {tenths('on_time_rate')} AS avg_on_time, {tenths('avg_delivery_days')} AS avg_delivery_days,
        {big('sum(delayed_orders)')} AS total_delayed FROM mv GROUP BY customer_state
        ORDER BY avg_on_time NULLS FIRST, customer_state LIMIT 10""",
)
SQL["payment_popularity"] = on(
    PAYM,
    f"""SELECT payment_type, {big('sum(total_transactions)')} AS total_orders,
        {rnd(tenths('avg_installments'), 1)} AS avg_installments, {money('total_value')} AS total_value
        FROM mv GROUP BY payment_type ORDER BY total_orders DESC, payment_type""",
)
SQL["worst_seller_months"] = on(
    SEL,
    """SELECT seller_id, seller_state, ym, total_gmv, total_orders, avg_review_score FROM mv
       WHERE total_orders >= 2 ORDER BY avg_review_score NULLS FIRST, ym, seller_id LIMIT 20""",
)


def worst(key: str, source: str, limit: int, state: bool = True) -> str:
    score = (
        "CAST(sum(CAST(avg_review_score AS DECIMAL(18,2)) * total_orders) AS DOUBLE) / nullif(sum(total_orders), 0)"
    )
    return f"""SELECT {key}, {'max(seller_state) AS seller_state,' if state else ''} {money('total_gmv')} AS total_gmv,
        {big('sum(total_orders)')} AS total_orders, {rnd(score, 2)} AS avg_review_score FROM {source}
        WHERE avg_review_score IS NOT NULL GROUP BY {key} HAVING sum(total_orders) >= 5
        ORDER BY avg_review_score NULLS FIRST, {key} LIMIT {limit}"""


SQL["worst_sellers"] = on(SEL, worst("seller_id", "mv", 20))
SQL["what_if_sellers"] = on(SEL, worst("seller_id", "mv", 5))
SQL["basket_by_state"] = on(
    ST,
    f"""SELECT customer_state, {rnd(money('total_gmv') + ' / sum(total_orders)', 0)} AS avg_basket FROM mv
        GROUP BY customer_state ORDER BY avg_basket DESC, 1""",
)
SQL["top_categories"] = on(
    CAT,
    f"""SELECT product_category_english AS category, {money('total_gmv')} AS total_gmv,
        {big('sum(total_orders)')} AS total_orders FROM mv GROUP BY 1 ORDER BY total_gmv DESC, 1 LIMIT 15""",
)
SQL["geo_state_gmv"] = on(ST, f"SELECT customer_state, {money('total_gmv')} AS total_gmv FROM mv GROUP BY 1 ORDER BY 1")
SQL["kpi_overview"] = on(
    M,
    f"""SELECT {big('sum(total_orders)')} AS total_orders, {rnd(money('total_gmv'), 0)} AS total_gmv,
        {rnd(tenths('avg_basket', 2), 0)} AS avg_basket FROM mv""",
)
SQL["gmv_growth"] = on(
    ST,
    f"""SELECT a.customer_state, a.ym, a.total_gmv, b.total_gmv AS previous,
        {rnd("(a.total_gmv - b.total_gmv) * 100.0::DOUBLE / nullif(b.total_gmv, 0)", 2)} AS growth_pct
        FROM mv a LEFT JOIN mv b ON a.customer_state = b.customer_state
         AND b.ym = strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""",
)
SQL["category_trends"] = on(
    CAT,
    f"""SELECT category, months, {rnd('slope', 2)} AS gmv_slope_per_month, last_gmv, slope < 0 AS declining FROM (
        SELECT product_category_english AS category, count(*) AS months,
          regr_slope(total_gmv, CAST(ym[1:4] AS INTEGER) * 12 + CAST(ym[6:7] AS INTEGER)) AS slope,
          arg_max(total_gmv, ym) AS last_gmv
        FROM mv WHERE product_category_english IS NOT NULL GROUP BY 1) WHERE months >= 3""",
)
SQL["declining_categories"] = f"SELECT * FROM ({SQL['category_trends']}) WHERE declining"
SQL["monthly_series_long"] = on(
    M,
    """SELECT ym, 'total_gmv' AS series, total_gmv AS value FROM mv
       UNION ALL SELECT ym, 'total_orders', CAST(total_orders AS DOUBLE) FROM mv""",
)
SQL["adhoc_cte_sql"] = with_roles(
    "o c",
    """SELECT customer_state, order_status, count(*) AS orders,
         string_agg(DISTINCT CAST(year(bought) AS VARCHAR), ',' ORDER BY CAST(year(bought) AS VARCHAR)) AS years
       FROM o JOIN c USING (customer_id) GROUP BY 1, 2 HAVING count(*) >= 2""",
)

# --- base-table diagnostics --------------------------------------------------

SQL["delivery_routes"] = with_roles(
    "d i c s",
    f"""SELECT customer_state, seller_state,
          CASE WHEN customer_state = seller_state THEN 'same_state' ELSE 'cross_state' END AS route_type,
          seller_state || ' to ' || customer_state AS route, count(DISTINCT d.order_id) AS total_orders,
          {rnd("CAST(sum(datediff('day', bought, done)) AS DOUBLE) / count(*)", 1)} AS avg_delivery_days,
          {rnd("sum(CASE WHEN done <= due THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)", 1)} AS on_time_rate,
          {big("sum(CASE WHEN done > due THEN 1 ELSE 0 END)")} AS delayed_orders
        FROM d JOIN c USING (customer_id) JOIN i ON i.order_id = d.order_id JOIN s USING (seller_id)
        WHERE done IS NOT NULL AND due IS NOT NULL
        GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT d.order_id) >= 2
        ORDER BY avg_delivery_days DESC, customer_state, seller_state LIMIT 30""",
)
_BINS = with_roles(
    "i p",
    """SELECT round(weight, -2) AS weight_g, round(freight, 0) AS freight, count(*) AS cnt
       FROM i JOIN p USING (product_id) WHERE weight IS NOT NULL AND freight IS NOT NULL
       GROUP BY 1, 2 HAVING count(*) >= 2""",
)
SQL["weight_freight_bins"] = _BINS
SQL["weight_freight_bins_bounded"] = with_roles(
    "i p",
    """SELECT round(weight, -2) AS weight_g, round(freight, 0) AS freight, count(*) AS cnt
       FROM i JOIN p USING (product_id) WHERE weight < 50000 AND freight < 200
       GROUP BY 1, 2 HAVING count(*) >= 2""",
)
SQL["weight_freight_ontime"] = with_roles(
    "o i p",
    """SELECT round(weight, -2) AS product_weight_g, round(freight, 0) AS freight_value, count(*) AS order_count,
         CAST(sum(CASE WHEN done <= due THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS on_time_rate
       FROM i JOIN p USING (product_id) JOIN o USING (order_id) WHERE weight IS NOT NULL AND freight IS NOT NULL
       GROUP BY 1, 2 HAVING count(*) >= 2""",
)
SQL["trim_p95"] = f"""WITH b AS ({_BINS}),
    q AS (SELECT quantile_cont(weight_g, 0.95) AS x, quantile_cont(freight, 0.95) AS y, count(*) AS n FROM b),
    k AS (SELECT count(*) AS kept FROM b, q WHERE weight_g <= x AND freight <= y)
    SELECT b.* FROM b, q, k WHERE n <= 10 OR kept < 10 OR (weight_g <= x AND freight <= y)"""
SQL["axis_ranges"] = f"""WITH b AS ({_BINS}) SELECT min(weight_g) * 0.9::DOUBLE AS x_low, max(weight_g) * 1.05::DOUBLE AS x_high,
    min(freight) * 0.9::DOUBLE AS y_low, max(freight) * 1.05::DOUBLE AS y_high FROM b"""


def negative(reviews: str, having: int = 10) -> str:
    return f"""SELECT p.category, {rnd("CAST(sum(v.score) AS DOUBLE) / count(*)", 2)} AS avg_score, count(*) AS negative_reviews
        FROM {reviews} v JOIN o ON v.order_id = o.order_id JOIN i ON i.order_id = o.order_id
        JOIN p ON p.product_id = i.product_id WHERE v.score <= 2
        GROUP BY 1 HAVING count(*) >= {having} ORDER BY negative_reviews DESC, 1 LIMIT 10"""


SQL["negative_categories"] = with_roles("o i p r", negative("r"))
SQL["category_reviews"] = with_roles(
    "o i p r",
    f"""SELECT p.category, {rnd("CAST(sum(r.score) AS DOUBLE) / count(r.score)", 2)} AS avg_score, count(*) AS review_count,
        {big("sum(CASE WHEN r.score <= 2 THEN 1 ELSE 0 END)")} AS negative_count,
        {big("sum(CASE WHEN r.score >= 4 THEN 1 ELSE 0 END)")} AS positive_count
        FROM r JOIN o ON r.order_id = o.order_id JOIN i ON i.order_id = o.order_id
        JOIN p ON p.product_id = i.product_id GROUP BY 1 ORDER BY review_count DESC, 1""",
)
_SHARE = f"""SELECT payment_type, installments AS payment_installments, count(*) AS n,
    {rnd("count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY payment_type)", 1)} AS share_pct
    FROM pay WHERE installments IS NOT NULL GROUP BY 1, 2"""
SQL["installment_share"] = with_roles("pay", _SHARE)
SQL["installment_share_bounded"] = with_roles("pay", _SHARE.replace("IS NOT NULL", "BETWEEN 1 AND 12"))
SQL["installment_matrix"] = with_roles(
    "pay",
    "SELECT payment_type, "
    + ", ".join(f"sum(CASE WHEN payment_installments = {i} THEN share_pct END) AS inst_{i}" for i in range(1, 13))
    + ", sum(CASE WHEN payment_installments NOT BETWEEN 1 AND 12 THEN share_pct END) AS inst_other"
    + " FROM share GROUP BY 1",
    f"share AS ({_SHARE})",
)
SQL["review_category_rows"] = with_roles(
    "rows",
    """SELECT review_id, score AS review_score, category, count(*) AS weight, message AS review_comment_message
       FROM rows GROUP BY review_id, score, category, message""",
)
SQL["state_centroids"] = on(
    ST,
    f"""SELECT g.customer_state, g.total_gmv, lat, lng
        FROM (SELECT customer_state, {money('total_gmv')} AS total_gmv FROM mv GROUP BY 1) g
        JOIN (SELECT customer_state, avg(CAST(c_nationkey - 20 + customer_id % 4 * 0.25 AS DOUBLE)) AS lat,
                     avg(CAST(c_nationkey * 2 - 70 + customer_id % 8 * 0.125 AS DOUBLE)) AS lng
              FROM c GROUP BY 1) q USING (customer_state)""",
)
_BASE_RANKING = f"""SELECT customer_state, {money('price')} AS total_gmv, count(DISTINCT d.order_id) AS total_orders
    FROM d JOIN i ON i.order_id = d.order_id JOIN c USING (customer_id)
    WHERE bought >= TIMESTAMP '{YEAR}-01-01' AND bought < TIMESTAMP '{YEAR + 1}-01-01' GROUP BY 1"""
SQL["state_sales_of_year_base"] = with_roles("d i c", _BASE_RANKING)
SQL["platform_score"] = with_roles(
    "r", "SELECT CAST(sum(score) AS DOUBLE) / count(score) AS avg_score, count(DISTINCT review_id) AS review_count FROM r"
)
SQL["worst_example_per_category"] = with_roles(
    "o i p t",
    f"""SELECT s0.category, {rnd('exact_score', 2)} AS avg_review_score, total_reviews, bad_reviews,
          {rnd('bad_reviews * 100.0::DOUBLE / total_reviews', 1)} AS bad_review_pct, total_orders,
          coalesce(e.message, 'N/A') AS example_bad_comment
        FROM stats s0 LEFT JOIN example e ON s0.category = e.category""",
    f"""stats AS (SELECT p.category, CAST(sum(t.score) AS DOUBLE) / count(t.score) AS exact_score,
          count(DISTINCT t.review_id) AS total_reviews,
          {big("sum(CASE WHEN t.score <= 2 THEN 1 ELSE 0 END)")} AS bad_reviews,
          count(DISTINCT o.order_id) AS total_orders
        FROM t JOIN o ON t.order_id = o.order_id JOIN i ON i.order_id = o.order_id JOIN p ON p.product_id = i.product_id
        GROUP BY 1 ORDER BY exact_score NULLS FIRST, 1 LIMIT 10)""",
    """example AS (SELECT category, message FROM (
          SELECT p.category, t.message, row_number() OVER (PARTITION BY p.category ORDER BY t.score, t.review_id) AS rn
          FROM t JOIN o ON t.order_id = o.order_id JOIN i ON i.order_id = o.order_id JOIN p ON p.product_id = i.product_id
          WHERE t.score <= 2) WHERE rn = 1)""",
)
SQL["order_detail"] = with_roles(
    "o i p c s t",
    """SELECT o.order_id, order_item_id, order_status, strftime(bought, '%Y-%m-%d %H:%M:%S') AS bought_at,
         customer_state, seller_state, category, price, freight AS freight_value
       FROM o JOIN i ON i.order_id = o.order_id JOIN p USING (product_id) JOIN s USING (seller_id)
       JOIN c USING (customer_id) WHERE o.order_id IN (SELECT order_id FROM t)""",
)
SQL["slow_states"] = with_roles(
    "d c",
    f"""SELECT customer_state, orders, {rnd('state_mean', 2)} AS avg_delivery_days, {rnd('national', 2)} AS national_avg_days
        FROM per_state, (SELECT CAST(sum(days) AS DOUBLE) / count(*) AS national FROM x) WHERE state_mean > national""",
    """x AS (SELECT customer_state, datediff('day', bought, done) AS days FROM d JOIN c USING (customer_id)
        WHERE done IS NOT NULL)""",
    """per_state AS (SELECT customer_state, count(*) AS orders, CAST(sum(days) AS DOUBLE) / count(*) AS state_mean
        FROM x GROUP BY 1)""",
)
SQL["seller_negative_rate"] = with_roles(
    "i s r",
    f"""SELECT seller_id, seller_state, count(score) AS reviews, {big("sum(CASE WHEN score <= 2 THEN 1 ELSE 0 END)")} AS negative_reviews,
        {rnd("sum(CASE WHEN score <= 2 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(score)", 2)} AS negative_pct
        FROM (SELECT DISTINCT order_id, seller_id FROM i) JOIN r USING (order_id) JOIN s USING (seller_id) GROUP BY 1, 2""",
)
SQL["weight_freight_corr"] = with_roles(
    "i p",
    f"""SELECT count(*) AS items, {rnd('corr(weight, freight)', 6)} AS weight_freight_corr,
        {rnd('corr(len * height * width, freight)', 6)} AS volume_freight_corr FROM i JOIN p USING (product_id)""",
)

# --- view-first metrics and reconciliation -----------------------------------

SQL["metric_view_hit"] = on(
    ST,
    f"""SELECT customer_state, {money('total_gmv')} AS total_gmv, {big('sum(total_orders)')} AS total_orders,
        {rnd(money('total_gmv') + ' / sum(total_orders)', 2)} AS avg_basket, 'mv_state_sales' AS source, 'view' AS strategy
        FROM mv WHERE ym LIKE '{YEAR}%' GROUP BY 1""",
)
SQL["metric_base_fallback"] = with_roles(
    "d i c p",
    f"""SELECT customer_state, category, {money('price')} AS total_gmv, count(DISTINCT d.order_id) AS total_orders,
        count(DISTINCT unique_id) AS unique_customers, 'delivered_items' AS source, 'base_table' AS strategy
        FROM d JOIN i ON i.order_id = d.order_id JOIN c USING (customer_id) JOIN p USING (product_id) GROUP BY 1, 2""",
)
SQL["metric_base_fallback_of_year"] = with_roles(
    "d i c",
    f"""SELECT customer_state, city AS customer_city, {money('price')} AS total_gmv, count(DISTINCT d.order_id) AS total_orders,
        {rnd(money('price') + ' / count(price)', 2)} AS avg_price, 'delivered_items' AS source, 'base_table' AS strategy
        FROM d JOIN i ON i.order_id = d.order_id JOIN c USING (customer_id) WHERE year(bought) = {YEAR} GROUP BY 1, 2""",
)
SQL["metric_review_score_by_state"] = with_roles(
    "o c r",
    f"""SELECT customer_state, {rnd("CAST(sum(score) AS DOUBLE) / count(score)", 2)} AS avg_review_score, count(*) AS review_count,
        {rnd("count(*) FILTER (score <= 2) * 100.0::DOUBLE / count(score)", 1)} AS negative_review_rate,
        'order_reviews' AS source, 'base_table' AS strategy
        FROM r JOIN o USING (order_id) JOIN c USING (customer_id) GROUP BY 1""",
)
SQL["metric_review_score_by_category"] = with_roles(
    "o i p r",
    f"""SELECT category, {rnd("CAST(sum(score) AS DOUBLE) / count(score)", 2)} AS avg_review_score, count(*) AS review_count,
        'order_reviews' AS source, 'base_table' AS strategy
        FROM (SELECT DISTINCT review_id, score, category FROM r JOIN o USING (order_id) JOIN i USING (order_id) JOIN p USING (product_id))
        GROUP BY 1""",
)
SQL["metric_gmv_and_on_time"] = with_roles(
    "d i c",
    f"""SELECT customer_state, total_gmv, on_time_rate, 'mv_state_sales+mv_delivery_perf' AS source, 'view' AS strategy
        FROM (SELECT customer_state, {money('price')} AS total_gmv FROM d JOIN i ON i.order_id = d.order_id JOIN c USING (customer_id) GROUP BY 1)
        FULL JOIN (SELECT customer_state, {rnd("count(*) FILTER (done <= due) * 100.0::DOUBLE / count(*)", 1)} AS on_time_rate
          FROM d JOIN c USING (customer_id) WHERE done IS NOT NULL AND due IS NOT NULL GROUP BY 1) USING (customer_state)""",
)
SQL["metric_gmv_and_payments"] = with_roles(
    "o d i pay r",
    f"""SELECT ym, total_gmv, total_value, avg_review_score, 'mv_monthly_sales+mv_payment_dist+order_reviews' AS source, 'base_table' AS strategy
        FROM (SELECT strftime(bought, '%Y-%m') AS ym, {money('price')} AS total_gmv FROM d JOIN i ON i.order_id = d.order_id GROUP BY 1)
        FULL JOIN (SELECT strftime(bought, '%Y-%m') AS ym, {money('value')} AS total_value FROM d JOIN pay USING (order_id) GROUP BY 1) USING (ym)
        FULL JOIN (SELECT strftime(bought, '%Y-%m') AS ym, {rnd("CAST(sum(score) AS DOUBLE) / count(score)", 2)} AS avg_review_score
          FROM r JOIN o USING (order_id) GROUP BY 1) USING (ym)""",
)
SQL["reconcile_state_sales"] = on(
    ST,
    """SELECT count(v.in_v) AS view_rows, count(b.in_b) AS base_rows,
         count(*) FILTER (v.in_v IS NULL OR b.in_b IS NULL) AS unmatched_keys,
         coalesce(max(abs(v.total_gmv - b.total_gmv)), 0) AS max_diff_total_gmv,
         CAST(coalesce(max(abs(v.total_orders - b.total_orders)), 0) AS DOUBLE) AS max_diff_total_orders,
         count(*) FILTER (v.in_v = 1 AND b.in_b = 1 AND ((v.total_gmv IS NULL) <> (b.total_gmv IS NULL))) AS null_mismatch_total_gmv,
         count(*) FILTER (v.in_v = 1 AND b.in_b = 1 AND ((v.total_orders IS NULL) <> (b.total_orders IS NULL)))
           AS null_mismatch_total_orders
       FROM v FULL JOIN b ON v.customer_state IS NOT DISTINCT FROM b.customer_state""",
    f"""v AS (SELECT customer_state, {money('total_gmv')} AS total_gmv, sum(total_orders) AS total_orders, 1 AS in_v
        FROM mv WHERE ym LIKE '{YEAR}%' GROUP BY 1)""",
    f"b AS (SELECT *, 1 AS in_b FROM ({_BASE_RANKING}))",
)

# --- anomalies and what-if ---------------------------------------------------

_GMV_ALERT = f"""SELECT 'gmv_anomaly' AS type, CASE WHEN abs(z) >= 3 THEN 'high' ELSE 'medium' END AS severity, ym,
    total_gmv AS value, {rnd('z', 2)} AS z_score, CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS direction,
    'Month ' || ym || ' GMV is ' || CAST(CAST(round(CAST(abs(z) AS DECIMAL(38,10)), 1) AS DECIMAL(30,1)) AS VARCHAR)
      || ' std deviations ' || CASE WHEN z > 0 THEN 'above' ELSE 'below' END || ' mean.' AS detail,
    '{GMV_HINT}' AS action_hint
    FROM (SELECT ym, total_gmv, (total_gmv - avg(total_gmv) OVER ()) / stddev_samp(total_gmv) OVER () AS z FROM mv_monthly_sales)
    WHERE abs(z) > 1.5"""
_STATE_ALERT = f"""SELECT 'state_sales_drop' AS type, CASE WHEN fall >= 50 THEN 'high' ELSE 'medium' END AS severity,
    customer_state AS state, ym, recent AS recent_gmv, {rnd('earlier', 2)} AS avg_gmv, {rnd('fall', 1)} AS drop_pct,
    'State ' || customer_state || ' GMV dropped ' || CAST(CAST(round(CAST(fall AS DECIMAL(38,10)), 0) AS BIGINT) AS VARCHAR)
      || '% in ' || ym || ' compared to its historical average.' AS detail, '{STATE_HINT}' AS action_hint
    FROM (SELECT *, (earlier - recent) / earlier * 100 AS fall FROM (
      SELECT customer_state, count(*) AS months, max(ym) AS ym, max(total_gmv) FILTER (ym = last_ym) AS recent,
        CAST(sum(CAST(total_gmv AS DECIMAL(18,2))) FILTER (ym < last_ym) AS DOUBLE) / (count(*) - 1) AS earlier
      FROM (SELECT *, max(ym) OVER (PARTITION BY customer_state) AS last_ym FROM mv_state_sales) GROUP BY 1)
      WHERE months >= 3 AND earlier > 0) WHERE fall > 30"""
_SCORES = """scores AS (SELECT p.category, o.ym, CAST(sum(r.score) AS DOUBLE) / count(r.score) AS avg_score
    FROM r JOIN o ON r.order_id = o.order_id JOIN i ON i.order_id = o.order_id JOIN p ON p.product_id = i.product_id
    GROUP BY 1, 2 HAVING count(*) >= 10)"""
_SCORE_ALERT = f"""SELECT 'review_score_drop' AS type, CASE WHEN fall >= 1.0 THEN 'high' ELSE 'medium' END AS severity,
    category, ym, {rnd('recent', 2)} AS recent_score, {rnd('earlier', 2)} AS historical_avg, {rnd('fall', 2)} AS "drop",
    'Category ''' || category || ''' review score dropped by '
      || CAST(CAST(round(CAST(fall AS DECIMAL(38,10)), 1) AS DECIMAL(30,1)) AS VARCHAR) || ' in ' || ym || '.' AS detail,
    '{SCORE_HINT}' AS action_hint
    FROM (SELECT category, count(*) AS months, max(ym) AS ym, max(avg_score) FILTER (ym = last_ym) AS recent,
            avg(avg_score) FILTER (ym < last_ym) AS earlier,
            avg(avg_score) FILTER (ym < last_ym) - max(avg_score) FILTER (ym = last_ym) AS fall
          FROM (SELECT *, max(ym) OVER (PARTITION BY category) AS last_ym FROM scores WHERE category IS NOT NULL) GROUP BY 1)
    WHERE months >= 3 AND fall > 0.01"""
SQL["anomaly_monthly_gmv"] = on_many([M], _GMV_ALERT)
SQL["anomaly_state_drop"] = on_many([ST], _STATE_ALERT)
SQL["anomaly_score_drop"] = with_roles("o i p r", _SCORE_ALERT, _SCORES)
_ALERTS = f"""alerts AS (
    SELECT type, severity, ym, NULL AS state, NULL AS category, detail, action_hint FROM ({_GMV_ALERT})
    UNION ALL SELECT type, severity, ym, state, NULL, detail, action_hint FROM ({_STATE_ALERT})
    UNION ALL SELECT type, severity, ym, NULL, category, detail, action_hint FROM ({_SCORE_ALERT}))"""
SQL["anomaly_alerts"] = on_many([M, ST], "SELECT * FROM alerts", _SCORES, _ALERTS, roles="o i p r")
SQL["anomaly_summary"] = on_many(
    [M, ST],
    """SELECT count(*) AS alert_count, coalesce(string_agg(DISTINCT type, ',' ORDER BY type), '') AS alert_types,
         CASE WHEN count(*) > 0 THEN 'Detected ' || count(*) || ' anomalies across sales, state performance, and review scores.'
              ELSE 'No significant anomalies detected. All metrics within normal range.' END AS summary FROM alerts""",
    _SCORES, _ALERTS, roles="o i p r",
)


def what_if(rollup: str, touched: str) -> str:
    """The comparison row; `gone` holds removed segments, `touched` selects order ids."""
    return f"""SELECT {rnd('cur', 3)} AS current_avg_score, {rnd('new', 3)} AS new_avg_score,
          {rnd('new - cur', 3)} AS improvement, {rnd('(new - cur) * 100.0::DOUBLE / cur', 1)} AS improvement_pct,
          (SELECT count(*) FROM gone) AS removed_count, n AS current_reviews_count, kept AS remaining_reviews_count,
          (SELECT {money('total_gmv')} FROM gone) AS impacted_gmv,
          (SELECT {big('sum(total_orders)')} FROM gone) AS impacted_orders,
          {rnd(f"(SELECT {money('total_gmv')} FROM gone) * 100.0::DOUBLE / (SELECT {money('total_gmv')} FROM {rollup})", 2)} AS impacted_gmv_share_pct,
          {rnd(f"(SELECT sum(total_orders) FROM gone) * 100.0::DOUBLE / (SELECT sum(total_orders) FROM {rollup})", 2)} AS impacted_order_share_pct
        FROM (SELECT CAST(sum(score) AS DOUBLE) / count(*) AS cur, count(*) AS n FROM r),
             (SELECT coalesce(CAST(sum(score) AS DOUBLE) / nullif(count(*), 0), (SELECT avg(score) FROM r)) AS new, count(*) AS kept FROM r
              WHERE review_id NOT IN (SELECT r2.review_id FROM r r2 WHERE r2.order_id IN ({touched})))"""


SQL["what_if_remove_worst"] = on(
    SEL,
    what_if("mv", "SELECT order_id FROM i WHERE seller_id IN (SELECT seller_id FROM gone)"),
    f"gone AS ({worst('seller_id', 'mv', 20)})",
)
SQL["what_if_summary"] = on(
    SEL,
    """SELECT 'What-if: removing/screening the worst ' || removed_count || ' sellers changes average review score from '
         || CAST(CAST(current_avg_score AS DECIMAL(30,3)) AS VARCHAR) || ' to ' || CAST(CAST(new_avg_score AS DECIMAL(30,3)) AS VARCHAR)
         || ' (' || CAST(CAST(improvement_pct AS DECIMAL(30,1)) AS VARCHAR) || '%).' AS summary FROM w""",
    f"gone AS ({worst('seller_id', 'mv', 20)})",
    "w AS (" + what_if("mv", "SELECT order_id FROM i WHERE seller_id IN (SELECT seller_id FROM gone)") + ")",
)
SQL["what_if_remove_categories"] = with_roles(
    "d i p r",
    what_if("cat", "SELECT order_id FROM i JOIN p USING (product_id) WHERE category IN (SELECT category FROM gone)"),
    """sale AS (SELECT d.order_id, category, sum(CAST(price AS DECIMAL(18,2))) AS gmv FROM d JOIN i ON i.order_id = d.order_id
        JOIN p USING (product_id) WHERE category IS NOT NULL GROUP BY 1, 2)""",
    "stars AS (SELECT order_id, sum(score) AS score_sum, count(score) AS scored FROM r GROUP BY order_id)",
    f"""cat AS (SELECT category, {money('gmv')} AS total_gmv, count(*) AS total_orders,
        {rnd('CAST(sum(score_sum) AS DOUBLE) / sum(scored)', 2)} AS avg_review_score
        FROM sale LEFT JOIN stars USING (order_id) GROUP BY 1)""",
    f"gone AS ({worst('category', 'cat', 2, False)})",
)

# --- forecasts ---------------------------------------------------------------

_HISTORY = """h AS (
    SELECT 'total:all' AS series, ym, CAST(ym || '-01' AS DATE) AS ds, total_gmv AS y FROM mv_monthly_sales
    UNION ALL SELECT 'state:' || customer_state, ym, CAST(ym || '-01' AS DATE), total_gmv FROM mv_state_sales
      WHERE customer_state IS NOT NULL
    UNION ALL SELECT 'category:' || product_category_english, ym, CAST(ym || '-01' AS DATE), total_gmv
      FROM mv_category_sales WHERE product_category_english IS NOT NULL)"""


def fit(divisor: float) -> str:
    x, y = "CAST(ds - DATE '1970-01-01' AS DOUBLE)", f"y / {divisor}::DOUBLE"
    return f"""f AS (SELECT *, sqrt(greatest(syy - slope * sxy, 0) / (points - 2)) AS sigma FROM (
        SELECT series, count(*) AS points, regr_slope({y}, {x}) AS slope, avg({x}) AS mx, avg({y}) AS my,
          regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy, max(ds) AS last_ds,
          arg_max({y}, ds) AS last_y FROM h GROUP BY 1) WHERE points >= 4)"""


_PLAN = {
    # weeks: (granularity, unit, periods, divisor, future dates, bucket, shown)
    1: ("daily", "daily_gmv", 7, 30.437, "last_ds + CAST(unnest(range(1, 50)) AS INTEGER)", "d", "%Y-%m-%d"),
    6: ("weekly", "weekly_gmv", 6, 4.345, "last_ds + CAST(unnest(range(1, 43)) AS INTEGER)", "date_trunc('week', d)", "%Y-%m-%d"),
    26: ("monthly", "period_gmv", 6, 1.0, "CAST(last_ds + to_months(CAST(unnest(range(1, 7)) AS INTEGER)) AS DATE)", "date_trunc('month', d)", "%Y-%m"),
    130: ("annual", "monthly_gmv_mean", 2, 1.0, "last_ds + CAST(unnest(range(1, 941)) AS INTEGER)", "date_trunc('year', d)", "%Y"),
}
# Standard normal quantile of 0.9, for an 80 % interval.
_Z = "1.2815515655446006::DOUBLE"


def forecast(weeks: int, body: str, *ctes: str) -> str:
    """A query over fc (series, period, ds, yhat, lower, upper) and its fit f."""
    _, _, periods, divisor, dates, bucket, shown = _PLAN[weeks]
    x = "(CAST(d - DATE '1970-01-01' AS DOUBLE) - mx)"
    return on_many(
        [M, ST, CAT], body, _HISTORY, fit(divisor),
        f"days AS (SELECT *, {dates} AS d FROM f)",
        f"""pred AS (SELECT series, d, {bucket} AS b, my + slope * {x} AS yhat,
            {_Z} * sigma * sqrt(1 + 1.0::DOUBLE / points + {x} * {x} / sxx) AS spread FROM days)""",
        f"""fc AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY b) AS period, first_d, n_days,
            strftime(first_d, '{shown}') AS ds, greatest(yhat, 0) AS yhat, greatest(lo, 0) AS lower, greatest(hi, yhat, 0) AS upper
            FROM (SELECT series, b, min(d) AS first_d, count(*) AS n_days, avg(yhat) AS yhat, avg(yhat - spread) AS lo,
                    avg(yhat + spread) AS hi FROM pred GROUP BY 1, 2) QUALIFY period <= {periods})""",
        *ctes,
    )


SQL["forecast_history"] = on_many(
    [M, ST, CAT], "SELECT series, ym, strftime(ds, '%Y-%m-%d') AS ds, y FROM h", _HISTORY
)
SQL["forecast_trend_fit"] = on_many(
    [M, ST, CAT],
    f"SELECT series, points, {rnd('slope', 4)} AS slope, {rnd('my', 2)} AS mean_y, {rnd('sigma', 2)} AS sigma FROM f",
    _HISTORY, fit(1.0),
)
SQL["forecast_calendar"] = forecast(
    6, "SELECT series, CAST(period AS INTEGER) AS period, strftime(first_d, '%Y-%m-%d') AS ds, n_days AS days FROM fc"
)
for _name, _weeks in star.FORECASTS.items():
    _step, _unit = _PLAN[_weeks][:2]
    SQL[_name] = forecast(
        _weeks,
        f"""SELECT series, '{_step}' AS granularity, '{_unit}' AS unit, CAST(period AS INTEGER) AS period, ds,
            {rnd('yhat', 2)} AS yhat, {rnd('lower', 2)} AS yhat_lower, {rnd('upper', 2)} AS yhat_upper FROM fc""",
    )
_CI = "'+/- ' || CAST(CAST(round(CAST((upper - lower) / 2 AS DECIMAL(38,10)), 2) AS DECIMAL(30,2)) AS VARCHAR)"
SQL["forecast_interval_text"] = forecast(
    6, f"SELECT series, CAST(period AS INTEGER) AS period, ds, {_CI} AS ci_range FROM fc"
)


def direction_cte(weeks: int) -> str:
    divisor = _PLAN[weeks][3]
    return f"""dir AS (SELECT series, points, fps, CASE WHEN fps >= 3 AND points >= 3
          THEN (last_yhat - last_y) / last_y * 100 ELSE 0 END AS change
        FROM (SELECT series, count(*) AS points, arg_max(y, ds) / {divisor}::DOUBLE AS last_y FROM h GROUP BY 1)
        JOIN (SELECT series, count(*) AS fps, arg_max(yhat, period) AS last_yhat FROM fc GROUP BY 1) USING (series))"""


_DIRECTION = "CASE WHEN change > 5 THEN 'up' WHEN change < -5 THEN 'down' ELSE 'flat' END"
SQL["forecast_direction"] = forecast(
    26,
    f"""SELECT series, points, fps AS forecast_periods, {rnd('change', 1)} AS change_pct,
        {_DIRECTION} AS trend_direction FROM dir""",
    direction_cte(26),
)
SQL["forecast_summary"] = forecast(
    6,
    f"""SELECT series, 'Based on ' || points || ' months of historical data, total GMV is forecasted to be '
          || {_DIRECTION} || '. Next ' || fps || ' weekly periods forecasted. Confidence intervals: ' || ci AS model_summary
        FROM dir JOIN (SELECT series, string_agg(ds || ': ' || {_CI}, '; ' ORDER BY period) AS ci
                       FROM fc WHERE period <= 3 GROUP BY 1) USING (series)""",
    direction_cte(6),
)

# --- review texts ------------------------------------------------------------


def quoted(words) -> str:
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


def normalised(text: str) -> str:
    return f"strip_accents(lower({text}))"


def token_list(text: str) -> str:
    words = f"string_split(regexp_replace({normalised(text)}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' ')"
    return (
        f"list_filter({words}, lambda w: regexp_full_match(w, '[a-z]{{3,}}') AND w NOT IN ({quoted(star.STOP_WORDS)}))"
    )


_KIND = "CASE WHEN score >= 4 THEN 'positive' WHEN score <= 2 THEN 'negative' END"
SQL["text_normalise"] = with_roles("t", f"SELECT review_id, md5({normalised('message')}) AS text_md5 FROM t")
SQL["text_tokens"] = with_roles(
    "t",
    """SELECT review_id, len(words) AS n_tokens, md5(array_to_string(words, ' ')) AS tokens_md5
       FROM w""",
    f"w AS (SELECT review_id, {token_list('message')} AS words FROM t)",
)
_KEYWORDS = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, word) AS rank FROM (
    SELECT sentiment, word, count(*) AS n FROM (
      SELECT {_KIND} AS sentiment, unnest({token_list('message')}) AS word FROM rows) WHERE sentiment IS NOT NULL GROUP BY 1, 2))"""


def keywords(k: int) -> str:
    return with_roles(
        "rows", f"SELECT sentiment, word, n, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {k}", _KEYWORDS
    )


SQL["review_keywords"] = keywords(15)
SQL["word_frequencies"] = keywords(100)
_RULES = "rules AS (" + " UNION ALL ".join(
    f"SELECT {i} AS no, '{t.name}' AS theme, [{quoted(t.keywords)}] AS words, '{t.hint}' AS hint"
    for i, t in enumerate(star.THEMES)
) + ")"
_HITS = f"""chosen AS (SELECT *, {_KIND} AS sentiment FROM n WHERE norm <> '' AND {_KIND} IS NOT NULL),
    hits AS (SELECT sentiment, no, theme, hint, score, category, list_filter(words, lambda k: contains(norm, k)) AS found
      FROM chosen, rules WHERE len(list_filter(words, lambda k: contains(norm, k))) > 0)"""
_THEMES = f"""themes AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY review_count DESC, no) AS rank FROM (
      SELECT sentiment, no, theme, hint, count(*) AS review_count,
        {rnd("count(*) * 100.0::DOUBLE / (SELECT count(*) FROM chosen ch WHERE ch.sentiment = hits.sentiment)", 1)} AS share_pct,
        {rnd("CAST(sum(score) AS DOUBLE) / count(*)", 2)} AS avg_score
      FROM hits GROUP BY 1, 2, 3, 4)),
    kw AS (SELECT sentiment, no, string_agg(word, ', ' ORDER BY n DESC, word) AS top_keywords FROM (
      SELECT *, row_number() OVER (PARTITION BY sentiment, no ORDER BY n DESC, word) AS rn FROM (
        SELECT sentiment, no, word, count(*) AS n FROM (SELECT sentiment, no, unnest(found) AS word FROM hits) GROUP BY 1, 2, 3))
      WHERE rn <= 5 GROUP BY 1, 2),
    cats AS (SELECT sentiment, no, string_agg(category, ', ' ORDER BY n DESC, category) AS top_categories FROM (
      SELECT *, row_number() OVER (PARTITION BY sentiment, no ORDER BY n DESC, category) AS rn FROM (
        SELECT sentiment, no, category, count(*) AS n FROM hits WHERE category IS NOT NULL GROUP BY 1, 2, 3))
      WHERE rn <= 5 GROUP BY 1, 2)"""


def themes(kind: str) -> str:
    return with_roles(
        "n",
        f"""SELECT CAST(rank AS INTEGER) AS rank, theme, review_count, share_pct, avg_score, top_keywords, top_categories,
              hint AS action_hint
            FROM themes LEFT JOIN kw USING (sentiment, no) LEFT JOIN cats USING (sentiment, no)
            WHERE sentiment = '{kind}' AND rank <= 6""",
        _RULES, _HITS, _THEMES,
    )


SQL["review_themes_neg"] = themes("negative")
SQL["review_themes_pos"] = themes("positive")
SQL["score_distribution"] = with_roles(
    "rows",
    "SELECT s AS score, (SELECT count(*) FROM rows WHERE score = s) AS reviews FROM (VALUES (5), (4), (3), (2), (1)) v(s)",
)
SQL["review_summary"] = with_roles(
    "rows",
    f"""SELECT count(*) AS total_reviews, {rnd('CAST(sum(score) AS DOUBLE) / count(score)', 2)} AS avg_score,
        {rnd('count(*) FILTER (score >= 4) * 100.0::DOUBLE / count(*)', 1)} AS positive_pct,
        {rnd('count(*) FILTER (score <= 2) * 100.0::DOUBLE / count(*)', 1)} AS negative_pct FROM rows""",
)
_CATEGORY_SENTIMENT = f"""SELECT category, coalesce({rnd('CAST(sum(score) AS DOUBLE) / nullif(count(score), 0)', 2)}, 0) AS avg_score,
    count(*) AS review_count FROM rows GROUP BY 1 HAVING count(*) >= 5"""
SQL["category_sentiment"] = with_roles("rows", _CATEGORY_SENTIMENT)
SQL["worst_sentiment_categories"] = with_roles(
    "rows", f"SELECT * FROM ({_CATEGORY_SENTIMENT}) WHERE avg_score < 4.5 ORDER BY avg_score, category NULLS FIRST LIMIT 10"
)
SQL["primary_negative_theme"] = with_roles(
    "n",
    f"""SELECT w.category, avg_score, negative_reviews, coalesce(theme, '{NO_THEME}') AS primary_reason
        FROM ({negative('t', 1)}) w LEFT JOIN (
          SELECT category, theme FROM (SELECT category, theme, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, no) AS rn
            FROM hits WHERE sentiment = 'negative' GROUP BY category, theme, no) WHERE rn = 1) q
        ON w.category IS NOT DISTINCT FROM q.category""",
    _RULES, _HITS,
)
SQL["decision_signals"] = with_roles(
    "n",
    """SELECT CAST(rank AS INTEGER) AS rank, theme || ': ' || review_count || ' negative mentions; action: ' || hint AS signal
       FROM themes WHERE sentiment = 'negative' AND rank <= 3""",
    _RULES, _HITS, _THEMES,
)


def one_decimal(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,10)), 1) AS DECIMAL(30,1)) AS VARCHAR)"


def whole(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,10)), 0) AS BIGINT) AS VARCHAR)"


SQL["sentiment_summary"] = with_roles(
    "n",
    f"""SELECT scores || ' ' || theme AS sentiment_summary, theme AS topic_modeling_summary FROM
        (SELECT 'Average review score: ' || {one_decimal('CAST(sum(score) AS DOUBLE) / count(score)')} || '/5. '
           || {whole('count(*) FILTER (score >= 4) * 100.0::DOUBLE / count(*)')} || '% positive (4-5★), '
           || {whole('count(*) FILTER (score <= 2) * 100.0::DOUBLE / count(*)')} || '% negative (1-2★). Top negative keywords: '
           || coalesce((SELECT string_agg(word, ', ' ORDER BY rank) FROM ranked WHERE sentiment = 'negative' AND rank <= 5), '')
           || '.' AS scores FROM rows),
        (SELECT coalesce((SELECT 'Main negative theme: ' || theme || ' (' || review_count || ' matched negative reviews, '
           || {one_decimal('share_pct')} || '% of negative text sample).' FROM themes WHERE sentiment = 'negative' AND rank = 1),
           '{NO_THEME_SUMMARY}') AS theme)""",
    _KEYWORDS, _RULES, _HITS, _THEMES,
)
SQL["merge_keyword_lists"] = with_roles(
    "rows",
    """SELECT string_agg(word, ',' ORDER BY pos) AS keywords FROM (
         SELECT word, min(CASE sentiment WHEN 'positive' THEN rank ELSE 100 + rank END) AS pos
         FROM ranked WHERE rank <= 15 GROUP BY word ORDER BY pos LIMIT 15)""",
    _KEYWORDS,
)
SQL["review_sample"] = with_roles(
    "rows",
    """SELECT CAST(row_number() OVER (ORDER BY CASE WHEN strata >= 5 THEN kind END, review_id, category NULLS LAST) AS INTEGER) AS line,
         score AS review_score, category, substring(message, 1, 80) AS excerpt
       FROM sized WHERE strata < 5 OR (kind <> 'other' AND pos <= 5) QUALIFY line <= 12""",
    f"one AS (SELECT review_id, score, category, message, coalesce({_KIND}, 'other') AS kind FROM rows)",
    """placed AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY review_id, category NULLS LAST) AS pos
        FROM one QUALIFY pos <= 15)""",
    "sized AS (SELECT *, count(*) FILTER (kind <> 'other' AND pos <= 5) OVER () AS strata FROM placed)",
)

# --- ingest ------------------------------------------------------------------

_ISO = "'%Y-%m-%dT%H:%M:%S'"
SQL["split_orders"] = with_roles(
    "o i",
    f"""SELECT order_id, customer_id, order_status, strftime(bought, {_ISO}) AS order_purchase_timestamp,
          strftime(bought, {_ISO}) AS order_approved_at,
          strftime(bought + to_days(1), {_ISO}) AS order_delivered_carrier_date,
          strftime(done, {_ISO}) AS order_delivered_customer_date, strftime(due, {_ISO}) AS order_estimated_delivery_date
        FROM o WHERE order_id IN (SELECT order_id FROM i)""",
)
SQL["split_items"] = with_roles(
    "i",
    f"""SELECT order_id, order_item_id, product_id, seller_id, strftime(shipping_limit_date, {_ISO}) AS shipping_limit_date,
          price, freight AS freight_value
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
                ORDER BY product_id, seller_id, shipping_limit_date, price, freight) AS rn FROM i) WHERE rn = 1""",
)
SQL["split_products"] = with_roles(
    "p i",
    """SELECT product_id, original AS product_category_name, name_length AS product_name_length,
         CAST(NULL AS DOUBLE) AS product_description_length, photos AS product_photos_qty, weight AS product_weight_g,
         len AS product_length_cm, height AS product_height_cm, width AS product_width_cm
       FROM p WHERE product_id IN (SELECT product_id FROM i)""",
)
SQL["split_customers"] = with_roles(
    "c o i",
    """SELECT customer_id, unique_id AS customer_unique_id, zip AS customer_zip_code_prefix, city AS customer_city, customer_state
       FROM c WHERE customer_id IN (SELECT customer_id FROM o WHERE order_id IN (SELECT order_id FROM i))""",
)
SQL["split_sellers"] = with_roles(
    "s i",
    """SELECT seller_id, zip AS seller_zip_code_prefix, city AS seller_city, seller_state
       FROM s WHERE seller_id IN (SELECT seller_id FROM i)""",
)
SQL["split_payments"] = with_roles(
    "pay i",
    """SELECT order_id, seq AS payment_sequential, payment_type, installments AS payment_installments,
         CAST(value AS DOUBLE) AS payment_value FROM pay WHERE order_id IN (SELECT order_id FROM i)""",
)
SQL["dedupe_keep_first"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1"""
SQL["parse_ts_lenient"] = """
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
                THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS bought_at FROM orders"""
SQL["fill_text_nulls"] = with_roles(
    "t",
    """SELECT review_id, coalesce(CASE WHEN score >= 3 THEN title END, '') AS review_comment_title,
         length(coalesce(CASE WHEN score < 3 THEN message END, '')) AS message_length FROM t""",
)
_ZIPS = """zips AS (SELECT zip, city, state FROM (
    SELECT *, row_number() OVER (PARTITION BY zip ORDER BY src, id) AS rn FROM (
      SELECT 0 AS src, customer_id AS id, zip, city, customer_state AS state FROM c
      UNION ALL SELECT 1, seller_id, zip, city, seller_state FROM s)) WHERE rn = 1)"""
SQL["zip_directory_union"] = with_roles("c s", "SELECT * FROM zips", _ZIPS)
SQL["state_centroid_lookup"] = with_roles(
    "c s",
    """SELECT zip, city, state, CASE WHEN no < 20 THEN -20.0::DOUBLE + no ELSE -15.0 END AS lat,
         CASE WHEN no < 20 THEN -70.0::DOUBLE + 2 * no ELSE -47.0 END AS lng
       FROM (SELECT *, CAST(replace(state, 'NATION_', '') AS INTEGER) AS no FROM zips)""",
    _ZIPS,
)
SQL["category_translation"] = with_roles(
    "p",
    """SELECT DISTINCT lower(original) || '_goods' AS product_category_name,
         CASE original WHEN 'ECONOMY' THEN 'budget' WHEN 'PROMO' THEN 'promotion' ELSE lower(original) || ' goods' END
           AS product_category_name_english FROM p WHERE original IS NOT NULL""",
)
SQL["normalise_types"] = with_roles(
    "o",
    f"""SELECT order_id, strftime(bought, {_ISO}) AS bought, strftime(due, '%Y-%m-%d') AS due,
        order_id / 4.0::DOUBLE AS quarter FROM o""",
)

# --- questions ---------------------------------------------------------------

_QUESTIONS = """q AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN text || ' top ' || conv_id WHEN 1 THEN text || ' ' || turn || ' 周'
    WHEN 2 THEN text || ' ' || conv_id || '天' ELSE text END AS question FROM conversations)"""


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


_LOW = "lower(question)"
_TYPE = (
    "CASE " + " ".join(f"WHEN {any_of(_LOW, words)} THEN '{name}'" for name, words in star.RULES.types)
    + " ELSE 'descriptive' END"
)
SQL["question_type"] = f"""WITH {_QUESTIONS}, k AS (SELECT *, {_TYPE} AS analysis_type FROM q)
    SELECT conv_id, turn, analysis_type,
      {any_of(_LOW, star.RULES.reviews)} OR analysis_type IN ('diagnostic', 'prescriptive') AS needs_reviews,
      analysis_type = 'predictive' OR {any_of(_LOW, star.RULES.forecast)} AS needs_forecast,
      {any_of(_LOW, star.RULES.what_if)} AND {any_of(_LOW, star.RULES.what_if_targets)} AS needs_what_if,
      {any_of(_LOW, star.RULES.anomaly)} AS needs_anomaly FROM k"""
_PARAMS = f"""{_QUESTIONS}, raw AS (SELECT *, regexp_extract(question, '(\\d+)', 1) AS digits,
      nullif(regexp_extract(question, '(\\d+)\\s*周', 1), '') AS w, nullif(regexp_extract(question, '(\\d+)\\s*天', 1), '') AS d,
      nullif(regexp_extract(question, '(\\d+)\\s*个?月', 1), '') AS m FROM q),
    params AS (SELECT conv_id, turn,
      CASE WHEN digits = '' THEN 20 ELSE greatest(1, CAST(digits AS BIGINT)) END AS top_n,
      CAST(coalesce(CAST(w AS HUGEINT), CASE WHEN d IS NOT NULL THEN greatest(1, CAST(d AS HUGEINT) // 7) END, CAST(m AS HUGEINT) * 4, 6) AS BIGINT) AS horizon_weeks
      FROM raw)"""
SQL["question_params"] = f"WITH {_PARAMS} SELECT * FROM params"
SQL["question_params_bounded"] = f"WITH {_PARAMS} SELECT conv_id, turn, least(100, top_n) AS top_n FROM params"
SQL["forecast_granularity"] = f"""WITH {_PARAMS} SELECT conv_id, turn, horizon_weeks,
    CASE WHEN horizon_weeks <= 1 THEN 'daily' WHEN horizon_weeks <= 12 THEN 'weekly' WHEN horizon_weeks <= 48 THEN 'monthly'
         ELSE 'annual' END AS granularity,
    CAST(CASE WHEN horizon_weeks <= 1 THEN horizon_weeks * 7 WHEN horizon_weeks <= 12 THEN horizon_weeks
         WHEN horizon_weeks <= 48 THEN greatest(1, round_even(horizon_weeks / 4.33, 0))
         ELSE greatest(1, round_even(horizon_weeks / 52, 0)) END AS INTEGER) AS periods FROM params"""
_PART_COUNT = " + ".join(f"CAST({any_of(_LOW, words)} AS INTEGER)" for words in star.RULES.parts.values())
SQL["question_parts"] = f"""WITH {_QUESTIONS}, k AS (SELECT *, {_PART_COUNT} AS parts FROM q) """ + " UNION ALL ".join(
    [f"SELECT conv_id, turn, '{name}' AS part FROM k WHERE parts >= 2 AND {any_of(_LOW, words)}"
     for name, words in star.RULES.parts.items()]
    + ["SELECT conv_id, turn, 'whole' FROM k WHERE parts < 2"]
)
_NAMED = " UNION ALL ".join(
    f"SELECT conv_id, turn, analysis_type, '{name}' AS report FROM k WHERE {any_of(_LOW, words)}"
    for name, words in star.RULES.reports.items()
)
SQL["question_reports"] = f"""WITH {_QUESTIONS}, k AS (SELECT *, {_TYPE} AS analysis_type FROM q),
    named AS ({_NAMED}),
    base AS (SELECT conv_id, turn, analysis_type, report FROM named
      UNION ALL SELECT conv_id, turn, analysis_type, unnest([{quoted(DEFAULT_REPORTS)}]) FROM k
        WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM named)
      UNION ALL SELECT conv_id, turn, analysis_type, unnest(['wordcloud', 'delivery_bar']) FROM k
        WHERE analysis_type IN ('diagnostic', 'prescriptive')
      UNION ALL SELECT conv_id, turn, analysis_type, 'line' FROM k WHERE analysis_type = 'predictive')
    SELECT conv_id, turn, analysis_type, report FROM base
    UNION SELECT conv_id, turn, analysis_type, 'state_bar' FROM base WHERE report = 'geo_map'
    UNION SELECT conv_id, turn, analysis_type, 'category_bar' FROM base WHERE report = 'wordcloud'"""
_ASKED = "lower(trim(question))"
SQL["followup_context"] = f"""WITH asked AS (SELECT conv_id, turn, text AS question,
      lag(text) OVER (PARTITION BY conv_id ORDER BY turn, text) AS previous FROM conversations WHERE role = 'user'),
    k AS (SELECT *, previous IS NOT NULL AND ({any_of(_ASKED, star.RULES.follow_up)} OR
      (length({_ASKED}) <= {SHORT_LENGTH} AND {any_of(_ASKED, star.RULES.short_cues)})) AS follows FROM asked)
    SELECT conv_id, turn, question, follows AS is_follow_up,
      CASE WHEN follows THEN 'Previous question: ' || trim(previous) ELSE '' END AS memory_context FROM k"""
SQL["resolved_questions"] = f"""WITH f AS ({SQL['followup_context']}),
    a AS (SELECT conv_id, turn, text, trim(split_part(text, ' ', 1)) AS state FROM conversations WHERE role <> 'user'),
    n AS (SELECT conv_id, state, count(*) AS n FROM a WHERE state <> '' GROUP BY 1, 2),
    e AS (SELECT conv_id, string_agg(state, ', ' ORDER BY n DESC, state) AS states
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, state) AS rn FROM n) WHERE rn <= 2 GROUP BY 1),
    l AS (SELECT conv_id, trim(arg_max(text, (turn, text))) AS findings FROM a GROUP BY 1),
    m AS (SELECT f.*, states, memory_context || coalesce(chr(10) || 'Previous focus states: ' || states, '')
        || CASE WHEN findings <> '' THEN chr(10) || 'Previous findings: ' || findings ELSE '' END AS memory
      FROM f LEFT JOIN e USING (conv_id) LEFT JOIN l USING (conv_id))
    SELECT conv_id, turn, question, is_follow_up, CASE WHEN is_follow_up THEN memory ELSE '' END AS memory_context,
      CASE WHEN is_follow_up THEN question || chr(10) || chr(10) || '[Conversation memory for resolving references]' || chr(10) || memory
        || coalesce(chr(10) || 'Reference mapping: states=' || states, '') || chr(10)
        || 'If the user says these/those/above/same, interpret it using the previous focus entities and findings.'
      ELSE question END AS resolved_question FROM m"""
SQL["focus_entities"] = with_roles(
    "o i c p",
    """SELECT order_status, kind, string_agg(value, ', ' ORDER BY n DESC, value) AS "values" FROM (
         SELECT *, row_number() OVER (PARTITION BY order_status, kind ORDER BY n DESC, value) AS rn FROM (
           SELECT order_status, kind, value, count(*) AS n FROM e WHERE value IS NOT NULL AND value <> '' GROUP BY 1, 2, 3))
       WHERE rn <= 8 GROUP BY 1, 2""",
    """f AS (SELECT order_status, seller_id, customer_state, original FROM i JOIN o USING (order_id)
        JOIN c USING (customer_id) JOIN p USING (product_id))""",
    """e AS (SELECT order_status, 'states' AS kind, customer_state AS value FROM f
        UNION ALL SELECT order_status, 'categories', original FROM f
        UNION ALL SELECT order_status, 'sellers', CAST(seller_id AS VARCHAR) FROM f)""",
)

# --- logs: the expected outcome of each kind of damage -----------------------

SQL["parse_responses"] = """
    SELECT event_id, kind < 8 OR kind = 9 AS parsed,
      CASE WHEN kind IN (3, 9) THEN 'base_table' WHEN kind < 8 THEN 'view' END AS strategy,
      CASE WHEN kind < 8 OR kind = 9 THEN '' END AS reasoning,
      CASE WHEN kind < 8 THEN 'SELECT * FROM orders WHERE k = ' || event_id WHEN kind = 9 THEN '' END AS sql,
      CASE WHEN kind < 8 THEN event_type WHEN kind = 9 THEN '' END AS summary
    FROM (SELECT *, event_id % 11 AS kind FROM events)"""
SQL["screen_sql_log"] = """
    SELECT o_orderkey AS order_id,
      CASE o_orderkey % 12 WHEN 3 THEN 'with x as (select 1 from order_items) select * from x' WHEN 4 THEN 'drop table orders'
        WHEN 5 THEN 'EXPLAIN SELECT 1' WHEN 6 THEN 'SELECT * FROM payments JOIN order_reviews USING (order_id)' WHEN 7 THEN ''
        WHEN 8 THEN 'SELECT * FROM order_items WHERE customer_id = ' || o_custkey || '; DROP TABLE orders'
        WHEN 9 THEN 'WITH x AS (SELECT 1) DELETE FROM orders'
        WHEN 10 THEN 'SELECT * FROM order_items WHERE customer_id = ' || o_custkey || ' AND note = ''olist_a; drop table x'''
        ELSE 'SELECT * FROM order_items WHERE customer_id = ' || o_custkey END AS clean_sql,
      CASE WHEN o_orderkey % 12 IN (4, 8, 9) THEN 'blocked' WHEN o_orderkey % 12 = 5 THEN 'not_select'
           WHEN o_orderkey % 12 = 7 THEN 'empty' ELSE 'ok' END AS verdict
    FROM orders"""
_SQL_LOG = """log AS (SELECT o_orderkey AS order_id, CASE o_orderkey % 12
        WHEN 0 THEN 'SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey
        WHEN 1 THEN '```sql' || chr(10) || 'SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey || ';' || chr(10) || '```'
        WHEN 2 THEN '-- generated' || chr(10) || 'SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey || ' ;'
        WHEN 3 THEN 'with x as (select 1 from OLIST_order_item) select * from x;' WHEN 4 THEN 'drop table orders'
        WHEN 5 THEN 'EXPLAIN SELECT 1' WHEN 6 THEN 'SELECT * FROM order_payments JOIN order_review USING (order_id)'
        WHEN 8 THEN 'SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey || '; DROP TABLE orders'
        WHEN 9 THEN 'WITH x AS (SELECT 1) DELETE FROM orders'
        WHEN 10 THEN 'SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey || ' AND note = ''olist_a; drop table x'''
        WHEN 11 THEN '/* delete; */ SELECT * FROM olist_order_items_dataset WHERE customer_id = ' || o_custkey || ' -- drop' END AS sql
      FROM orders)"""
SQL["dedupe_results"] = f"WITH {_SQL_LOG} SELECT min(order_id) AS order_id, sql FROM log WHERE sql IS NOT NULL GROUP BY sql"
SQL["dedupe_results_by_prefix"] = f"WITH {_SQL_LOG} SELECT min(order_id) AS order_id FROM log WHERE sql IS NOT NULL GROUP BY left(sql, 60)"
SQL["parse_plans"] = """
    SELECT event_id, event_type AS question_summary, CASE WHEN event_type = 'view' THEN 'predictive' ELSE 'descriptive' END AS analysis_type,
      CASE WHEN event_id % 2 = 0 THEN 'data_analyst:t' || event_id
           ELSE event_type || ':t' || event_id || '; data_analyst:Analyze the user question' END AS tasks,
      '' AS final_synthesis, true AS parsed FROM events"""
SQL["parse_corrections"] = """
    SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN 'view' END AS strategy,
      CASE WHEN event_id % 5 <> 0 THEN 'SELECT * FROM orders' END AS sql, CASE WHEN event_id % 5 <> 0 THEN event_type END AS why,
      event_id % 5 <> 0 AS parsed FROM events"""
SQL["parse_report_choices"] = "SELECT event_id, 'line, scatter' AS charts, true AS parsed FROM events"
SQL["parse_sentiments"] = """SELECT event_id, event_type AS sentiment_summary, 'a' || event_id AS top_positive_keywords,
    '' AS top_negative_keywords, '' AS key_insights, true AS parsed FROM events"""
SQL["strategy_summary"] = """
    WITH log AS (SELECT user_id || '-' || strftime(ts, '%m%d%H') AS question_id, event_id,
        CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'view' WHEN 'purchase' THEN 'base_table' ELSE 'unknown' END AS s
      FROM events)
    SELECT question_id, count(*) AS results,
      CASE WHEN bool_or(s = 'base_table') THEN 'base_table'
           ELSE coalesce(arg_min(s, event_id) FILTER (s <> 'unknown'), 'unknown') END AS strategy
    FROM log GROUP BY 1"""


def _changepoints() -> str:
    """The hinge trend of forecast.fit_changepoints: same basis, sums, ridge and elimination."""
    # Stated here, not imported: five candidate bends over the first 80 % of the span, ridge 1.
    k, size, ridge, share = 5, 7, 1.0, 0.8

    def basis(t: str) -> list[str]:
        return ["1.0", f"{t} / 12.0"] + [f"greatest(({t} - floor(span * {share} * {c} / {k + 1})) / 12.0, 0.0)" for c in range(1, k + 1)]

    x = basis("t")
    a = "[" + ", ".join("[" + ", ".join(f"sum(({x[min(i, j)]}) * ({x[max(i, j)]}))" + (f" + {ridge}" if i == j and i >= 2 else "")
                                        for j in range(size)) + "]" for i in range(size)) + "]"
    b = "[" + ", ".join(f"sum(({x[i]}) * ys)" for i in range(size)) + "]"
    beta = [f"(beta[{i + 1}] * unit)" for i in range(size)]

    def value(t: str) -> str:
        out = "0.0"
        for p, c in zip(basis(t), beta):
            out = f"({out} + ({p}) * {c})"
        return out

    end = "0.0"
    for c in beta[1:]:
        end = f"({end} + {c})"
    steps = f"""ends AS (SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS points, avg(abs(y)) AS scale
          FROM h WHERE y IS NOT NULL AND ds IS NOT NULL GROUP BY series HAVING count(*) >= 4),
        pts AS (SELECT h.series, e.points, e.scale, CAST(datediff('month', e.first_ds, h.ds) AS DOUBLE) AS t,
          CAST(datediff('month', e.first_ds, e.last_ds) AS DOUBLE) AS span,
          h.y / CASE WHEN e.scale > 0 THEN e.scale ELSE 1.0 END AS ys
          FROM h JOIN ends e USING (series) WHERE h.y IS NOT NULL AND h.ds IS NOT NULL),
        sys AS (SELECT series, points, scale, span, {a} AS a, {b} AS b FROM pts GROUP BY series, points, scale, span),
        ge AS (SELECT series, 0 AS k, a, b FROM sys
          UNION ALL
          SELECT series, k + 1,
            list_transform(range({size}), lambda i: CASE WHEN i = k THEN list_transform(a[k + 1], lambda v: v / a[k + 1][k + 1])
              ELSE list_transform(range({size}), lambda j: a[i + 1][j + 1] - a[i + 1][k + 1] / a[k + 1][k + 1] * a[k + 1][j + 1]) END),
            list_transform(range({size}), lambda i: CASE WHEN i = k THEN b[k + 1] / a[k + 1][k + 1]
              ELSE b[i + 1] - a[i + 1][k + 1] / a[k + 1][k + 1] * b[k + 1] END)
          FROM ge WHERE k < {size}),
        fit AS (SELECT s.series, s.points, s.span, ge.b AS beta, CASE WHEN s.scale > 0 THEN s.scale ELSE 1.0 END AS unit
          FROM sys s JOIN ge ON s.series = ge.series AND ge.k = {size})"""
    body = f"""SELECT series, points, {rnd(f'{beta[1]} / 12', 2)} AS slope_start, {rnd(f'{end} / 12', 2)} AS slope_end,
        {rnd(value('span'), 2)} AS yhat_last, {rnd(value('(span + 1)'), 2)} AS yhat_next FROM fit"""
    return on_many([M, ST, CAT], body, _HISTORY, steps).replace("WITH ", "WITH RECURSIVE ", 1)


SQL["forecast_changepoints"] = _changepoints()

# Theta sketches are exact below 4096 distinct customers a group, as in these tables,
# so the estimate column equals the exact count here.
_BUYERS = "buyers AS (SELECT DISTINCT ym, customer_state, unique_id FROM d JOIN i USING (order_id) JOIN c USING (customer_id))"
SQL["unique_customers_sketched"] = with_roles(
    "d i c",
    """SELECT customer_state, CAST(count(DISTINCT unique_id) AS BIGINT) AS unique_customers,
              CAST(count(DISTINCT unique_id) AS BIGINT) AS exact_customers, true AS within_bound
       FROM buyers GROUP BY customer_state""",
    _BUYERS,
)
SQL["returning_customers"] = with_roles(
    "d i c",
    """SELECT m.ym, m.next_ym, CAST(count(b.unique_id) AS BIGINT) AS returning,
              CAST(count(b.unique_id) AS BIGINT) AS exact_returning, true AS within_bound
       FROM months m JOIN seen a ON a.ym = m.ym LEFT JOIN seen b ON b.ym = m.next_ym AND b.unique_id = a.unique_id
       WHERE m.next_ym IS NOT NULL GROUP BY m.ym, m.next_ym""",
    _BUYERS,
    "seen AS (SELECT DISTINCT ym, unique_id FROM buyers)",
    "months AS (SELECT ym, lead(ym) OVER (ORDER BY ym) AS next_ym FROM (SELECT DISTINCT ym FROM seen))",
)
SQL["price_quantiles"] = f"""SELECT {rnd('quantile_cont(l_extendedprice, 0.5)', 2)} AS p50,
    {rnd('quantile_cont(l_extendedprice, 0.95)', 2)} AS p95, {rnd('quantile_cont(l_extendedprice, 0.99)', 2)} AS p99
    FROM lineitem"""
SQL["items_with_seller_state"] = with_roles(
    "i s", "SELECT order_id, order_item_id, seller_id, seller_state, price FROM i JOIN s USING (seller_id)")
