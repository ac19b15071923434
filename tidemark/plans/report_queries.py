"""Queries for the report compositions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.plans.registry import Tables, query


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> F.Column:
    return F.col(c).cast("date").alias(name or c)


@query("""
SELECT p_partkey FROM part WHERE p_retailprice BETWEEN 500 AND 1500 AND p_brand IN (SELECT p_brand FROM part WHERE p_size = 1)
""")
def c11_hygiene_band(t: Tables) -> DataFrame:
    return reports.hygiene_band(t.part, "p_retailprice", 500, 1500, t.part.where("p_size = 1"), "p_brand").select("p_partkey")


@query("""
SELECT p_partkey FROM part WHERE p_type LIKE 'A%' OR p_type LIKE '%S%'
""")
def c13_by_pattern(t: Tables) -> DataFrame:
    return reports.by_pattern(t.part, "p_type", ["A%", "%S%"]).select("p_partkey")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE regexp_matches(p_brand, '1$'))
""")
def c20_series_by_code(t: Tables) -> DataFrame:
    dim = t.part.withColumnRenamed("p_partkey", "l_partkey")
    return reports.series_by_code(t.lineitem, dim, "l_partkey", "p_brand", "1$").select("l_orderkey", "l_linenumber")


@query("""
SELECT c_custkey, count(o_orderkey) AS n_obs, coalesce(max(o_orderdate::DATE)::VARCHAR, '') AS last_date, coalesce(arg_max(o_orderkey, (o_orderdate::DATE, o_orderkey)), -1) AS last_value FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def d16_with_latest(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), _day("o_orderdate", "d"), "o_orderkey")
    out = reports.with_latest(t.customer.select("c_custkey"), o, "c_custkey", "d", "o_orderkey")
    return out.select("c_custkey", "n_obs", F.coalesce(F.col("last_date").cast("string"), F.lit("")).alias("last_date"), F.coalesce("last_value", F.lit(-1)).alias("last_value"))


@query("""
WITH m AS (SELECT event_type, ts::DATE AS d, arg_max(value, (ts, value)) AS v FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2)
SELECT a.d AS mark_date, round(a.v, 6) AS click, round(b.v, 6) AS view FROM m a JOIN m b ON a.d = b.d AND a.event_type = 'click' AND b.event_type = 'view' WHERE a.v IS NOT NULL AND b.v IS NOT NULL
""", dates=("mark_date",))
def d25_daily_closes(t: Tables) -> DataFrame:
    return reports.daily_closes(t.events, ["click", "view"], "event_type", "ts", "value").select("mark_date", _r("click"), _r("view"))


@query("""
SELECT o_orderdate::DATE AS day, count(DISTINCT o_custkey) AS n_keys, count(*) AS n_rows FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-06-30' - INTERVAL 90 DAY AND DATE '1995-06-30' GROUP BY 1
""", dates=("day",))
def e14_daily_counts(t: Tables) -> DataFrame:
    return reports.daily_counts(t.orders, "o_custkey", "o_orderdate", F.lit("1995-06-30").cast("date"), 90)


@query("""
SELECT event_type, ts::DATE AS d, hour(ts) // 3 AS load_pass, count(*) AS n_rows FROM events GROUP BY 1, 2, 3
""", dates=("d",))
def e15_arrival_histogram(t: Tables) -> DataFrame:
    e = t.events.withColumn("d", _day("ts"))
    return reports.arrival_histogram(e, ["event_type"], "d", F.floor(F.hour("ts") / 3))


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate::DATE DESC, l_linenumber DESC, l_quantity DESC, l_suppkey) AS i FROM lineitem)
SELECT l_suppkey, round(sum(l_quantity), 2) AS flow FROM n WHERE i = 1 GROUP BY 1
""")
def e20_flow(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("d", _day("l_shipdate"))
    flow, _ = reports.flow_and_stock(li, "l_partkey", "l_linenumber", "l_suppkey", "d", "l_quantity")
    return flow.select("l_suppkey", _r("flow", 2))


@query("""
SELECT year(l_shipdate) AS year, 'big' AS check_name, count(*) FILTER (l_quantity > 45) AS n_failed FROM lineitem GROUP BY 1 UNION ALL SELECT year(l_shipdate), 'taxed', count(*) FILTER (l_tax > 0.05) FROM lineitem GROUP BY 1
""")
def e37_checks_by_year(t: Tables) -> DataFrame:
    out = reports.checks_by_year(t.lineitem, "l_shipdate", {"big": F.col("l_quantity") > 45, "taxed": F.col("l_tax") > 0.05})
    return out.withColumn("year", F.col("year").cast("long"))


@query("""
SELECT o_custkey, max(o_orderdate::DATE) AS latest FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) GROUP BY 1 HAVING max(o_orderdate::DATE) < DATE '2000-01-03'
""", dates=("latest",))
def e38_behind_target(t: Tables) -> DataFrame:
    excused = t.customer.where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return reports.behind_target(t.orders, ["o_custkey"], "o_orderdate", F.lit("2000-01-03").cast("date"), excused)


@query("""
WITH p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events), c AS (SELECT event_id, user_id, ts, (value - b) / abs(b) * 100 AS pct FROM p WHERE abs(b) > 1e-12)
SELECT event_id, round(pct, 3) AS pct_change FROM c WHERE abs(pct) > 10 ORDER BY abs(pct) DESC, user_id, ts LIMIT 50
""")
def k6_pct_change_check(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    return reports.pct_change_check(e, ["user_id"], "at", "value", 10.0).select("event_id", _r("pct_change", 3))


@query("""
WITH d AS (SELECT DISTINCT user_id, ts FROM events), g AS (SELECT user_id, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts) - ts) / 3.6e9 AS h FROM d), x AS (SELECT user_id, count(*) AS n, max(h) AS m FROM g WHERE h > 12 GROUP BY 1)
SELECT e.user_id, count(*) AS n_rows, count(DISTINCT ts::DATE) AS n_dates, coalesce(any_value(n), 0) AS n_gaps, round(any_value(m), 4) AS longest_gap FROM events e LEFT JOIN x ON e.user_id = x.user_id GROUP BY 1
""")
def k8_coverage_and_gaps(t: Tables) -> DataFrame:
    return reports.coverage_and_gaps(t.events, ["user_id"], "ts", 12.0).select("user_id", "n_rows", "n_dates", "n_gaps", _r("longest_gap", 4))


@query("""
WITH c AS (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS c FROM events)
SELECT user_id, count(c) AS sessions, round(avg((c <= 10)::INT) * 100, 6) AS pct_frozen, round(avg(c), 6) AS mean_abs_change,
    CASE WHEN count(c) <= 20 THEN 'TOO SHORT' WHEN avg((c <= 10)::INT) * 100 >= 60 THEN 'SYNTHETIC' WHEN avg((c <= 10)::INT) * 100 >= 35 THEN 'SUSPECT' ELSE 'LIVE' END AS verdict FROM c WHERE c IS NOT NULL GROUP BY 1
""")
def k13_synthetic_verdict(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    out = reports.synthetic_curve_verdict(e, ["user_id"], "at", "value", frozen_bp=10.0, frozen_pct=60.0, suspect_pct=35.0)
    return out.select("user_id", "sessions", _r("pct_frozen"), _r("mean_abs_change"), "verdict")


@query("""
WITH p AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS m FROM events)
SELECT user_id, CASE WHEN m IS NULL THEN 'NEW' WHEN abs(m) >= 0.10 THEN 'BIG' WHEN abs(m) >= 0.05 THEN 'MID' WHEN abs(m) >= 0.01 THEN 'SMALL' ELSE 'FLAT' END AS move_class, count(*) AS n FROM p GROUP BY 1, 2
""")
def l5_move_counts(t: Tables) -> DataFrame:
    return reports.move_counts(t.events.withColumn("at", F.struct("ts", "event_id")), "user_id", "at", "value")


@query("""
SELECT o_orderkey, coalesce(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority), 4) AS place FROM orders
""")
def g3_rank_order(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", reports.tenor_order(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH", "3-MEDIUM"]).cast("int").alias("place"))


@query("""
SELECT user_id, count(*) AS n_rows, round(max(s), 6) AS largest_step FROM (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS s FROM events) GROUP BY 1
""")
def e36_load_report(t: Tables) -> DataFrame:
    return reports.ranked_lag(t.events.withColumn("at", F.struct("ts", "event_id")), ["user_id"], "at", "value").select("user_id", "n_rows", _r("largest_step"))
