"""Queries for filters, joins, aggregations, windows, orderings and reshaping of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import calendars, checks, documents, joins, reports, series
from tidemark.plans.registry import Tables, query, stamp
from tidemark.sources import scans


def _r(c: str, n: int = 6) -> Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> Column:
    return F.col(c).cast("date").alias(name or c)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax - 0.02 > least(l_discount, 0.05) OR l_tax + 0.04 < greatest(l_discount, 0.05) OR l_tax - 0.02 > l_tax + 0.04
""")
def c4_bar_order(t: Tables) -> DataFrame:
    bars = t.lineitem.withColumns({"open_px": F.col("l_discount"), "high_px": F.col("l_tax") + 0.04, "low_px": F.col("l_tax") - 0.02, "close_px": F.lit(0.05)})
    return checks.ohlc_violations(bars).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > l_tax")
def c5_inverted_quotes(t: Tables) -> DataFrame:
    return checks.bid_ask_inversions(t.lineitem, "l_discount", "l_tax").select("l_orderkey", "l_linenumber")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-03-31' - INTERVAL 6 MONTH AND DATE '1998-03-31' + INTERVAL 2 MONTH
""")
def c6_month_window(t: Tables) -> DataFrame:
    return checks.date_window(t.orders.withColumn("d", _day("o_orderdate")), "d", _date("1998-03-31"), 6, 2).select("o_orderkey")


@query("""
SELECT event_id FROM events WHERE event_type <> 'error' AND NOT (ts < TIMESTAMP '2024-01-15 00:00:00' AND (value / 100 <= 0.005 OR value / 100 >= 0.995))
""")
def c9_open_markets(t: Tables) -> DataFrame:
    e = t.events.withColumns({"closed": F.col("event_type") == "error", "price": F.col("value") / 100})
    return checks.unresolved(e, "closed", "ts", "price", F.lit("2024-01-15 00:00:00").cast("timestamp")).select("event_id")


@query("""
SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'ring|bolt') AND NOT regexp_matches(p_name, '^hot') AND p_retailprice >= 905
""")
def c10_curated(t: Tables) -> DataFrame:
    return checks.curated(t.part, "p_name", "ring|bolt", "^hot", "p_retailprice", 905).select("p_partkey")


@query("""
SELECT s_name AS curve, s_name IN ('Supplier#000000001', 'Supplier#000000007') AS publishes_late FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1 AND s_acctbal >= 0
""")
def c12_cohort(t: Tables) -> DataFrame:
    curves = t.supplier.select(F.col("s_name").alias("curve"), F.col("s_nationkey").alias("country_id"), F.when(F.col("s_acctbal") < 0, _date("2020-01-01")).alias("cessation_date"))
    countries = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").cast("string").alias("region"))
    return reports.cohort(curves, countries, "1", ["Supplier#000000001", "Supplier#000000007"]).select("curve", "publishes_late")


@query("SELECT event_id, hour(ts) >= 22 OR hour(ts) < 4 AS fires FROM events")
def c16_fire_window(t: Tables) -> DataFrame:
    return t.events.select("event_id", parse.in_window(F.hour("ts"), 22, 4).alias("fires"))


@query("""
SELECT o_orderkey FROM orders WHERE NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND date_trunc('month', o_orderdate) IN (SELECT date_trunc('month', o_orderdate) FROM orders GROUP BY 1 HAVING sum((o_orderstatus = 'F')::INT) > sum((o_orderstatus = 'O')::INT)))
""")
def c17_no_projections(t: Tables) -> DataFrame:
    o = t.orders.withColumn("period", F.trunc("o_orderdate", "MM"))
    starred = o.groupBy("period").agg(F.sum(F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", -1).otherwise(0)).alias("n")).where("n > 0")
    return reports.drop_forecasts(o, starred, "period", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("""
SELECT o_orderkey, CASE WHEN (o_orderpriority = '5-LOW' OR o_orderstatus = 'P') AND o_totalprice <= 200000 THEN 'removed' ELSE 'kept' END AS fate FROM orders
""")
def c18_placeholders(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", (F.col("o_orderpriority") == "5-LOW").alias("is_estimated"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("source"), F.when(F.col("o_totalprice") > 200_000, F.col("o_totalprice")).alias("survey"))
    kept, removed = checks.drop_placeholders(o, "is_estimated", "source", ["survey"])
    return kept.select("o_orderkey", F.lit("kept").alias("fate")).unionByName(removed.select("o_orderkey", F.lit("removed").alias("fate")))


@query("SELECT p_partkey FROM part WHERE p_type <> 'PROMO' AND p_size >= 30")
def c19_important_changes(t: Tables) -> DataFrame:
    return reports.important_changes(t.part.withColumn("relevance", F.when(F.col("p_type") != "PROMO", F.col("p_size"))), "relevance", 30).select("p_partkey")


@query("""
SELECT user_id, CASE WHEN date_diff('day', max(ts)::DATE, DATE '2024-02-20') <= 25 THEN 'live' WHEN date_diff('day', max(ts)::DATE, DATE '2024-02-20') <= 35 THEN 'stale' ELSE 'dead' END AS label FROM events GROUP BY 1
""")
def c21_age_labels(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("ts").alias("last")).select("user_id", parse.age_label(F.col("last"), _date("2024-02-20"), 25, 35).alias("label"))


@query("""
WITH s AS (SELECT o_orderpriority, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std FROM orders GROUP BY 1)
SELECT o_orderkey, round((o_totalprice - mean) / std, 6) AS z FROM orders JOIN s USING (o_orderpriority) WHERE abs((o_totalprice - mean) / std) > 1.5
""")
def d4_stats_joined_back(t: Tables) -> DataFrame:
    return checks.sigma_outliers(t.orders, ["o_orderpriority"], "o_totalprice", 1.5).select("o_orderkey", _r("z"))


_BARS = "SELECT event_type, date_trunc('day', ts) AS ts, count(*)::DOUBLE AS n, sum(value) AS total FROM events GROUP BY 1, 2"


def _daily(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.date_trunc("day", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(f"""
WITH b AS ({_BARS}), l AS (UNPIVOT b ON n, total INTO NAME column_name VALUE v)
SELECT y.event_type, y.column_name, round((y.v / nullif(x.v, 0) - 1) * 100, 6) AS pct FROM l x JOIN l y ON x.event_type = y.event_type AND x.column_name = y.column_name AND x.ts = TIMESTAMP '2024-01-09' AND y.ts = TIMESTAMP '2024-01-10' WHERE abs((y.v / nullif(x.v, 0) - 1) * 100) >= 5
""")
def d6_two_slices(t: Tables) -> DataFrame:
    at = [F.lit(d).cast("timestamp") for d in ("2024-01-09", "2024-01-10")]
    return reports.period_anomalies(_daily(t), ["event_type"], "ts", ["n", "total"], at[0], at[1], 5).select("event_type", "column_name", _r("pct"))


@query("""
SELECT l_orderkey, l_linenumber, round(l_extendedprice - spot, 4) AS points FROM lineitem JOIN (SELECT o_orderdate AS d, avg(o_totalprice) AS spot FROM orders GROUP BY 1) ON d = l_shipdate
""")
def d11_forwards_with_spot(t: Tables) -> DataFrame:
    spot = t.orders.groupBy(F.col("o_orderdate").alias("d")).agg(F.avg("o_totalprice").alias("spot"))
    out = reports.forwards_with_spot(t.lineitem.withColumnRenamed("l_shipdate", "d"), spot, "d")
    return out.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") - F.col("spot"), 4).alias("points"))


_NAMED = "SELECT DISTINCT l_suppkey AS k, l_shipdate::DATE AS d, list_sort(string_split(p_name, ' ') || [lower(p_type)]) AS w FROM lineitem JOIN part ON p_partkey = l_partkey"


@query(f"""
WITH l AS ({_NAMED} WHERE l_returnflag = 'R'), r AS ({_NAMED} WHERE l_returnflag = 'A'),
m AS (SELECT l.k, l.d AS left_date, l.w AS lw, r.d AS right_date, r.w AS rw, len(list_intersect(l.w, r.w)) AS shared FROM l JOIN r ON l.k = r.k AND abs(l.d - r.d) <= 3),
b AS (SELECT *, row_number() OVER (PARTITION BY k, left_date, lw ORDER BY abs(left_date - right_date), shared DESC, right_date, rw) AS i FROM m WHERE shared >= 2)
SELECT k, left_date, array_to_string(lw, ' ') AS left_words, right_date, array_to_string(rw, ' ') AS right_words, shared FROM b WHERE i = 1
""", dates=("left_date", "right_date"))
def d13_word_match(t: Tables) -> DataFrame:
    words = F.sort_array(F.array_append(F.split("p_name", " "), F.lower("p_type")))
    named = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_returnflag", F.col("l_suppkey").alias("k"), _day("l_shipdate", "d"), words.alias("w"))
    out = joins.match_by_words(named.where("l_returnflag = 'R'"), named.where("l_returnflag = 'A'"), ["k"], "d", "w")
    return out.select("k", "left_date", F.array_join("left_words", " ").alias("left_words"), "right_date", F.array_join("right_words", " ").alias("right_words"), "shared")


_LANES = "SELECT DISTINCT c_nationkey AS base, s_nationkey AS quote FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"


@query(f"""
WITH p AS ({_LANES}) SELECT n_nationkey AS ccy, base, quote FROM nation JOIN p ON base = n_nationkey UNION SELECT n_nationkey, base, quote FROM nation JOIN p ON quote = n_nationkey
""")
def d17_either_leg(t: Tables) -> DataFrame:
    sold = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    pairs = sold.select(F.col("c_nationkey").alias("base"), F.col("s_nationkey").alias("quote")).distinct()
    return joins.pairs_of(t.nation.select(F.col("n_nationkey").alias("ccy")), pairs, "ccy", "base", "quote").select("ccy", "base", "quote")


@query("SELECT p_partkey, p_brand, CASE WHEN p_size > 3 THEN p_type END AS p_type FROM part WHERE p_size > 3 UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_size <= 3")
def d19_joined_keys(t: Tables) -> DataFrame:
    keyed = t.part.select("p_partkey", F.when(F.col("p_size") > 3, F.concat("p_brand", "p_type")).otherwise("unknown").alias("key"))
    return joins.resolve_joined_key(keyed, "key", [t.part.select("p_brand").distinct(), t.part.select("p_type").distinct()], ["p_brand", "p_type"]).select("p_partkey", "p_brand", "p_type")


@query("""
WITH a AS (SELECT nullif(o_orderpriority, '5-LOW') AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT nullif(o_orderpriority, '5-LOW') AS k, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT coalesce(a.k, 'none') AS k, n, total FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def d22_null_safe_join(t: Tables) -> DataFrame:
    o = t.orders.withColumn("k", F.nullif("o_orderpriority", F.lit("5-LOW")))
    out = joins.null_safe_join(o.groupBy("k").agg(F.count(F.lit(1)).alias("n")), o.groupBy("k").agg(F.sum("o_totalprice").alias("total")), ["k"])
    return out.select(F.coalesce("k", F.lit("none")).alias("k"), "n", _r("total", 2))


@query("""
WITH s AS (SELECT n_nationkey AS k, n_nationkey % 3 <> 0 AS is_trading_day, CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey <> 1 END AS is_open FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900))
SELECT n_nationkey AS k, CASE WHEN is_trading_day IS NULL THEN 'unknown' WHEN NOT is_trading_day THEN 'holiday' WHEN NOT coalesce(is_open, true) THEN 'market closed' ELSE 'unexplained' END AS explanation
FROM nation LEFT JOIN s ON k = n_nationkey WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
""")
def d27_missing_explained(t: Tables) -> DataFrame:
    key = F.col("n_nationkey").alias("k")
    known = t.customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    status = t.nation.join(known, "n_nationkey", "left_semi").select(key, (F.col("n_nationkey") % 3 != 0).alias("is_trading_day"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_regionkey") != 1).alias("is_open"))
    missing = joins.missing_from_grid(t.nation.select(key), t.supplier.where("s_acctbal > 9000").select(F.col("s_nationkey").alias("k")), ["k"])
    return reports.explain_missing(missing, status, "k").select("k", "explanation")


@query("""
WITH h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS hour)
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour FROM h WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE value > 100)
""")
def d28_hours_to_rebuild(t: Tables) -> DataFrame:
    ends = [F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-01-31")]
    return joins.rebuild_hours(t.events.where("value > 100"), "ts", ends[0], ends[1]).select(stamp("hour"))


_Q = ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{round(p * 100)}" for p in (0.01, 0.25, 0.5, 0.75, 0.99))


@query(f"""
WITH w AS (SELECT * FROM lineitem WHERE l_shipdate::DATE >= (SELECT max(l_shipdate::DATE) FROM lineitem) - INTERVAL 24 MONTH)
SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value, {_Q} FROM w GROUP BY 1
""")
def e3_trailing_distribution(t: Tables) -> DataFrame:
    last = t.lineitem.agg(F.max(_day("l_shipdate")).alias("last"))  # one row
    recent = t.lineitem.crossJoin(F.broadcast(last)).where(_day("l_shipdate") >= F.add_months("last", -24))
    out = checks.distribution(recent, ["l_returnflag"], "l_extendedprice")
    return out.select("l_returnflag", "n", _r("mean", 4), _r("std", 4), "min_value", "max_value", *[_r(f"p{p}", 4) for p in (1, 25, 50, 75, 99)])


_STALE = """
s AS (SELECT c_custkey, c_mktsegment AS seg, c_nationkey AS nat, date_diff('day', max(o_orderdate::DATE), DATE '2001-08-01') AS behind FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
r AS (SELECT 'seg' AS dim, seg AS code, count(*) AS n_keys, sum((behind > 90)::INT) AS n_stale, max(behind) AS worst FROM s GROUP BY 2 UNION ALL SELECT 'nat', nat::VARCHAR, count(*), sum((behind > 90)::INT), max(behind) FROM s GROUP BY 2),
u AS (SELECT s_suppkey, s_nationkey AS nat, date_diff('day', max(l_shipdate::DATE), DATE '2001-11-04') AS behind FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
v AS (SELECT 'nat' AS dim, nat::VARCHAR AS code, count(*) AS n_keys, sum((behind > 30)::INT) AS n_stale, max(behind) AS worst FROM u GROUP BY 2)
"""


def _stale_rollups(t: Tables) -> tuple[DataFrame, DataFrame]:
    behind = lambda day: lambda d: F.datediff(_date(day), d)
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"), "o_orderdate")
    s = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey", F.col("s_nationkey").alias("nat"), "l_shipdate")
    one = checks.stale_rollup(checks.staleness(o, "c_custkey", ["seg", "nat"], "o_orderdate", behind("2001-08-01")), ["seg", "nat"], 90)
    return one, checks.stale_rollup(checks.staleness(s, "s_suppkey", ["nat"], "l_shipdate", behind("2001-11-04")), ["nat"], 30)


@query(f"WITH {_STALE} SELECT dim, code, sum(n_keys)::BIGINT AS n_keys, sum(n_stale)::BIGINT AS n_stale, max(worst) AS worst FROM (SELECT * FROM r UNION ALL SELECT * FROM v) GROUP BY 1, 2")
def e12_breakdown_totals(t: Tables) -> DataFrame:
    return reports.breakdown_totals(list(_stale_rollups(t))).select("dim", "code", "n_keys", "n_stale", "worst")


@query("""
WITH s AS (SELECT l_shipdate::DATE AS d, l_returnflag AS asset, l_quantity, l_extendedprice FROM lineitem WHERE l_linenumber = 1), r AS (SELECT o_orderdate::DATE AS d, arg_min(o_totalprice, o_orderkey) / 100000 AS rate FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
m AS (SELECT d, asset, 'quantity' AS measure, sum(l_quantity) AS v FROM s GROUP BY 1, 2 UNION ALL SELECT d, asset, 'amount', sum(l_extendedprice) FROM s GROUP BY 1, 2)
SELECT d, asset, measure, round(v, 2) AS value, round(v / rate, 4) AS converted FROM m LEFT JOIN r USING (d)
""", dates=("d",))
def e22_subtotals(t: Tables) -> DataFrame:
    rows = t.lineitem.select(_day("l_shipdate", "d"), F.col("l_returnflag").alias("asset"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("amount"), "l_linenumber")
    rates = t.orders.select(_day("o_orderdate", "d"), "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100_000).alias("rate"))
    out = reports.converted_subtotals(rows, F.col("l_linenumber") == 1, ["d", "asset"], "d", ["quantity", "amount"], rates, "rate", "o_orderkey")
    return out.select("d", "asset", "measure", _r("value", 2), _r("converted", 4))


_SNAPSHOT = """
i AS (SELECT c_custkey AS key, c_mktsegment AS category, CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'D' END AS frequency FROM customer),
f AS (SELECT o_custkey AS key, o_orderdate::DATE AS d, arg_max(nullif(o_totalprice, NULL), o_orderkey) AS v FROM orders GROUP BY 1, 2),
l AS (SELECT key, count(*) AS n_obs, max(d) AS last_obs, arg_max(v, d) AS last_value FROM f GROUP BY 1), n AS (SELECT o_custkey AS key, count(*) FILTER (o_orderdate >= TIMESTAMP '2001-01-01') AS n_new FROM orders GROUP BY 1),
x AS (SELECT key, category, coalesce(n_obs, 0) AS n_obs, last_obs, last_value, coalesce(n_new, 0) AS n_new, coalesce(date_diff('day', last_obs, DATE '2001-08-02') > CASE frequency WHEN 'M' THEN 200 ELSE 60 END, true) AS is_stale FROM i LEFT JOIN l USING (key) LEFT JOIN n USING (key))
"""


def _indicator_snapshot(t: Tables) -> DataFrame:
    indicators = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("category"), F.when(F.col("c_nationkey") < 12, "M").otherwise("D").alias("frequency"))
    facts = t.orders.select(F.col("o_custkey").alias("key"), _day("o_orderdate", "obs_date"), F.col("o_orderkey").alias("vintage"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("ingested_at"))
    return reports.indicator_snapshot(indicators, facts, "key", F.lit("2001-01-01").cast("timestamp"), _date("2001-08-02"), {"M": 200, "D": 60})


@query(f"WITH {_SNAPSHOT} SELECT key, n_obs, last_obs, round(last_value, 2) AS last_value, n_new, is_stale FROM x", dates=("last_obs",))
def e27_indicator_snapshot(t: Tables) -> DataFrame:
    return _indicator_snapshot(t).select("key", "n_obs", "last_obs", _r("last_value", 2), "n_new", "is_stale")


@query(f"WITH {_SNAPSHOT} SELECT category, count(*) AS n_indicators, sum(n_new)::BIGINT AS n_new, count(*) FILTER (n_new > 0) AS n_with_new, count(*) FILTER (is_stale) AS n_stale FROM x GROUP BY 1")
def e40_category_rollup(t: Tables) -> DataFrame:
    return reports.category_rollup(_indicator_snapshot(t))


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_reports, count(*) AS n_chunks FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1")
def e28_ingest_snapshot(t: Tables) -> DataFrame:
    return reports.ingest_snapshot(t.orders, "o_orderpriority", "o_custkey", "o_orderdate", F.lit("1999-01-01").cast("timestamp"))


@query("""
WITH s AS (SELECT p_name AS code, max(l_shipdate::DATE) AS newest FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), f(name, pattern, tolerance) AS (VALUES ('rings', '%ring', 3), ('hot', 'hot%', 40), ('gears', '%gear%', 0))
SELECT name, tolerance, count(DISTINCT code) AS n_series, max(newest) AS newest, date_diff('day', max(newest), DATE '2001-11-10') > tolerance AS is_late FROM s JOIN f ON code LIKE pattern GROUP BY 1, 2
""", dates=("newest",))
def e29_family_freshness(t: Tables) -> DataFrame:
    families = t.spark.createDataFrame([("rings", "%ring", 3), ("hot", "hot%", 40), ("gears", "%gear%", 0)], "name string, pattern string, tolerance int")
    facts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_name").alias("code"), _day("l_shipdate", "d"))
    return checks.family_freshness(facts, families, "code", "d", _date("2001-11-10"))


@query("""
SELECT count(*) AS actual, (SELECT count(*) FROM customer) - count(*) AS missing, strftime(min(o_orderdate), '%Y-%m-%d') AS first_created FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate::DATE) FROM orders)
""")
def e33_append_verified(t: Tables) -> DataFrame:
    day, expected = t.orders.agg(F.max(_day("o_orderdate"))).first()[0], t.customer.count()  # a date and a count
    return checks.verify_append(t.orders, "o_orderdate", F.lit(day), expected).select("actual", "missing", F.date_format("first_created", "yyyy-MM-dd").alias("first_created"))


@query("""
SELECT 'orders' AS pipeline, (SELECT count(*) FROM lineitem) AS rows_extracted, (SELECT count(*) FROM lineitem WHERE l_discount <= l_tax) AS rows_loaded, (SELECT count(*) FROM lineitem WHERE l_tax > 0.07 AND l_discount <= l_tax) AS n_failed, 'WARN' AS status
""")
def e39_run_summary(t: Tables) -> DataFrame:
    loaded = t.lineitem.where("l_discount <= l_tax")
    return reports.run_summary("orders", t.lineitem, loaded, {"high_tax": F.col("l_tax") > 0.07}).select("pipeline", "rows_extracted", "rows_loaded", "n_failed", "status")


@query(f"""
WITH b AS ({_BARS}), c AS (SELECT event_type, abs(total - lag(total) OVER (PARTITION BY event_type ORDER BY ts)) AS c FROM b)
SELECT event_type, count(*) AS sessions, round(avg((c <= 500)::INT) * 100, 4) AS pct_frozen, round(avg(c), 4) AS mean_abs_change FROM c WHERE c IS NOT NULL GROUP BY 1
""")
def f9_frozen_share(t: Tables) -> DataFrame:
    return series.frozen_share(_daily(t), ["event_type"], "ts", "total", frozen=500.0).select("event_type", "sessions", _r("pct_frozen", 4), _r("mean_abs_change", 4))


@query("SELECT o_orderkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS last FROM orders) WHERE o_orderdate = last")
def f11_newest_per_key(t: Tables) -> DataFrame:
    return scans.live_only(t.orders, ["o_custkey"], "o_orderdate").select("o_orderkey")


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS group_rows FROM orders")
def f14_group_counts(t: Tables) -> DataFrame:
    return series.with_group_count(t.orders, ["o_custkey", "o_orderpriority"], "group_rows").select("o_orderkey", "group_rows")


@query("""
WITH p AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem WHERE l_shipdate::DATE <= DATE '2001-12-01' AND l_shipdate::DATE >= DATE '2001-12-01' - INTERVAL 60 MONTH),
m AS (SELECT l_returnflag, quantile_cont(v, 0.5) AS med, count(*) AS n FROM p GROUP BY 1 HAVING count(*) >= 50), d AS (SELECT l_returnflag, any_value(med) AS med, quantile_cont(abs(v - med), 0.5) AS mad FROM p JOIN m USING (l_returnflag) GROUP BY 1)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - med) / mad, 4) AS z FROM lineitem JOIN d USING (l_returnflag) WHERE mad > 0 AND abs((l_extendedprice - med) / mad) > 1.9
""")
def f15_raw_mad_from_today(t: Tables) -> DataFrame:
    out = series.robust_outliers(t.lineitem, ["l_returnflag"], "l_shipdate", "l_extendedprice", months=60, n_mad=1.9, min_obs=50, scale=1.0, anchor=F.lit("2001-12-01").cast("timestamp"))
    return out.select("l_orderkey", "l_linenumber", F.round("robust_z", 4).alias("z"))


@query("""
WITH s AS (SELECT o_orderpriority, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std FROM orders GROUP BY 1)
SELECT o_orderkey, round((o_totalprice - mean) / std, 6) AS z FROM orders JOIN s USING (o_orderpriority) WHERE abs((o_totalprice - mean) / std) > 1 ORDER BY abs((o_totalprice - mean) / std) DESC, o_orderkey LIMIT 50
""")
def g1_top_flagged(t: Tables) -> DataFrame:
    return series.top_by(checks.sigma_outliers(t.orders, ["o_orderpriority"], "o_totalprice", 1.0), F.abs("z"), 50, "o_orderkey").select("o_orderkey", _r("z"))


@query("SELECT event_id, round(value, 6) AS value FROM events ORDER BY ts DESC, event_id LIMIT 100")
def g2_latest_rows(t: Tables) -> DataFrame:
    return series.top_by(t.events, F.col("ts"), 100, "event_id").select("event_id", _r("value"))


@query("""
SELECT o_custkey, max(o_orderdate::DATE) AS latest, date_diff('day', max(o_orderdate::DATE), DATE '2001-08-02') AS days_behind FROM orders GROUP BY 1 ORDER BY days_behind DESC, o_custkey LIMIT 25
""", dates=("latest",))
def g5_worst_first(t: Tables) -> DataFrame:
    stale = checks.staleness(t.orders, "o_custkey", [], "o_orderdate", lambda d: F.datediff(_date("2001-08-02"), d))
    return reports.worst_first(stale.select("o_custkey", "latest", "days_behind"), n=25)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 100")
def g7_capped_query(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders_view")
    return scans.guarded_query(t.spark, "SELECT o_custkey, count(*) AS n FROM orders_view GROUP BY 1 ORDER BY n DESC, o_custkey", {"orders_view"}, 100)


@query("SELECT o_orderdate::DATE AS d, 'order' AS kind, o_orderkey AS k FROM orders UNION ALL SELECT l_shipdate::DATE, 'shipment', l_orderkey FROM lineitem", dates=("d",))
def h3_union_all(t: Tables) -> DataFrame:
    frames = [t.orders.select(_day("o_orderdate", "d"), F.lit("order").alias("kind"), "o_orderkey"), t.lineitem.select(_day("l_shipdate", "d"), F.lit("shipment").alias("kind"), "l_orderkey")]
    return scans.normalised_union(frames, [{"d": "d", "kind": "kind", "o_orderkey": "k"}, {"d": "d", "kind": "kind", "l_orderkey": "k"}])


@query("""
SELECT c.c_custkey, p.o_orderpriority FROM customer c CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = p.o_orderpriority)
""")
def h5_expected_less_produced(t: Tables) -> DataFrame:
    grid = joins.expected_grid(t.customer.select("c_custkey"), t.orders.select("o_orderpriority").distinct())
    return joins.missing_from_grid(grid, t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey", "o_orderpriority"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def h7_without_children(t: Tables) -> DataFrame:
    return documents.missing_chunks(t.customer, t.orders.where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey")


@query("""
WITH n AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT k, CASE WHEN n.k IS NULL THEN 'removed' WHEN b.k IS NULL THEN 'added' ELSE 'kept' END AS state FROM n FULL JOIN b USING (k)
""")
def h8_watchlist_diff(t: Tables) -> DataFrame:
    o = t.orders.withColumnRenamed("o_custkey", "k")
    return series.watchlist_diff(o.where("o_orderdate < '1997-01-01'"), o.where("o_orderdate >= '2000-01-01'"), "k")


@query("SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (o_orderstatus = 'X') AS X FROM orders GROUP BY 1")
def h11_long_to_wide(t: Tables) -> DataFrame:
    return series.long_to_wide(t.orders, ["o_custkey"], "o_orderstatus", "o_totalprice", ["F", "O", "X"])


@query("SELECT user_id, event_type AS market, round(value / 100, 6) AS yes, round(1 - value / 100, 6) AS no FROM events")
def h13_nested_markets(t: Tables) -> DataFrame:
    market = F.struct(F.col("event_type").alias("market"), F.to_json(F.array((F.col("value") / 100).cast("string"), (1 - F.col("value") / 100).cast("string"))).alias("prices"))
    nested = t.events.groupBy("user_id").agg(F.collect_list(market).alias("markets"))
    return scans.exploded_markets(nested, ["user_id"], "markets", "prices").select("user_id", "market", _r("yes"), _r("no"))
