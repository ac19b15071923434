"""Further queries: text functions, event reconciliation, derived metrics, calendars and prediction-market rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import calendars, checks, documents, joins, prediction, series, writes
from tidemark.plans.registry import Tables, query, stamp
from tidemark.sources import scans


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> F.Column:
    return F.col(c).cast("date").alias(name or c)


def _date(text: str) -> F.Column:
    return F.lit(text).cast("date")


@query("""
SELECT event_id, round(((value - 1) + (value + 1)) / 2, 6) AS mid, round(2 / nullif(value, 0) * 10000, 4) AS spread_bps, round(((value + 0.5) - value) * 10000, 6) AS points FROM events
""")
def b13_forward_math(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select("event_id", F.round(parse.mid_of(v - 1, v + 1, zero_is_missing=False), 6).alias("mid"), F.round(parse.spread_bps(v - 1, v + 1, v), 4).alias("spread_bps"), parse.forward_points(v + 0.5, v, 10000).alias("points"))


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN 'EUR' ELSE 'USD' END AS base, CASE WHEN c_nationkey % 4 = 0 THEN 'USD' ELSE 'C' || c_nationkey END AS quote FROM customer
""")
def b12_pair_orientation(t: Tables) -> DataFrame:
    ccy = F.when(F.col("c_nationkey") % 4 == 0, "EUR").otherwise(F.concat(F.lit("C"), F.col("c_nationkey").cast("string")))
    base, quote = parse.orient_pair(ccy)
    return t.customer.select("c_custkey", base.alias("base"), quote.alias("quote"))


@query("""
SELECT event_id, round(value / 100, 6) AS yes, round(1 - value / 100, 6) AS no FROM events
""")
def b21_json_prices(t: Tables) -> DataFrame:
    p = F.col("value") / 100
    yes, no = parse.yes_no_prices(F.to_json(F.array(p.cast("string"), (1 - p).cast("string"))))
    return t.events.select("event_id", F.round(yes, 6).alias("yes"), F.round(no, 6).alias("no"))


@query("""
SELECT doc_id, CASE WHEN lower(text) LIKE '%password%' THEN 'substring:password' WHEN starts_with(lower(trim(text)), 'licensed') THEN 'prefix:licensed' WHEN regexp_matches(lower(trim(text)), '^[a-z]+!!') THEN 'pattern:^[a-z]+!!' END AS reason FROM documents
""")
def b25_noise_titles(t: Tables) -> DataFrame:
    reason = parse.noise_reason(F.col("text"), ("password",), ("licensed",), ("^[a-z]+!!",))
    return t.documents.select("doc_id", reason.alias("reason"))


@query("""
SELECT doc_id, sha256(source || chr(10) || lang || chr(10) || text) AS h FROM documents
""")
def b27_content_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", parse.content_hash(F.col("source"), F.col("lang"), F.col("text")).alias("h"))


@query("""
SELECT o_orderkey, make_timestamp(year(d), month(d), day(d), 14, 30, 0) - INTERVAL 9 HOUR AS at FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
""".replace("AS at", "AS at_").replace("make_timestamp(year(d), month(d), day(d), 14, 30, 0) - INTERVAL 9 HOUR", "strftime(make_timestamp(year(d), month(d), day(d), 14, 30, 0) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S')"))
def b36_desk_time(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", parse.desk_time(_day("o_orderdate"), F.lit("14:30"), "Asia/Tokyo").alias("at_")).select("o_orderkey", stamp("at_"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN NOT (l_shipdate::DATE >= DATE '1996-01-01') THEN round(l_quantity, 4) END AS q FROM lineitem
""")
def c7_forward_guard(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", _day("l_shipdate", "d"), F.lit(None).cast("timestamp").alias("at"), F.round("l_quantity", 4).alias("q"))
    return checks.guard_forward(li, "d", "at", F.lit("1996-01-01").cast("timestamp"), "q").select("l_orderkey", "l_linenumber", "q")


@query("""
SELECT c_custkey, CASE WHEN count(*) OVER (PARTITION BY c_nationkey, s) = 1 THEN s END AS s FROM (SELECT c_custkey, c_nationkey, c_mktsegment || (c_custkey % 5) AS s FROM customer)
""")
def c8_symbol_collisions(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey", F.concat("c_mktsegment", (F.col("c_custkey") % 5).cast("string")).alias("s"))
    return checks.clear_collisions(c, ["c_nationkey"], "s").select("c_custkey", "s")


@query("""
WITH e AS (SELECT user_id % 10 AS p, event_type AS c, date_trunc('day', ts) AS ts, max(value) AS v FROM events GROUP BY 1, 2, 3), s AS (SELECT DISTINCT p, ts FROM e), l AS (SELECT *, lag(ts) OVER (PARTITION BY p ORDER BY ts) AS pt FROM s)
SELECT e.p, e.c, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS ts, round(b.v, 6) AS prior_v, b.v IS NULL AS is_new FROM e JOIN l ON e.p = l.p AND e.ts = l.ts LEFT JOIN e b ON b.p = e.p AND b.c = e.c AND b.ts = l.pt
""")
def d10_children_with_prior(t: Tables) -> DataFrame:
    e = t.events.groupBy((F.col("user_id") % 10).alias("p"), F.col("event_type").alias("c"), F.date_trunc("day", "ts").alias("ts")).agg(F.max("value").alias("v"))
    return joins.children_with_prior(e, "p", "c", "ts", "v").select("p", "c", stamp("ts"), _r("prior_v"), "is_new")


@query("""
WITH b AS (SELECT o_custkey, o_orderpriority AS lane, o_orderstatus AS s, o_orderkey % 3 = 0 AS blank FROM orders),
f AS (SELECT o_custkey, list_sort(list_distinct(list(lane))) AS lanes FROM b WHERE NOT blank GROUP BY 1)
SELECT o_custkey, lane, len(list_filter(coalesce(lanes, []), lambda x: x <> lane)) AS n_lanes, CASE WHEN len(list_filter(coalesce(lanes, []), lambda x: x <> lane)) > 0 THEN 'ONE-LANE' ELSE 'UNCOVERED' END AS verdict FROM b LEFT JOIN f USING (o_custkey) WHERE blank
""")
def d24_other_lanes(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", F.col("o_orderpriority").alias("lane"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("v"))
    return joins.other_lanes(o, ["o_custkey"], "lane", "v").select("o_custkey", "lane", F.size("lanes").cast("long").alias("n_lanes"), "verdict")


@query("""
SELECT date_trunc('day', ts)::DATE AS d, count(DISTINCT event_type) AS n_events, round(sum(value), 4) AS volume, round(avg(value), 6) AS mean_price, round(quantile_cont(value, 0.5), 6) AS median_price FROM events GROUP BY 1
""", dates=("d",))
def e24_theme_rollup(t: Tables) -> DataFrame:
    e = t.events.withColumns({"d": F.col("ts").cast("date"), "at": F.struct("ts", "event_id")})
    return prediction.theme_rollup(e, ["d"], "event_type", "at", "value", "value").select("d", "n_events", _r("volume", 4), _r("mean_price"), _r("median_price"))


@query("""
SELECT p_brand, round(sum(p_retailprice * p_size) / nullif(sum(p_size), 0), 4) AS composite FROM part GROUP BY 1
""")
def e18_weighted_composite(t: Tables) -> DataFrame:
    return checks.weighted_composite(t.part, ["p_brand"], "p_retailprice", "p_size").select("p_brand", _r("composite", 4))


@query("""
WITH x AS (SELECT DISTINCT event_type, user_id % 10 AS m, event_id FROM events), c AS (SELECT event_type, user_id % 10 AS m, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT *, row_number() OVER (PARTITION BY event_type, m ORDER BY event_id) AS i FROM x)
SELECT c.event_type, c.m, c.n, string_agg(event_id, ',' ORDER BY event_id) AS sample FROM c JOIN s ON s.event_type = c.event_type AND s.m = c.m AND i <= 3 GROUP BY 1, 2, 3
""")
def e30_error_digest(t: Tables) -> DataFrame:
    e = t.events.select("event_type", (F.col("user_id") % 10).alias("m"), "event_id")
    return checks.error_digest(e, "event_type", "m", "event_id").withColumn("sample", F.array_join(F.col("sample").cast("array<string>"), ","))


@query("""
SELECT n_name, count(c_custkey) AS n_rows, coalesce(max(c_custkey), -1) AS newest, CASE WHEN count(c_custkey) = 0 THEN 'MISSING' ELSE 'OK' END AS status FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9800) ON c_nationkey = n_nationkey GROUP BY 1
""")
def e32_lanes_report(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal > 9800").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.lit("2024-01-01").cast("date").alias("published"), "c_custkey")
    report = checks.lanes_report(c, t.nation.select("n_name"), "n_name", "published", _date("2024-01-02"), 3)
    newest = c.groupBy("n_name").agg(F.max("c_custkey").alias("newest"))
    return report.join(newest, "n_name", "left").select("n_name", "n_rows", F.coalesce("newest", F.lit(-1)).alias("newest"), "status")


@query("""
WITH t AS (SELECT DISTINCT n_regionkey, CASE WHEN n_nationkey % 3 = 0 THEN 'asia' WHEN n_nationkey % 7 = 1 THEN 'europe' END AS tag FROM nation)
SELECT n_regionkey, CASE count(tag) WHEN 0 THEN '' WHEN 1 THEN max(tag) ELSE 'global' END AS region FROM t GROUP BY 1
""")
def e35_region_tags(t: Tables) -> DataFrame:
    tag = F.when(F.col("n_nationkey") % 3 == 0, "asia").when(F.col("n_nationkey") % 7 == 1, "europe").otherwise("other")
    return checks.region_of(t.nation.withColumn("tag", tag), "n_regionkey", "tag", ["asia", "europe"])


@query("""
WITH h AS (SELECT event_type, ts::DATE AS d, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2, 3), c AS (SELECT *, sum(n) OVER (PARTITION BY event_type, d ORDER BY h) AS cum, sum(n) OVER (PARTITION BY event_type, d) AS tot FROM h)
SELECT event_type, d, min(h) AS completion_pass, max(tot)::BIGINT AS day_total FROM c WHERE cum >= tot * 0.9 GROUP BY 1, 2
""", dates=("d",))
def f10_completion_pass(t: Tables) -> DataFrame:
    h = t.events.groupBy("event_type", F.col("ts").cast("date").alias("d"), F.hour("ts").cast("long").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return series.completion_pass(h, ["event_type"], "d", "h", "n")


@query("""
WITH i AS (SELECT event_type, ts::DATE AS d, sum(sum(value)) OVER (PARTITION BY event_type ORDER BY ts::DATE) AS idx FROM events GROUP BY 1, 2), l AS (SELECT *, lag(idx) OVER w AS b, lag(d) OVER w AS pd FROM i WINDOW w AS (PARTITION BY event_type ORDER BY d))
SELECT event_type, d, round((idx / b - 1) * 365 / (d - pd) * 100, 4) AS overnight_rate FROM l WHERE b IS NOT NULL
""", dates=("d",))
def f12_overnight_rate(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.sum("value").alias("v"))
    index = daily.withColumn("idx", F.sum("v").over(series._w(["event_type"], "d")))
    return series.overnight_rate(index, ["event_type"], "d", "idx").select("event_type", "d", _r("overnight_rate", 4))


@query("""
WITH x AS (SELECT *, max(l_shipdate::DATE) OVER (PARTITION BY l_suppkey) AS last FROM lineitem)
SELECT l_suppkey, l_partkey, bool_or(l_shipdate::DATE = last) AS is_active FROM x GROUP BY 1, 2
""")
def f13_active_flags(t: Tables) -> DataFrame:
    return series.active_flags(t.lineitem.withColumn("d", _day("l_shipdate")), "l_suppkey", "l_partkey", "d")


@query("""
WITH m AS (SELECT o_custkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, arg_max(o_orderkey, (o_orderdate::DATE, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2) SELECT * FROM m
""")
def f17_month_value(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", _day("o_orderdate", "d"), "o_orderkey")
    return series.month_value(o, ["o_custkey"], "d", "d", "o_orderkey").withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query("""
WITH n AS (SELECT p_brand AS k, p_size::DOUBLE AS x, max(p_retailprice) AS y FROM part GROUP BY 1, 2),
b AS (SELECT k, h, max(x) FILTER (x <= h) AS bx, min(x) FILTER (x >= h) AS ax FROM n, (VALUES (2.5), (10.0), (60.0)) t(h) GROUP BY 1, 2)
SELECT b.k, h::DOUBLE AS horizon, round(CASE WHEN ax IS NULL THEN NULL WHEN bx IS NULL OR ax = bx THEN na.y ELSE nb.y + (na.y - nb.y) * (h - bx) / (ax - bx) END, 4) AS level
FROM b LEFT JOIN n na ON na.k = b.k AND na.x = ax LEFT JOIN n nb ON nb.k = b.k AND nb.x = bx
""")
def h2_curve_at(t: Tables) -> DataFrame:
    nodes = t.part.groupBy(F.col("p_brand").alias("k"), F.col("p_size").cast("double").alias("x")).agg(F.max("p_retailprice").alias("y"))
    return series.curve_at(nodes, ["k"], "x", "y", [2.5, 10.0, 60.0])


@query("""
SELECT o_custkey, count(DISTINCT o_orderdate::DATE) AS n_dates, min(o_orderdate::DATE) AS first_date, max(o_orderdate::DATE) AS last_date FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderdate::DATE) > 1
""", dates=("first_date", "last_date"))
def h9_split_releases(t: Tables) -> DataFrame:
    return series.split_releases(t.orders.select("o_custkey", _day("o_orderdate", "d")), ["o_custkey"], "d")


@query("""
WITH h AS (SELECT n_regionkey AS calendar, n_nationkey AS holiday, CASE WHEN n_nationkey % 2 = 0 THEN 'b' ELSE 'a' END AS vendor FROM nation), v AS (SELECT calendar, min(vendor) AS vendor FROM h GROUP BY 1)
SELECT calendar::VARCHAR AS calendar, holiday, h.vendor FROM h JOIN v USING (calendar, vendor)
""")
def i1_holiday_trust(t: Tables) -> DataFrame:
    vendor = F.when(F.col("n_nationkey") % 2 == 0, "b").otherwise("a")
    h = t.nation.select(F.col("n_regionkey").cast("string").alias("calendar"), F.date_add(_date("2024-01-01"), F.col("n_nationkey").cast("int")).alias("holiday_date"), vendor.alias("vendor"))
    out = calendars.holiday_set(h, ["a", "b"])
    return out.select("calendar", F.datediff("holiday_date", _date("2024-01-01")).alias("holiday"), "vendor")


@query("""
SELECT event_id, CASE WHEN h + m / 60.0 >= 9 AND h + m / 60.0 < 15 AND NOT (h + m / 60.0 >= 11.5 AND h + m / 60.0 < 12.5) THEN true ELSE false END AS is_open FROM (SELECT event_id, hour(ts + INTERVAL 9 HOUR) AS h, minute(ts + INTERVAL 9 HOUR) AS m FROM events)
""")
def i5_market_hours(t: Tables) -> DataFrame:
    is_open = calendars.is_market_open(F.col("ts"), "Asia/Tokyo", F.lit("09:00"), F.lit("15:00"), F.lit("11:30"), F.lit("12:30"))
    return t.events.select("event_id", is_open.alias("is_open"))


@query("""
SELECT event_id, CASE WHEN ts::DATE = (ts + INTERVAL 9 HOUR)::DATE THEN 'OK' ELSE 'MISDATED' END AS date_status FROM events
""")
def i11_date_audit(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", F.col("ts").cast("date").alias("d"), F.lit("Asia/Tokyo").alias("zone"))
    return calendars.audit_dates(e, "d", "ts", "zone").select("event_id", "date_status")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderstatus <> 'F', o_orderkey) AS i FROM orders) SELECT o_custkey, o_orderkey FROM r WHERE i = 1
""")
def i12_collapse_events(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", _day("o_orderdate", "d"), (F.col("o_orderstatus") != "F").alias("soft"), F.lit(None).cast("timestamp").alias("at"), "o_orderkey")
    return calendars.collapse_events(o, ["o_custkey", "d"], "soft", "at", "o_orderkey").select("o_custkey", "o_orderkey")


@query("""
WITH c AS (SELECT n_name AS key, 'R' || n_regionkey AS base FROM nation), e AS (SELECT key, base AS code FROM c WHERE key IN (SELECT min(key) FROM c GROUP BY base)), f AS (SELECT key, base, row_number() OVER (PARTITION BY base ORDER BY key) + 1 AS k FROM c WHERE key NOT IN (SELECT key FROM e))
SELECT key, code FROM e UNION ALL SELECT key, base || '.' || k FROM f
""")
def j5_assign_codes(t: Tables) -> DataFrame:
    c = t.nation.select(F.col("n_name").alias("key"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("base"))
    stored = c.groupBy("base").agg(F.min("key").alias("key")).select("key", F.col("base").alias("code"))
    return writes.assign_codes(stored, c, "key", "base")


@query("""
WITH p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)
SELECT event_id FROM p WHERE CASE event_type WHEN 'click' THEN abs(value - b) > 20 WHEN 'view' THEN abs(value - b) / nullif(abs(b), 0) * 100 > 50 ELSE abs(value - b) / nullif(abs(b), 0) * 100 > 900 END
""")
def j8_tiered_change(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    absolute = t.spark.createDataFrame([("click", 20.0)], "event_type string, threshold double")
    percent = t.spark.createDataFrame([("view", 50.0), ("click", 1.0)], "event_type string, threshold double")
    return writes.tiered_change(e, ["user_id"], "at", "value", [(absolute, ["event_type"], "abs"), (percent, ["event_type"], "pct")], 900.0).select("event_id")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def j9_cascade_delete(t: Tables) -> DataFrame:
    gone = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return writes.cascade_delete(t.lineitem, gone, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("""
SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW) AS used_24h FROM events
""")
def j11_quota(t: Tables) -> DataFrame:
    e = t.events.withColumn("one", F.lit(1))
    return writes.quota_used(e, "ts", "one", 100_000, ["event_type"]).select("event_id", "used_24h")


@query("""
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS earliest FROM events GROUP BY 1 HAVING min(ts) > (SELECT min(ts) + INTERVAL 6 HOUR FROM events)
""")
def l3_needs_backfill(t: Tables) -> DataFrame:
    cutoff = t.events.agg(F.min("ts")).first()[0]  # one instant
    return prediction.needs_backfill(t.events, "user_id", "ts", F.lit(cutoff) + F.expr("interval 6 hours")).select("user_id", stamp("earliest"))


@query("""
WITH l AS (SELECT * FROM events WHERE event_type IN ('click', 'view'))
SELECT event_id FROM events n WHERE ts < (SELECT max(ts) FROM l) AND NOT EXISTS (SELECT 1 FROM l WHERE l.user_id = n.user_id AND l.ts = n.ts)
""")
def l4_clamp_backfill(t: Tables) -> DataFrame:
    first = t.events.agg(F.min("ts")).first()[0]  # one instant
    live = t.events.where("event_type in ('click', 'view')")
    return prediction.clamp_backfill(t.events, live, ["user_id"], "ts", F.lit(first), F.lit("2100-01-01").cast("timestamp")).select("event_id")


@query("""
WITH l AS (SELECT DISTINCT o_custkey AS k, l_shipdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderkey FROM orders WHERE o_orderdate < (SELECT max(ts) FROM l) AND NOT EXISTS (SELECT 1 FROM l WHERE l.k = o_custkey AND l.ts = o_orderdate)
""")
def l4_clamp_backfill_all(t: Tables) -> DataFrame:
    points = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("ts"), "o_orderkey")
    live = t.lineitem.join(points.select("k", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("k", F.col("l_shipdate").alias("ts"))
    first = points.agg(F.min("ts")).first()[0]  # one instant
    return prediction.clamp_backfill(points, live, ["k"], "ts", F.lit(first), F.lit("2100-01-01").cast("timestamp")).select("o_orderkey")


@query("""
WITH r AS (SELECT n_nationkey AS slug FROM nation), m AS (SELECT c_nationkey AS slug, max((c_acctbal > 9900)::INT) AS o FROM customer WHERE c_acctbal > 9700 GROUP BY 1)
SELECT slug, CASE WHEN o IS NULL THEN 'MISSING' WHEN o = 1 THEN 'LIVE' ELSE 'DEAD' END AS status FROM r LEFT JOIN m USING (slug)
""")
def l7_live_status(t: Tables) -> DataFrame:
    m = t.customer.where("c_acctbal > 9700").select(F.col("c_nationkey").alias("slug"), (F.col("c_acctbal") > 9900).alias("is_open"))
    return prediction.live_status(t.nation.select(F.col("n_nationkey").alias("slug")), m, "slug", "is_open")


@query("""
WITH b AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS i FROM events) SELECT user_id, round(value, 6) AS value FROM b WHERE i = 1 ORDER BY value DESC, user_id LIMIT 10
""")
def g4_top_by_volume(t: Tables) -> DataFrame:
    return prediction.discovered(t.events.select("user_id", "value"), "user_id", "value", 10).select("user_id", _r("value"))


@query("""
SELECT conv_id, count(*) AS n_chunks, string_agg(text, '|' ORDER BY turn) AS joined FROM conversations GROUP BY 1
""")
def n2_report_chunks(t: Tables) -> DataFrame:
    reports = t.conversations.select("conv_id").distinct()
    out = documents.report_with_chunks(reports, t.conversations, "conv_id", "turn", "text")
    return out.select("conv_id", F.size("chunks").cast("long").alias("n_chunks"), F.array_join(F.transform("chunks", lambda c: c["text"]), "|").alias("joined"))


@query("""
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def n7_missing_chunks(t: Tables) -> DataFrame:
    return documents.missing_chunks(t.documents, t.labels, "doc_id").select("doc_id")


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'kept' WHEN quality + toxic = 0 THEN 'filled' WHEN quality IS NULL THEN 'none' WHEN quality <> toxic THEN 'several' ELSE 'filled' END AS fill_status FROM documents LEFT JOIN labels USING (doc_id)
""")
def n9_fill_country(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("country"))
    tags = t.labels.select("doc_id", F.explode(F.array(F.col("quality").cast("string"), F.col("toxic").cast("string"))).alias("country_tag"))
    return documents.fill_country(docs, tags, "doc_id", "country").select("doc_id", "fill_status")


@query("""
SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer
""")
def a20_normalised_union(t: Tables) -> DataFrame:
    return scans.normalised_union([t.supplier, t.customer], [{"s_name": "name", "s_acctbal": "balance"}, {"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}])


@query("""
SELECT o_custkey, max(o_orderdate::DATE) AS target_date FROM orders GROUP BY 1 HAVING max((o_orderpriority = '1-URGENT')::INT) = 1
""", dates=("target_date",))
def a21_failed_runs(t: Tables) -> DataFrame:
    return scans.failed_runs(t.orders.withColumn("d", _day("o_orderdate")), "o_custkey", "o_orderpriority", "d", "1-URGENT")


@query("""
SELECT event_id FROM events WHERE ts::DATE BETWEEN DATE '2024-01-10' - INTERVAL 5 DAY AND DATE '2024-01-10'
""")
def a22_fetch_window(t: Tables) -> DataFrame:
    return scans.fetch_window(t.events, "ts", "2024-01-10", 5).select("event_id")


@query("""
SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows, min(o_orderdate::DATE) AS first_date, max(o_orderdate::DATE) AS last_date FROM orders GROUP BY 1, 2
""", dates=("first_date", "last_date"))
def a14_manifest(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month"), _day("o_orderdate", "d"))
    return scans.manifest(o, ["o_orderpriority", "month"], "d")
