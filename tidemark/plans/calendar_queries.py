"""Queries for calendars, event tables, table changes, check suites, prediction markets and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import calendars, checks, documents, joins, prediction, reports, series, writes
from tidemark.plans.registry import Tables, query, stamp


def _r(c: str, n: int = 6) -> Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> Column:
    return F.col(c).cast("date").alias(name or c)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


_DAYS = """
h AS (SELECT DISTINCT n_name AS calendar, l_shipdate::DATE AS d FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity = 50),
s AS (SELECT n_name AS calendar, unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS d FROM nation),
t AS (SELECT calendar, d, h.d IS NOT NULL AS is_holiday, isodow(d) < 6 AND h.d IS NULL AS is_trading FROM s LEFT JOIN h USING (calendar, d)),
n AS (SELECT *, sum(is_trading::INT) OVER (PARTITION BY calendar ORDER BY d) AS no FROM t)
"""


def _holidays(t: Tables) -> DataFrame:
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("calendar"))
    return t.lineitem.where("l_quantity = 50").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("calendar", _day("l_shipdate", "holiday_date")).distinct()


def _trading_days(t: Tables) -> DataFrame:
    names = t.nation.select(F.col("n_name").alias("calendar"), F.lit("5,6").alias("weekend"))
    return calendars.trading_days(names, _holidays(t), _date("1995-01-01"), _date("2001-12-31"))


@query(f"""
WITH {_DAYS} SELECT calendar, d, last_value(CASE WHEN is_trading THEN d END IGNORE NULLS) OVER (PARTITION BY calendar ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_trading,
    first_value(CASE WHEN is_trading THEN d END IGNORE NULLS) OVER (PARTITION BY calendar ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_trading FROM t
""", dates=("d", "last_trading", "next_trading"))
def i3_neighbouring_days(t: Tables) -> DataFrame:
    return calendars.neighbours(_trading_days(t)).select("calendar", "d", "last_trading", "next_trading")


_BY_NATION = "SELECT o_orderkey, n_name AS calendar, o_orderdate::DATE AS d FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _by_nation(t: Tables) -> DataFrame:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("calendar"))
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "calendar", _day("o_orderdate", "d"))


@query(f"WITH {_DAYS}, o AS ({_BY_NATION}) SELECT o_orderkey, b.no - a.no AS n_trading FROM o JOIN n a ON a.calendar = o.calendar AND a.d = o.d JOIN n b ON b.calendar = o.calendar AND b.d = o.d + 30")
def i4_trading_days_between(t: Tables) -> DataFrame:
    spans = _by_nation(t).select("o_orderkey", "calendar", F.col("d").alias("start"), F.date_add("d", 30).alias("end"))
    return calendars.trading_days_between(spans, _trading_days(t), "start", "end").select("o_orderkey", "n_trading")


_ZONE = "CASE n_regionkey WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'America/New_York' ELSE 'Europe/London' END"


@query(f"""
WITH {_DAYS}, z AS (SELECT n_name AS calendar, (TIMESTAMP '1998-06-03 18:30:00' AT TIME ZONE 'UTC') AT TIME ZONE {_ZONE} AS local FROM nation)
SELECT calendar, max(d) AS last_business_day FROM t JOIN z USING (calendar) WHERE is_trading AND (d < local::DATE OR d = local::DATE AND strftime(local, '%H:%M') >= '17:00') GROUP BY 1
""", dates=("last_business_day",))
def i6_last_business_day(t: Tables) -> DataFrame:
    zone = F.when(F.col("n_regionkey") == 0, "Asia/Tokyo").when(F.col("n_regionkey") == 1, "America/New_York").otherwise("Europe/London")
    markets = t.nation.select(F.col("n_name").alias("calendar"), zone.alias("zone"), F.lit("17:00").alias("closes"))
    return reports.last_business_day(_trading_days(t).join(markets, "calendar"), _stamp("1998-06-03 18:30:00"), "closes", "zone")


@query(f"""
WITH {_DAYS}, e AS (SELECT DISTINCT 'C' || n_nationkey AS ccy, n_name AS calendar, ((ts + INTERVAL 0 DAY) AT TIME ZONE 'UTC' AT TIME ZONE {_ZONE})::DATE AS d FROM nation CROSS JOIN (SELECT DISTINCT date_trunc('day', o_orderdate) + INTERVAL 20 HOUR AS ts FROM orders))
SELECT ccy, calendar, e.d AS holiday_date FROM e JOIN h USING (calendar, d)
""", dates=("holiday_date",))
def i8_holiday_hits(t: Tables) -> DataFrame:
    zone = F.when(F.col("n_regionkey") == 0, "Asia/Tokyo").when(F.col("n_regionkey") == 1, "America/New_York").otherwise("Europe/London")
    countries = t.nation.select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("ccy"), F.col("n_name").alias("calendar"), zone.alias("zone"))
    asked = countries.select("ccy").crossJoin(t.orders.select((F.date_trunc("day", "o_orderdate") + F.expr("interval 20 hours")).alias("at")).distinct())  # currencies are a small dimension
    return calendars.holiday_hits(asked, countries, _holidays(t), F.col("at")).distinct()


@query(f"""
WITH {_DAYS}, o AS (SELECT calendar, d, count(*) AS rows_there FROM ({_BY_NATION}) GROUP BY 1, 2)
SELECT o.calendar, o.d, CASE WHEN rows_there >= 2 THEN 'PASS' WHEN is_trading THEN 'FAIL' ELSE 'RELAXED' END AS status FROM o JOIN t USING (calendar, d)
""", dates=("d",))
def i9_relaxed_checks(t: Tables) -> DataFrame:
    results = _by_nation(t).groupBy("calendar", "d").agg(F.when(F.count(F.lit(1)) >= 2, "PASS").otherwise("FAIL").alias("status"))
    return calendars.relaxed(results, _trading_days(t), ["calendar", "d"])


@query("""
SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-01' - 200 AND DATE '1998-06-01' + 100 AND o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'
""")
def i10_events_around(t: Tables) -> DataFrame:
    e = t.orders.select("o_orderkey", _day("o_orderdate", "d"), F.col("o_orderpriority").alias("category"), (F.col("o_orderstatus") == "P").alias("is_estimated"))
    return calendars.events_between(e, "d", _date("1998-06-01"), 200, 100, confirmed_only=True, category="1-URGENT").select("o_orderkey")


@query("""
WITH e AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS actual, CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END AS survey FROM orders), f AS (SELECT DISTINCT o_custkey FROM e WHERE actual IS NOT NULL)
SELECT o_orderkey, CASE WHEN f.o_custkey IS NULL THEN 'UNCOVERED' ELSE 'ONE-LANE' END AS verdict FROM e LEFT JOIN f USING (o_custkey) WHERE actual IS NULL AND survey IS NOT NULL AND o_orderdate < TIMESTAMP '2001-01-01' - INTERVAL 48 HOUR
""")
def i13_missing_actuals(t: Tables) -> DataFrame:
    e = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("event_datetime"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("actual"), F.when(F.col("o_orderpriority") != "5-LOW", 1).alias("survey"))
    return reports.missing_actuals(e, ["o_custkey"], _stamp("2001-01-01"), 48).select("o_orderkey", "verdict")


_EVENTS = """
s AS (SELECT o_custkey AS country, o_orderdate::DATE AS d, CASE WHEN min(o_orderpriority) < '3' THEN 'T' || min(o_orderpriority) END AS ticker, 'order' AS name, count(*)::DOUBLE AS survey, CASE WHEN min(o_orderstatus) = 'F' THEN round(max(o_totalprice), 2) END AS actual FROM orders GROUP BY 1, 2),
b AS (SELECT country, d, ticker, name, survey + 1 AS survey, CASE WHEN d < DATE '2000-01-01' THEN round(coalesce(actual, 0) + survey, 2) END AS actual FROM s WHERE ticker IS NULL OR survey > 1
    UNION ALL SELECT o_custkey, l_shipdate::DATE, NULL, 'shipment', NULL, CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN round(max(l_extendedprice), 2) END FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, l_shipdate),
m AS (SELECT coalesce(s.country, b.country) AS country, coalesce(s.d, b.d) AS d, coalesce(s.ticker, b.ticker) AS ticker, coalesce(s.name, b.name) AS name, coalesce(b.survey, s.survey) AS survey, coalesce(b.actual, s.actual) AS actual, s.actual AS old_actual,
    CASE WHEN s.country IS NULL THEN 'inserted' WHEN b.country IS NULL OR coalesce(b.survey = s.survey, b.survey IS NULL) AND coalesce(b.actual = s.actual, b.actual IS NULL) THEN 'kept' ELSE 'updated' END AS action
    FROM s FULL JOIN b ON s.country = b.country AND s.d = b.d AND (s.ticker IS NULL) = (b.ticker IS NULL) AND coalesce(s.ticker, s.name) = coalesce(b.ticker, b.name))
"""


def _event_upsert(t: Tables) -> tuple[DataFrame, DataFrame]:
    first = F.min("o_orderpriority")
    s = t.orders.groupBy(F.col("o_custkey").alias("country"), _day("o_orderdate", "event_date")).agg(F.when(first < "3", F.concat(F.lit("T"), first)).alias("ticker"), F.lit("order").alias("name"), F.count(F.lit(1)).cast("double").alias("survey"), F.when(F.min("o_orderstatus") == "F", F.round(F.max("o_totalprice"), 2)).alias("actual"))
    again = s.where("ticker is null or survey > 1").select("country", "event_date", "ticker", "name", (F.col("survey") + 1).alias("survey"), F.round(F.coalesce("actual", F.lit(0.0)) + F.col("survey"), 2).alias("actual"))
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("country"), _day("l_shipdate", "event_date")).agg(F.round(F.max("l_extendedprice"), 2).alias("actual"))
    new = shipped.select("country", "event_date", F.lit(None).cast("string").alias("ticker"), F.lit("shipment").alias("name"), F.lit(None).cast("double").alias("survey"), "actual")
    return writes.upsert_events(s, again.unionByName(new), ["country", "event_date"], _stamp("2000-01-01"), [F.desc_nulls_last("actual")])


@query(f"WITH {_EVENTS} SELECT country, d AS event_date, coalesce(ticker, '') AS ticker, name, survey, actual, action FROM m", dates=("event_date",))
def i14_event_upsert(t: Tables) -> DataFrame:
    table, _ = _event_upsert(t)
    return table.select("country", "event_date", F.coalesce("ticker", F.lit("")).alias("ticker"), "name", "survey", "actual", F.col("_action").alias("action"))


@query(f"WITH {_EVENTS} SELECT country, d AS event_date, name, old_actual, actual AS new_actual FROM m WHERE action <> 'kept' AND actual IS NOT NULL AND actual IS DISTINCT FROM old_actual", dates=("event_date",))
def i14_actual_changes(t: Tables) -> DataFrame:
    _, changes = _event_upsert(t)
    return changes.select("country", "event_date", "name", "old_actual", "new_actual")


_NEWEST = "SELECT p_brand AS family, max(l_shipdate::DATE) AS newest FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"


def _newest(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("family")).agg(F.max(_day("l_shipdate")).alias("newest"))


@query(f"""
WITH f AS ({_NEWEST}), p AS (SELECT a.family AS derived, b.family AS input, a.newest AS dn, b.newest AS bn FROM f a JOIN f b ON a.family <> b.family AND left(a.family, 7) = left(b.family, 7))
SELECT derived, input, (SELECT count(*) FROM generate_series(bn + 1, dn, INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6) AS lead_days FROM p WHERE dn > bn AND (SELECT count(*) FROM generate_series(bn + 1, dn, INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6) > 2
""")
def i15_coherence(t: Tables) -> DataFrame:
    newest = _newest(t)
    names = newest.select("family", F.substring("family", 1, 7).alias("head"))
    pairs = names.select(F.col("family").alias("derived"), "head").join(names.select(F.col("family").alias("input"), "head"), "head").where("derived != input").select("derived", "input")  # families are a small dimension
    return calendars.coherence(pairs, newest, 2).select("derived", "input", F.col("lead_days").cast("long").alias("lead_days"))


@query("""
WITH m AS (SELECT user_id, arg_max(ts, (ts, value)) FILTER (ts::DATE = DATE '2024-01-09') AS ta, arg_max(value, (ts, value)) FILTER (ts::DATE = DATE '2024-01-09') AS va, arg_max(ts, (ts, value)) FILTER (ts::DATE = DATE '2024-01-10') AS tb, arg_max(value, (ts, value)) FILTER (ts::DATE = DATE '2024-01-10') AS vb
    FROM events WHERE ts::DATE IN (DATE '2024-01-09', DATE '2024-01-10') GROUP BY 1)
SELECT user_id, round((vb - va) * 100, 4) AS change_bp, abs(hour(tb) * 60 + minute(tb) - hour(ta) * 60 - minute(ta)) > 90 AS mark_mismatch FROM m
""")
def i16_session_scope(t: Tables) -> DataFrame:
    marks = t.events.withColumn("d", _day("ts"))
    return calendars.session_scope(marks, "user_id", "d", "ts", "value", _date("2024-01-09"), _date("2024-01-10")).select("user_id", _r("change_bp", 4), "mark_mismatch")


@query(f"""
WITH {_DAYS}, x AS (SELECT calendar, d, d >= DATE '2000-01-01' AS is_new FROM h) SELECT calendar, sum(is_new::INT)::BIGINT AS n_new, sum((NOT is_new)::INT)::BIGINT AS n_known FROM x GROUP BY 1
""")
def i17_holiday_snapshot(t: Tables) -> DataFrame:
    incoming = _holidays(t)
    _, counts = reports.holiday_snapshot(incoming.where("holiday_date < '2000-01-01'"), incoming)
    return counts


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber, max((l_shipdate, l_extendedprice)) AS r FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_linenumber, r[2] AS l_extendedprice FROM b
""")
def j2_collapsed_batch(t: Tables) -> DataFrame:
    batch = series.keep_one(t.lineitem, ["l_orderkey", "l_linenumber"], F.desc("l_shipdate"), F.desc("l_extendedprice"))
    nothing = batch.select("l_orderkey", "l_linenumber", "l_extendedprice").limit(0)
    merged = writes.merge_upsert(nothing, batch, writes.MergeSpec(["l_orderkey", "l_linenumber"], ["l_extendedprice"]))  # two rows for one key would fail
    return merged.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""
WITH e AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), t AS (SELECT k, row_number() OVER (ORDER BY k) AS id FROM e), f AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT k FROM e))
SELECT k, id, false AS is_new FROM t UNION ALL SELECT k, (SELECT max(id) FROM t) + row_number() OVER (ORDER BY k), true FROM f
""")
def j4_seed_large_dimension(t: Tables) -> DataFrame:
    keys = t.orders.select(F.col("o_custkey").alias("k"), "o_orderstatus")
    empty = t.spark.createDataFrame([], "k long, id long")
    stored = writes.seed_dimension(empty, keys.where("o_orderstatus = 'F'"), "k").select("k", "id")
    return writes.seed_dimension(stored, keys, "k")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE NOT BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
def j6_range_removed(t: Tables) -> DataFrame:
    return writes.without_range(t.orders.withColumn("d", _day("o_orderdate")), "d", _date("1997-01-01"), _date("1997-12-31")).select("o_orderkey")


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority AS quote, max(o_orderstatus) AS status, max(o_orderdate::DATE) AS last_checked FROM orders GROUP BY 1, 2)
SELECT o_custkey, quote FROM c WHERE quote <> '1-URGENT' AND date_diff('day', last_checked, DATE '2001-08-02') < CASE status WHEN 'F' THEN 400 WHEN 'P' THEN 1000 ELSE 0 END
""")
def j10_known_empty(t: Tables) -> DataFrame:
    cache = t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("quote")).agg(F.max("o_orderstatus").alias("status"), F.max(_day("o_orderdate")).alias("last_checked"))
    return writes.still_empty(cache, _date("2001-08-02"), {"F": 400, "P": 1000}, ["1-URGENT"]).select("o_custkey", "quote")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE ELSE DATE '2001-08-02' END AS as_of, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate::DATE END AS target_date FROM orders
""", dates=("as_of", "target_date"))
def j12_forecast_rows(t: Tables) -> DataFrame:
    f = t.orders.select("o_orderkey", F.col("o_orderdate").alias("ts"), F.when(F.col("o_orderstatus") == "F", "RELATIVE").otherwise("ABSOLUTE").alias("horizon_type"))
    return writes.forecast_rows(f, _date("2001-08-02")).select("o_orderkey", "as_of", "target_date")


@query("SELECT DISTINCT sha256(text) AS k FROM documents WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en' AND text IS NOT NULL)")
def j13_unseen_items(t: Tables) -> DataFrame:
    items = t.documents.where("text is not null").select(F.sha2("text", 256).alias("k"), "lang")
    return writes.unseen(items, items.where("lang = 'en'"), "k").select("k")


_K2 = [("positive", "l_quantity <= 1"), ("order", "l_discount > l_tax"), ("range", "l_extendedprice NOT BETWEEN 1000 AND 90000"), ("composite", "l_returnflag = 'R' AND l_quantity > 49")]


@query("\nUNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) AS n_rows, coalesce(sum(({c})::INT), 0)::BIGINT AS n_failed, CASE WHEN coalesce(sum(({c})::INT), 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM lineitem" for name, c in _K2))
def k2_table_rules(t: Tables) -> DataFrame:
    return checks.run_checks(t.lineitem, {name: F.expr(c) for name, c in _K2})


@query("""
WITH d AS (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT strftime(a.ts, '%Y-%m-%d %H:%M:%S') AS ts, round(b.v - a.v, 6) AS basis FROM d a JOIN d b ON a.ts = b.ts AND a.event_type = 'click' AND b.event_type = 'view' WHERE abs(b.v - a.v) > 10
""")
def k7_basis_check(t: Tables) -> DataFrame:
    hourly = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("v"))
    return reports.basis_check(hourly, ["ts"], "event_type", "v", "click", "view", 10.0).select(stamp("ts"), _r("basis"))


@query("""
WITH b AS (SELECT event_type, date_trunc('hour', ts) AS ts, round(avg(value), 4) AS v FROM events GROUP BY 1, 2), l AS (SELECT *, lag(ts) OVER w AS pt, lag(v) OVER w AS pv FROM b WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round((v / nullif(pv, 0) - 1) * 100, 4) AS pct FROM l WHERE epoch(ts) - epoch(pt) <= 6 * 3600 AND abs((v / nullif(pv, 0) - 1) * 100) >= 50
""")
def k9_anomaly_prescreen(t: Tables) -> DataFrame:
    bars = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(F.round(F.avg("value"), 4).alias("v"))
    return reports.prescreen(bars, bars, ["event_type"], "ts", "v", 50.0, 6 * 3600).select("event_type", stamp("ts"), _r("pct", 4))


@query("""
SELECT 'orders' AS spec, o_custkey::VARCHAR AS key, max(o_orderdate::DATE) AS latest, date_diff('day', max(o_orderdate::DATE), DATE '2001-12-01') AS days_behind FROM orders GROUP BY 2 HAVING date_diff('day', max(o_orderdate::DATE), DATE '2001-12-01') > 200
UNION ALL SELECT 'shipments', l_partkey::VARCHAR, max(l_shipdate::DATE), date_diff('day', max(l_shipdate::DATE), DATE '2001-12-01') FROM lineitem GROUP BY 2 HAVING date_diff('day', max(l_shipdate::DATE), DATE '2001-12-01') > 150
""", dates=("latest",))
def k10_staleness_monitor(t: Tables) -> DataFrame:
    specs = [reports.StalenessSpec("orders", t.orders, "o_custkey", "o_orderdate", 200), reports.StalenessSpec("shipments", t.lineitem, "l_partkey", "l_shipdate", 150)]
    return reports.staleness_monitor(specs, lambda d: F.datediff(_date("2001-12-01"), d))


@query("""
WITH y AS (SELECT year(o_orderdate) AS year, sum((o_totalprice > 490000)::INT)::BIGINT AS dear, sum((o_orderpriority = '4-NOT SPECIFIED')::INT)::BIGINT AS unspecified, sum((o_totalprice IS NULL)::INT)::BIGINT AS blank FROM orders GROUP BY 1)
SELECT year, 'dear' AS check_name, dear AS n_failed FROM y UNION ALL SELECT year, 'unspecified', unspecified FROM y UNION ALL SELECT year, 'blank', blank FROM y
""")
def k11_year_checks(t: Tables) -> DataFrame:
    rules = {"dear": F.col("o_totalprice") > 490_000, "unspecified": F.col("o_orderpriority") == "4-NOT SPECIFIED", "blank": F.col("o_totalprice").isNull()}
    return reports.checks_by_year(t.orders, "o_orderdate", rules)


@query("""
WITH h AS (SELECT event_type, ts::DATE AS d, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2, 3), c AS (SELECT *, sum(n) OVER (PARTITION BY event_type, d ORDER BY h) AS cum, sum(n) OVER (PARTITION BY event_type, d) AS tot FROM h),
p AS (SELECT event_type, d, min(h) AS pass FROM c WHERE cum >= tot * 0.9 GROUP BY 1, 2), k AS (SELECT event_type, pass, count(*) AS n FROM p GROUP BY 1, 2), u AS (SELECT event_type, pass AS usual_pass FROM k QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, pass) = 1),
x AS (SELECT event_type, usual_pass, count(*) AS days, sum((pass > usual_pass)::INT)::BIGINT AS late_days, max(d) AS newest FROM p JOIN u USING (event_type) GROUP BY 1, 2)
SELECT event_type, usual_pass, days, late_days, CASE WHEN newest < (SELECT max(ts::DATE) FROM events) THEN 'BEHIND' WHEN days < 10 THEN 'SPARSE' WHEN 1 - late_days / days >= 0.9 AND late_days <= 2 THEN 'OK' WHEN 1 - late_days / days >= 0.9 THEN 'INTERMITTENT' ELSE 'LATE' END AS verdict FROM x
""")
def k12_arrival_drift(t: Tables) -> DataFrame:
    hours = t.events.groupBy("event_type", _day("ts", "d"), F.hour("ts").cast("long").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    last = t.events.agg(F.max(_day("ts"))).first()[0]  # one date
    return reports.arrival_drift(hours, ["event_type"], "d", "h", "n", F.lit(last)).select("event_type", "usual_pass", "days", "late_days", "verdict")


@query(f"""
WITH f AS ({_NEWEST}), d AS (SELECT family, (SELECT count(*) FROM generate_series(newest + 1, DATE '2001-12-05', INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6) AS days_behind FROM f) SELECT family, days_behind, days_behind > 22 + 3 AS is_late FROM d
""")
def k14_feed_freshness(t: Tables) -> DataFrame:
    out = reports.feed_freshness(_newest(t).withColumns({"lag_days": F.lit(22), "grace": F.lit(3)}), _date("2001-12-05"))
    return out.select("family", F.col("days_behind").cast("long").alias("days_behind"), "is_late")


@query("""
WITH o AS (SELECT count(DISTINCT o_custkey) AS n_keys, count(*) AS n_rows FROM orders), od AS (SELECT count(*) AS n FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate::DATE HAVING count(*) > 1)), oc AS (SELECT (sum((o_totalprice > 499000)::INT) > 0)::INT + (sum((o_totalprice <= 0)::INT) > 0)::INT AS n FROM orders),
l AS (SELECT count(DISTINCT l_suppkey) AS n_keys, count(*) AS n_rows FROM lineitem), ld AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_suppkey, l_shipdate::DATE HAVING count(*) > 1)), lc AS (SELECT (sum((l_discount > l_tax)::INT) > 0)::INT AS n FROM lineitem)
SELECT 'orders' AS domain, n_keys, n_rows, od.n AS n_duplicates, oc.n AS n_failed_checks FROM o, od, oc UNION ALL SELECT 'lines', n_keys, n_rows, ld.n, lc.n FROM l, ld, lc
""")
def k15_dashboard(t: Tables) -> DataFrame:
    domains = {"orders": t.orders.withColumn("d", _day("o_orderdate")), "lines": t.lineitem.withColumn("d", _day("l_shipdate"))}
    rules = {"orders": {"dear": F.col("o_totalprice") > 499_000, "free": F.col("o_totalprice") <= 0}, "lines": {"discount": F.col("l_discount") > F.col("l_tax")}}
    return reports.dashboard(domains, {"orders": ["o_custkey"], "lines": ["l_suppkey"]}, "d", rules)


@query("""
WITH h AS (SELECT * FROM events WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events))
SELECT 'large' AS check_name, count(*) AS n_rows, coalesce(sum((value > 50)::INT), 0)::BIGINT AS n_failed FROM h UNION ALL SELECT 'zero', count(*), coalesce(sum((value <= 0)::INT), 0)::BIGINT FROM h
""")
def k16_hour_checks(t: Tables) -> DataFrame:
    last = t.events.agg(F.max(F.date_trunc("hour", "ts"))).first()[0]  # one instant
    return reports.hour_checks(t.events, "ts", F.lit(last), {"large": F.col("value") > 50, "zero": F.col("value") <= 0}).select("check_name", "n_rows", "n_failed")


@query("""
WITH m AS (SELECT user_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY value DESC) = 1), n AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT n.user_id, round(n.value - (SELECT arg_max(value, ts) FROM m WHERE m.user_id = n.user_id AND m.ts <= n.ts - INTERVAL 24 HOUR AND m.ts >= n.ts - INTERVAL 192 HOUR), 6) AS change_24h,
    CASE WHEN n.ts::DATE >= DATE '2024-01-30' THEN 'upcoming' WHEN date_diff('day', n.ts::DATE, DATE '2024-01-30') <= 5 THEN 'recent' ELSE 'dropped' END AS section FROM n
""")
def l2_macro_snapshot(t: Tables) -> DataFrame:
    modal = series.modal_child(t.events.select("user_id", "ts", "value"), ["user_id", "ts"], "value", "value")
    lagged = joins.asof_lags(modal, ["user_id"], "ts", "value", [24]).withColumn("d", _day("ts"))
    return reports.macro_snapshot(lagged, "user_id", "ts", "value", [24], _date("2024-01-30"), "d").select("user_id", _r("change_24h"), "section")


@query("SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25' - INTERVAL 7 DAY")
def l6_retention(t: Tables) -> DataFrame:
    return prediction.purge(t.events, "ts", _stamp("2024-01-25"), 7).select("event_id")


@query("""
WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, list_sum(list_transform(list_zip(embedding, v), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)) / (sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))) * sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x)))) AS score FROM embeddings, q),
h AS (SELECT vec_id AS doc_id, score FROM s WHERE score >= 0.1), v AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY 1)
SELECT h.doc_id, round(score, 6) AS score, coalesce(d.source, '') AS source, coalesce(n_docs, 0) AS n_docs FROM h LEFT JOIN documents d USING (doc_id) LEFT JOIN v USING (source)
""")
def d23_hits_with_report(t: Tables) -> DataFrame:
    asked = t.embeddings.where("vec_id = 0").select(F.col("embedding").alias("q"))  # one vector
    scored = t.embeddings.crossJoin(F.broadcast(asked)).select(F.col("vec_id").alias("doc_id"), documents.cosine(F.col("embedding"), F.col("q")).alias("score")).where("score >= 0.1")
    vendors = t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    out = documents.hits_with_report(scored, t.documents.select("doc_id", "source"), vendors, "doc_id", "source")
    return out.select("doc_id", _r("score"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


@query("""
WITH e AS (SELECT DISTINCT p_name AS tag FROM part WHERE p_type = 'PROMO'), f AS (SELECT DISTINCT p_name AS tag FROM part EXCEPT SELECT tag FROM e)
SELECT tag, length(tag) AS id, false AS is_new FROM e UNION ALL SELECT tag, ('0x' || substr(sha256(tag), 1, 15))::BIGINT, true FROM f
""")
def n8_hash_ids(t: Tables) -> DataFrame:
    tags = t.part.select(F.col("p_name").alias("tag"), "p_type")
    stored = tags.where("p_type = 'PROMO'").select("tag", F.length("tag").alias("id")).distinct()
    return writes.hash_ids(stored, tags, "tag")
