"""Queries over the star-schema tables: facts, dimensions, calendars, vintages, upserts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import calendars, checks, documents, joins, series, writes
from tidemark.plans.registry import Tables, query
from tidemark.sources import scans


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> F.Column:
    return F.col(c).cast("date").alias(name or c)


@query("""
SELECT o_orderkey, o_orderdate::DATE AS d, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1995-06-30'
""", dates=("d",))
def a1_date_range(t: Tables) -> DataFrame:
    o = t.orders.withColumn("d", _day("o_orderdate"))
    return scans.date_range_scan(o, "d", F.lit("1995-01-01").cast("date"), F.lit("1995-06-30").cast("date"), ["o_orderkey", "d", "o_totalprice"]).select("o_orderkey", "d", _r("o_totalprice", 2))


@query("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 500
""")
def a2_filtered_view(t: Tables) -> DataFrame:
    return scans.read_view(t.orders, {"o_orderstatus": "O"}, ["o_orderkey"], 500).select("o_orderkey", "o_orderpriority")


@query("""
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1
""")
def a4_guarded_query(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("customer_view")
    return scans.guarded_query(t.spark, "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer_view GROUP BY 1", {"customer_view"})


@query("""
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def d1_dimension_join(t: Tables) -> DataFrame:
    c = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    out = joins.lookup(c, t.nation, ["n_nationkey"], required=True).withColumnRenamed("n_regionkey", "r_regionkey")
    return joins.lookup(out, t.region, ["r_regionkey"], required=True).select("c_custkey", "n_name", "r_name")


@query("""
SELECT o_orderkey, c_custkey IS NULL AS unmapped FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
""")
def d2_unmapped(t: Tables) -> DataFrame:
    dim = t.customer.where("c_mktsegment != 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.lookup(t.orders, dim, ["o_custkey"]).select("o_orderkey", "unmapped")


@query("""
SELECT o_custkey, o_orderkey FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) USING (o_custkey, o_orderdate)
""")
def d3_latest_rows(t: Tables) -> DataFrame:
    return joins.latest_rows(t.orders, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("""
WITH l AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS a FROM orders WHERE o_orderstatus = 'F'), r AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS b FROM orders WHERE o_orderstatus <> 'F'),
m AS (SELECT l.k, a, b, b - a AS delta FROM l JOIN r ON l.k = r.k AND abs(b - a) <= 3), n AS (SELECT *, row_number() OVER (PARTITION BY k, a ORDER BY delta <> 0, delta) AS i FROM m)
SELECT k, a AS left_date, b AS right_date, CASE WHEN delta = 0 THEN 'MATCH' ELSE 'DATE_MISMATCH' END AS status FROM n WHERE i = 1
UNION ALL SELECT k, a, NULL, 'LEFT_ONLY' FROM l WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = l.k AND m.a = l.a)
UNION ALL SELECT k, NULL, b, 'RIGHT_ONLY' FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = r.k AND m.b = r.b)
""", dates=("left_date", "right_date"))
def d12_window_match(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), _day("o_orderdate", "d"), "o_orderstatus")
    return joins.match_within_days(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus != 'F'"), ["k"], "d", 3)


@query("""
WITH l AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS a FROM orders), r AS (SELECT DISTINCT o_custkey AS k, l_shipdate::DATE AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT l.k, a, b, b - a AS delta FROM l JOIN r ON l.k = r.k AND abs(b - a) <= 3), n AS (SELECT *, row_number() OVER (PARTITION BY k, a ORDER BY delta <> 0, delta) AS i FROM m)
SELECT k, a AS left_date, b AS right_date, CASE WHEN delta = 0 THEN 'MATCH' ELSE 'DATE_MISMATCH' END AS status FROM n WHERE i = 1
UNION ALL SELECT k, a, NULL, 'LEFT_ONLY' FROM l WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = l.k AND m.a = l.a)
UNION ALL SELECT k, NULL, b, 'RIGHT_ONLY' FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.k = r.k AND m.b = r.b)
""", dates=("left_date", "right_date"))
def d12_window_match_all(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), _day("o_orderdate", "d"), "o_orderkey")
    shipped = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("k", _day("l_shipdate", "d"))
    return joins.match_within_days(o, shipped, ["k"], "d", 3)


@query("""
SELECT i.o_orderkey, i.o_custkey FROM orders i WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderkey % 3 = 0 AND e.o_orderkey = i.o_orderkey)
""")
def d14_insert_missing(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey")
    return joins.insert_missing(o.where("o_orderkey % 3 = 0"), o, ["o_orderkey"])


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def d15_keys_in_batch(t: Tables) -> DataFrame:
    batch = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.keys_in(t.lineitem, batch, ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@query("""
WITH g AS (SELECT n_nationkey, s FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment AS s FROM customer))
SELECT n_nationkey, s FROM g WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = s AND c_acctbal > 9900)
""")
def d18_missing_grid(t: Tables) -> DataFrame:
    grid = joins.expected_grid(t.nation.select("n_nationkey"), t.customer.select(F.col("c_mktsegment").alias("s")).distinct())
    rich = t.customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("s"))
    return joins.missing_from_grid(grid, rich, ["n_nationkey", "s"])


@query("""
WITH k AS (SELECT DISTINCT l_suppkey AS k FROM lineitem), s AS (SELECT k, last_day(m::DATE) AS month_end FROM k, generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH) g(m)),
d AS (SELECT DISTINCT l_suppkey AS k, l_shipdate::DATE AS d, last_day(l_shipdate::DATE) AS month_end FROM lineitem), n AS (SELECT k, month_end, max(d) AS snapshot FROM d WHERE month_end - d <= 20 GROUP BY 1, 2)
SELECT k, month_end, snapshot FROM s LEFT JOIN n USING (k, month_end)
""", dates=("month_end", "snapshot"))
def d26_month_end_snapshots(t: Tables) -> DataFrame:
    i = t.lineitem.select(F.col("l_suppkey").alias("k"), _day("l_shipdate", "d"))
    return joins.month_end_snapshots(i, ["k"], "d", F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"), 20)


@query("""
WITH o AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS d FROM orders), r AS (SELECT min(d) AS lo, max(d) AS hi FROM o),
s AS (SELECT k, last_day(m::DATE) AS month_end FROM (SELECT DISTINCT k FROM o), (SELECT unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, date_trunc('month', hi)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM r))
SELECT s.k, month_end, max(d) AS snapshot FROM s LEFT JOIN o ON o.k = s.k AND d <= month_end AND month_end - d <= 20 GROUP BY 1, 2
""", dates=("month_end", "snapshot"))
def d26_month_end_snapshots_all(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("k"), _day("o_orderdate", "d"))
    first, last = o.agg(F.min("d"), F.max("d")).first()  # two dates
    return joins.month_end_snapshots(o, ["k"], "d", F.lit(first), F.lit(last), 20)


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45 OR l_quantity < 2
""")
def c1_bound_violations(t: Tables) -> DataFrame:
    bounds = t.lineitem.select("l_returnflag").distinct().withColumns({"lo": F.lit(2.0), "hi": F.lit(45.0)})
    return checks.bound_violations(t.lineitem, bounds, ["l_returnflag"], "l_quantity").select("l_orderkey", "l_linenumber")


@query("""
SELECT l_returnflag, count(*) AS n_violations, min(l_quantity) AS min_value, max(l_quantity) AS max_value FROM lineitem WHERE l_quantity > CASE l_returnflag WHEN 'A' THEN 40 WHEN 'N' THEN 45 ELSE 48 END OR l_quantity < 2 GROUP BY 1
""")
def e2_violation_summary(t: Tables) -> DataFrame:
    bounds = t.spark.createDataFrame([("A", 2.0, 40.0), ("N", 2.0, 45.0), ("R", 2.0, 48.0)], "l_returnflag string, lo double, hi double")
    return checks.violation_summary(t.lineitem, F.broadcast(bounds), ["l_returnflag"], "l_quantity")


@query("""
SELECT c_custkey FROM customer WHERE c_acctbal <= 0
""")
def c2_nonpositive(t: Tables) -> DataFrame:
    return checks.nonpositive(t.customer, ["c_acctbal"]).select("c_custkey")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > l_tax
""")
def c3_order_violations(t: Tables) -> DataFrame:
    return checks.order_violations(t.lineitem, [("l_discount", "<=", "l_tax")]).select("l_orderkey", "l_linenumber")


@query("""
SELECT o_custkey, o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1
""", dates=("d",))
def e6_duplicates(t: Tables) -> DataFrame:
    return checks.duplicates(t.orders.select("o_custkey", _day("o_orderdate", "d")), ["o_custkey", "d"])


@query("""
WITH x AS (SELECT *, max(l_shipdate::DATE) OVER (PARTITION BY l_suppkey) AS latest FROM lineitem)
SELECT l_suppkey, latest, count(DISTINCT l_returnflag) AS n_l_returnflag, count(DISTINCT l_linenumber) AS n_l_linenumber FROM x WHERE l_shipdate::DATE = latest GROUP BY 1, 2
""", dates=("latest",))
def e9_grid_on_latest(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("d", _day("l_shipdate"))
    return checks.grid_on_latest(li, ["l_suppkey"], "d", ["l_returnflag", "l_linenumber"])


_WEEKDAYS = "(SELECT count(*) FROM generate_series(latest + INTERVAL 1 DAY, TIMESTAMP '2000-01-03', INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6)"


@query(f"""
WITH s AS (SELECT o_custkey, max(o_orderdate::DATE) AS latest FROM orders GROUP BY 1)
SELECT o_custkey, latest, {_WEEKDAYS} AS days_behind FROM s WHERE latest < DATE '2000-01-03'
""", dates=("latest",))
def i7_business_days_behind(t: Tables) -> DataFrame:
    late = t.orders.groupBy("o_custkey").agg(F.max(_day("o_orderdate")).alias("latest")).where("latest < date'2000-01-03'")
    out = calendars.business_days_behind(late, "latest", F.lit("2000-01-03").cast("date"))
    return out.select("o_custkey", "latest", F.col("days_behind").cast("long").alias("days_behind"))


@query(f"""
WITH s AS (SELECT o_custkey, c_mktsegment, n_name, max(o_orderdate::DATE) AS latest FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
b AS (SELECT *, {_WEEKDAYS} AS days_behind FROM s WHERE latest < DATE '2000-01-03')
SELECT 'c_mktsegment' AS dim, c_mktsegment AS code, count(*) AS n_keys, count(*) FILTER (days_behind > 400) AS n_stale, max(days_behind) AS worst FROM b GROUP BY 2
UNION ALL SELECT 'n_name', n_name, count(*), count(*) FILTER (days_behind > 400), max(days_behind) FROM b GROUP BY 2
""")
def e11_staleness_rollup(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stale = checks.staleness(o, "o_custkey", ["c_mktsegment", "n_name"], "o_orderdate", lambda d: calendars.weekdays_between(d, F.lit("2000-01-03").cast("date"))).where("latest < date'2000-01-03'")
    return checks.stale_rollup(stale, ["c_mktsegment", "n_name"], 400).withColumn("worst", F.col("worst").cast("long"))


@query("""
SELECT o_orderpriority, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2
""")
def e21_monthly_sum(t: Tables) -> DataFrame:
    return checks.monthly_sum(t.orders, ["o_orderpriority"], "o_orderdate", "o_totalprice").select("o_orderpriority", F.date_format("month", "yyyy-MM-dd").alias("month"), _r("total", 2))


@query("""
WITH c AS (SELECT l_suppkey, l_shipdate::DATE AS modal_date, count(*) AS n_rows, sum(l_quantity) AS sum_a, sum(l_extendedprice) AS sum_b FROM lineitem GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n_rows DESC, modal_date DESC) AS i FROM c)
SELECT l_suppkey, modal_date, n_rows, round(sum_a, 2) AS sum_a, round(sum_b, 2) AS sum_b FROM n WHERE i = 1
""", dates=("modal_date",))
def e19_modal_date(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("d", _day("l_shipdate"))
    return checks.modal_date_sum(li, ["l_suppkey"], "d", "l_quantity", "l_extendedprice").select("l_suppkey", "modal_date", "n_rows", _r("sum_a", 2), _r("sum_b", 2))


@query("""
SELECT o_custkey, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS F, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS O, round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS P FROM orders GROUP BY 1
""")
def e34_pivot(t: Tables) -> DataFrame:
    sums = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    return series.long_to_wide(sums, ["o_custkey"], "o_orderstatus", "v", ["F", "O", "P"]).select("o_custkey", _r("F", 2), _r("O", 2), _r("P", 2))


@query("""
SELECT l_orderkey, l_linenumber, series, round(value, 4) AS value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME series VALUE value)
""")
def h10_melt(t: Tables) -> DataFrame:
    return series.wide_to_long(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"]).withColumn("value", F.round("value", 4))


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '5-LOW')
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'matched' END AS status FROM a FULL JOIN b ON a.k = b.k
""")
def h4_compare_sets(t: Tables) -> DataFrame:
    of = lambda p: t.orders.where(F.col("o_orderpriority") == p).select(F.col("o_custkey").alias("k"))
    return series.compare_sets(of("1-URGENT"), of("5-LOW"), "k")


@query("""
SELECT o_orderdate::DATE AS d, count(DISTINCT o_orderpriority) AS n_said FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) < (SELECT count(DISTINCT o_orderpriority) FROM orders)
""", dates=("d",))
def h6_disagreements(t: Tables) -> DataFrame:
    return series.disagreements(t.orders.select(_day("o_orderdate", "d"), "o_orderpriority"), ["d"], "o_orderpriority").select("d", F.size("said").cast("long").alias("n_said"))


@query("""
WITH d AS (SELECT o_orderdate::DATE AS d FROM orders GROUP BY 1 HAVING count(*) >= 6)
SELECT g::DATE AS d, isodow(g) - 1 AS weekday, isodow(g) >= 6 AS is_weekend FROM generate_series(DATE '1994-01-01', DATE '1996-12-31', INTERVAL 1 DAY) t(g) WHERE g::DATE NOT IN (SELECT d FROM d)
""", dates=("d",))
def h12_spine_without(t: Tables) -> DataFrame:
    spine = series.date_spine(t.spark, "1994-01-01", "1996-12-31")
    taken = t.orders.groupBy(_day("o_orderdate", "d")).count().where("count >= 6").select("d")
    return spine.join(taken.distinct(), "d", "left_anti").select("d", F.col("weekday").cast("long").alias("weekday"), "is_weekend")


@query("""
WITH off AS (SELECT DISTINCT s_nationkey AS k, l_shipdate::DATE AS d FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus = 'F' AND l_returnflag = 'R'), s AS (SELECT n_nationkey AS k, n_name AS calendar, unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS d FROM nation),
x AS (SELECT calendar, s.d, isodow(s.d) >= 6 AS is_weekend, off.d IS NOT NULL AS is_holiday FROM s LEFT JOIN off ON s.k = off.k AND s.d = off.d)
SELECT calendar, d, is_weekend, is_holiday, NOT is_weekend AND NOT is_holiday AS is_trading, sum((NOT is_weekend AND NOT is_holiday)::INT) OVER (PARTITION BY calendar ORDER BY d)::BIGINT AS trading_no FROM x
""", dates=("d",))
def i2_trading_days(t: Tables) -> DataFrame:
    cal = t.nation.select(F.col("n_name").alias("calendar"), F.lit("5,6").alias("weekend"))
    shipped = t.lineitem.where("l_linestatus = 'F' and l_returnflag = 'R'").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    off = shipped.select(F.col("n_name").alias("calendar"), _day("l_shipdate", "holiday_date"))
    days = calendars.trading_days(cal, off, F.lit("1995-01-01").cast("date"), F.lit("2001-12-31").cast("date"))
    return days.select("calendar", "d", "is_weekend", "is_holiday", "is_trading", F.col("trading_no").cast("long").alias("trading_no"))


@query("""
WITH off AS (SELECT DISTINCT l_suppkey AS calendar, l_shipdate::DATE AS d FROM lineitem), r AS (SELECT min(d) AS lo, max(d) AS hi FROM off),
s AS (SELECT calendar, g::DATE AS d FROM (SELECT DISTINCT calendar FROM off), (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS g FROM r)),
x AS (SELECT s.calendar, s.d, isodow(s.d) >= 6 AS is_weekend, off.d IS NOT NULL AS is_holiday FROM s LEFT JOIN off ON s.calendar = off.calendar AND s.d = off.d)
SELECT calendar, d, is_weekend, is_holiday, NOT is_weekend AND NOT is_holiday AS is_trading, sum((NOT is_weekend AND NOT is_holiday)::INT) OVER (PARTITION BY calendar ORDER BY d)::BIGINT AS trading_no,
    max(CASE WHEN NOT is_weekend AND NOT is_holiday THEN d END) OVER (PARTITION BY calendar ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_trading,
    min(CASE WHEN NOT is_weekend AND NOT is_holiday THEN d END) OVER (PARTITION BY calendar ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_trading FROM x
""", dates=("d", "last_trading", "next_trading"))
def i2_trading_days_all(t: Tables) -> DataFrame:
    # a calendar for each supplier, whose ship dates are its days off
    off = t.lineitem.select(F.col("l_suppkey").alias("calendar"), _day("l_shipdate", "holiday_date"))
    cal = off.select("calendar").distinct().withColumn("weekend", F.lit("5,6"))
    first, last = off.agg(F.min("holiday_date"), F.max("holiday_date")).first()  # two dates
    days = calendars.trading_days(cal, off, F.lit(first), F.lit(last))
    return calendars.neighbours(days).select("calendar", "d", "is_weekend", "is_holiday", "is_trading", F.col("trading_no").cast("long").alias("trading_no"), "last_trading", "next_trading")


@query("""
WITH v AS (SELECT c_nationkey AS k, c_custkey AS vintage, c_acctbal AS x FROM customer), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY vintage DESC) AS i FROM v)
SELECT k, vintage, round(x, 4) AS x FROM n WHERE i = 1
""")
def f4_latest_belief(t: Tables) -> DataFrame:
    v = t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("vintage"), F.col("c_acctbal").alias("x"))
    return series.latest_belief(v, ["k"], "vintage").select("k", "vintage", _r("x", 4))


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    money = F.col("o_totalprice").cast("decimal(18,2)")
    target = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", money.alias("price"), "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 4 == 0, money + 1).otherwise(money)
    source = t.orders.where("o_orderkey % 2 = 1 or o_orderkey % 3 = 0").select("o_orderkey", changed.cast("decimal(18,2)").alias("price"), F.lit("X").alias("o_orderstatus"))
    return target, source


@query("""
WITH t AS (SELECT o_orderkey AS k, o_totalprice::DECIMAL(18,2) AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_totalprice::DECIMAL(18,2) + 1 ELSE o_totalprice::DECIMAL(18,2) END AS p FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0)
SELECT coalesce(t.k, s.k) AS o_orderkey, CASE WHEN t.k IS NULL THEN s.p ELSE coalesce(s.p, t.p) END::DOUBLE AS price, CASE WHEN t.k IS NULL THEN 'X' ELSE t.s END AS o_orderstatus,
    CASE WHEN t.k IS NULL THEN 'inserted' WHEN s.p IS NOT NULL AND s.p <> t.p THEN 'updated' ELSE 'kept' END AS _action FROM t FULL JOIN s ON t.k = s.k
""")
def j1_merge_upsert(t: Tables) -> DataFrame:
    target, source = _merge_sides(t)
    out = writes.merge_upsert(target, source, writes.MergeSpec(["o_orderkey"], ["price"], insert_only=["o_orderstatus"]))
    return out.withColumn("price", F.col("price").cast("double"))


@query("""
WITH e AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN 2 ELSE 0 END AS vintage, o_totalprice::DECIMAL(18,2) AS v FROM orders WHERE o_orderkey % 2 = 0),
i AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_totalprice::DECIMAL(18,2) + 1 ELSE o_totalprice::DECIMAL(18,2) END AS v FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0)
SELECT i.k, i.v::DOUBLE AS v, CASE WHEN i.v IS NULL OR (e.k IS NOT NULL AND e.v = i.v) THEN 'skip' WHEN e.k IS NULL THEN 'new' ELSE 'revision' END AS _action,
    CASE WHEN i.v IS NULL OR (e.k IS NOT NULL AND e.v = i.v) THEN -1 WHEN e.k IS NULL THEN 0 ELSE e.vintage + 1 END AS vintage FROM i LEFT JOIN e ON i.k = e.k
""")
def j3_vintage_load(t: Tables) -> DataFrame:
    target, source = _merge_sides(t)
    existing = target.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 6 == 0, 2).otherwise(0).alias("vintage"), F.col("price").alias("v"))
    incoming = source.select(F.col("o_orderkey").alias("k"), F.col("price").alias("v"), F.lit("2024-01-01").cast("date").alias("release"))
    out = writes.vintage_load(existing, incoming, ["k"], "v", "release")
    return out.select("k", F.col("v").cast("double").alias("v"), "_action", F.coalesce("vintage", F.lit(-1)).alias("vintage"))


@query("""
WITH e AS (SELECT n_name AS k, n_nationkey + 1 AS id FROM nation WHERE n_nationkey % 2 = 0), f AS (SELECT n_name AS k, (SELECT max(id) FROM e) + row_number() OVER (ORDER BY n_name) AS id FROM nation WHERE n_nationkey % 2 = 1)
SELECT k, id, false AS is_new FROM e UNION ALL SELECT k, id, true FROM f
""")
def j4_seed_dimension(t: Tables) -> DataFrame:
    existing = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("k"), (F.col("n_nationkey") + 1).alias("id"))
    return writes.seed_dimension(existing, t.nation.select(F.col("n_name").alias("k")), "k")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN NOT (l_discount > 0.08 OR l_tax > 0.07) THEN l_extendedprice END AS l_extendedprice FROM lineitem WHERE NOT (l_quantity >= 50)
""")
def j7_clean(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("rid", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    rules = [
        writes.CleaningRule("big", "delete", lambda d: d.where("l_quantity >= 50")),
        writes.CleaningRule("discount", "null", lambda d: d.where("l_discount > 0.08")),
        writes.CleaningRule("tax", "null", lambda d: d.where("l_tax > 0.07")),
    ]
    cleaned, _ = writes.clean(li, "rid", rules, ["l_extendedprice"])
    return cleaned.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""
WITH f AS (SELECT l_orderkey || ':' || l_linenumber AS i, 'discount' AS rule FROM lineitem WHERE l_discount > 0.05 UNION SELECT l_orderkey || ':' || l_linenumber, 'tax' FROM lineitem WHERE l_tax > 0.05 UNION SELECT l_orderkey || ':' || l_linenumber, 'big' FROM lineitem WHERE l_quantity > 45),
n AS (SELECT *, count(*) OVER (PARTITION BY i) AS n FROM f)
SELECT rule, count(*) AS total, count(*) FILTER (n = 1) AS unique_rows, count(*) FILTER (n > 1) AS overlap FROM n GROUP BY 1
""")
def e31_rule_overlap(t: Tables) -> DataFrame:
    rid = F.concat_ws(":", "l_orderkey", "l_linenumber").alias("i")
    flagged = [t.lineitem.where(w).select(rid, F.lit(r).alias("rule")) for r, w in (("discount", "l_discount > 0.05"), ("tax", "l_tax > 0.05"), ("big", "l_quantity > 45"))]
    return checks.rule_overlap(flagged[0].unionByName(flagged[1]).unionByName(flagged[2]), "rule", "i")


@query("""
SELECT p_partkey, upper(regexp_replace(regexp_replace(upper(p_name), '[^A-Z0-9]+', '_', 'g'), '^_|_$', '', 'g')) AS slug FROM part
""")
def b7_slug(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", parse.slug(F.col("p_name"), 400).alias("slug"))


@query("""
SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE AS monday, (date_trunc('month', o_orderdate) - INTERVAL 1 MONTH)::DATE AS prior, strftime(o_orderdate, '%Y-%m') AS m FROM orders
""", dates=("monday", "prior"))
def b19_calendar_keys(t: Tables) -> DataFrame:
    d = _day("o_orderdate")
    return t.orders.select("o_orderkey", parse.week_monday(d).alias("monday"), parse.prior_month(d).alias("prior"), parse.month_key(d).alias("m"))


@query("""
SELECT o_orderkey, make_date(CASE WHEN k % 4 = 0 THEN y END, 1, 1) AS annual, make_date(y, q * 3 - 2, 1) AS quarterly, last_day(make_date(y, m, 1)) AS monthly FROM (
    SELECT o_orderkey, o_orderkey AS k, year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, month(o_orderdate)::INT AS m FROM orders)
""", dates=("annual", "quarterly", "monthly"))
def b2_periods(t: Tables) -> DataFrame:
    y = F.year("o_orderdate").cast("string")
    return t.orders.select(
        "o_orderkey",
        parse.period_to_date(F.when(F.col("o_orderkey") % 4 == 0, y).otherwise("bad"), "sdmx").alias("annual"),
        parse.period_to_date(F.concat(y, F.lit("-Q"), F.quarter("o_orderdate").cast("string")), "sdmx").alias("quarterly"),
        parse.period_to_date(F.concat(y, F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")), "bea", "end").alias("monthly"),
    )


@query("""
SELECT o_orderkey, round(o_totalprice, 2) AS v, CASE WHEN o_orderkey % 2 = 0 THEN -round(o_totalprice, 2) ELSE round(o_totalprice, 2) END AS paren FROM orders
""")
def b3_numbers(t: Tables) -> DataFrame:
    shown = F.format_number("o_totalprice", 2)
    paren = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)
    return t.orders.select("o_orderkey", parse.parse_number(shown).alias("v"), parse.parse_number(paren, paren_negative=True).alias("paren"))


@query("""
SELECT o_orderkey, CASE WHEN month(d) % 3 = 0 AND isodow(d) = 3 AND day(d) BETWEEN 15 AND 21 THEN true ELSE false END AS is_imm FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
""")
def b31_imm(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", parse.is_imm_date(_day("o_orderdate")).alias("is_imm"))


@query("""
SELECT source, count(*) AS n_docs, min(doc_id) AS first_date, max(doc_id) AS last_date FROM documents GROUP BY 1 HAVING count(*) >= 5
""")
def n3_vendor_counts(t: Tables) -> DataFrame:
    return documents.vendor_counts(t.documents, "source", "doc_id", 5)


@query("""
WITH h AS (SELECT doc_id, source, sha256(text) AS h FROM documents), s AS (SELECT * FROM h WHERE doc_id % 2 = 0)
SELECT i.doc_id, CASE WHEN i.h IN (SELECT h FROM s) THEN 'content' END AS dropped_by FROM h i WHERE doc_id % 2 = 1
""")
def n4_dedup_gates(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return documents.dedup_gates(d.where("doc_id % 2 = 1"), d.where("doc_id % 2 = 0"), {"content": ["h"]}).select("doc_id", "dropped_by")


@query("""
SELECT doc_id, i AS chunk_index, i * 900 AS start, substring(text, i * 900 + 1, 1000) AS chunk_text FROM documents, generate_series(0, greatest(length(text) - 101, 0)::BIGINT // 900) g(i) WHERE text IS NOT NULL
""")
def n6_chunks(t: Tables) -> DataFrame:
    return documents.chunk(t.documents, "doc_id", "text").withColumns({"chunk_index": F.col("chunk_index").cast("long"), "start": F.col("start").cast("long")})


@query("""
WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1), s AS (SELECT label, vec_id, list_cosine_similarity(embedding::DOUBLE[], q) AS score FROM embeddings, q WHERE vec_id % 3 <> 0),
f AS (SELECT * FROM s WHERE score >= 0 ORDER BY score DESC, label, vec_id LIMIT 20)
SELECT label AS report_id, round(max(score), 6) AS best_score, arg_max(vec_id, (score, -vec_id)) AS best_page, count(*) AS n_chunks FROM f GROUP BY 1 ORDER BY max(score) DESC, 1 LIMIT 5
""")
def n1_semantic_search(t: Tables) -> DataFrame:
    first = t.embeddings.orderBy("vec_id").select("embedding").first()[0]  # one query vector
    chunks = t.embeddings.select(F.col("label").alias("report_id"), F.col("vec_id").alias("page"), F.col("embedding").alias("vector"))
    return documents.semantic_search(chunks, list(first), 5, where=F.col("page") % 3 != 0).select("report_id", _r("best_score"), "best_page", "n_chunks")


@query("""
SELECT page_id, i - 1 AS item, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)[i] AS href, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)[i] AS label
FROM pages, generate_series(1, len(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1))) g(i)
""")
def n10_html_items(t: Tables) -> DataFrame:
    return documents.html_items(t.pages, "page_id", "html", '<a href="([^"]*)">([^<]*)</a>', ["href", "label"]).withColumn("item", F.col("item").cast("long"))


@query(r"""
WITH t AS (SELECT source, lang, doc_id, regexp_extract(lower(split_part(text, '.', 1)), '(?:#|\b(?:issue|no|nr|vol|volume|edition|number|part)\b\.?\s*#?)\s*(\d+)', 1) AS serial, string_split(lower(regexp_replace(split_part(text, '.', 1), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
u AS (SELECT source, lang, doc_id, serial, list_sort(list_distinct(list_filter(w, lambda x: length(x) > 1 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ('fwd', 'fw', 're', 'daily', 'weekly', 'monthly', 'the', 'and', 'of')))) AS w FROM t),
n AS (SELECT source, lang, w, serial, min(doc_id) AS node FROM u WHERE len(w) > 0 GROUP BY ALL),
p AS (SELECT x.source, x.node AS a, y.node AS b, len(list_intersect(x.w, y.w)) AS shared, len(x.w) AS na, len(y.w) AS nb FROM n x JOIN n y ON x.source = y.source AND x.lang = y.lang AND x.node < y.node AND (x.serial = y.serial OR x.serial = '' OR y.serial = ''))
SELECT source, a, b, shared, round(shared / (na + nb - shared), 6) AS jaccard FROM p WHERE shared / (na + nb - shared) >= 0.6 OR shared >= 3 AND shared = least(na, nb)
UNION ALL SELECT n.source, node, doc_id, len(n.w), 1.0 FROM u JOIN n ON u.source = n.source AND u.lang = n.lang AND u.w = n.w AND u.serial = n.serial AND doc_id <> node
""")
def n5_title_twins(t: Tables) -> DataFrame:
    titles = t.documents.select("source", "lang", "doc_id", F.substring_index("text", ".", 1).alias("title"))
    return documents.title_twins(titles, ["source", "lang"], "doc_id", "title").select("source", "a", "b", "shared", _r("jaccard"))


@query(rf"""
WITH t AS (SELECT source, doc_id AS id, DATE '2024-01-01' + (doc_id % 60)::INT AS d, split_part(text, '.', 1) AS title FROM documents WHERE text IS NOT NULL),
b AS (SELECT 1 AS side, source, id, d, 'Desk Notes: ' || title AS title FROM t UNION ALL SELECT 2, source, id, d, title FROM t),
c AS (SELECT *, regexp_extract(title, '(?s)^.*?(?:\s*[:|]\s+|\s+[-–—]\s+)(.*)$', 1) AS core, regexp_extract(lower(title), '(?:#|\b(?:issue|no|nr|vol|volume|edition|number|part)\b\.?\s*#?)\s*(\d+)', 1) AS serial FROM b),
f AS (SELECT *, ' ' || trim(regexp_replace(lower(title), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' AS spelt, list_filter(list_distinct(string_split(lower(regexp_replace(title, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')), lambda x: length(x) > 1 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN {documents.TITLE_STOP}) AS w,
    CASE WHEN core <> '' THEN list_filter(list_distinct(string_split(lower(regexp_replace(core, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')), lambda x: length(x) > 1 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN {documents.TITLE_STOP}) END AS k FROM c),
p AS (SELECT x.id, y.id AS twin, abs(x.d - y.d) AS away, len(list_intersect(x.w, y.w)) AS n, len(x.w) AS nx, len(y.w) AS ny, x.serial AS sx, y.serial AS sy, length(y.spelt) - 2 >= 12 AND contains(x.spelt, y.spelt) AS verbatim,
    CASE WHEN x.k IS NOT NULL AND y.k IS NOT NULL THEN x.k WHEN x.k IS NOT NULL THEN x.k WHEN y.k IS NOT NULL THEN x.w END AS kx, CASE WHEN x.k IS NOT NULL AND y.k IS NOT NULL THEN y.k WHEN x.k IS NOT NULL THEN y.w WHEN y.k IS NOT NULL THEN y.k END AS ky
    FROM f x JOIN f y ON x.side = 1 AND y.side = 2 AND x.source = y.source AND x.id <> y.id AND abs(x.d - y.d) <= 3 WHERE len(y.w) > 0 AND len(x.w) > 0),
s AS (SELECT *, len(list_intersect(kx, ky)) AS nk FROM p),
r AS (SELECT id, twin, away, CASE WHEN sx <> sy AND sx <> '' AND sy <> '' THEN 0 WHEN verbatim OR n >= 3 AND n = ny THEN 1 ELSE greatest(CASE WHEN n >= 3 THEN n / (nx + ny - n) ELSE 0 END, CASE WHEN nk >= 3 THEN nk / (len(kx) + len(ky) - nk) ELSE 0 END) END AS score FROM s)
SELECT id, twin, round(score, 6) AS score FROM r WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, away, twin) = 1
""")
def n5_title_matches(t: Tables) -> DataFrame:
    """Every document as a note with a masthead before its title, matched with the titles of all documents of its source."""
    titles = t.documents.select("source", "doc_id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")).alias("d"), F.substring_index("text", ".", 1).alias("title"))
    notes = titles.withColumn("title", F.concat(F.lit("Desk Notes: "), "title"))
    return documents.title_matches(notes, titles, ["source"], "doc_id", "d", "title").select("id", "twin", _r("score"))
