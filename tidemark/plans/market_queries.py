"""Queries over ``events``, read as a tick stream: user_id is the symbol's number, event_type the series, value the price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import checks, joins, prediction, series
from tidemark.plans.registry import ORACLE_SQL, Tables, query, stamp

_S = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


@query("""
WITH e AS (SELECT max(ts) AS fin FROM events),
pool AS (SELECT event_type, value FROM events, e WHERE ts >= fin::DATE - INTERVAL 3 MONTH AND value IS NOT NULL),
med AS (SELECT event_type, quantile_cont(value, 0.5) AS med, count(*) AS n FROM pool GROUP BY 1 HAVING count(*) >= 100),
mad AS (SELECT event_type, med, n, quantile_cont(abs(value - med), 0.5) AS mad FROM pool JOIN med USING (event_type) GROUP BY ALL)
SELECT event_id, event_type, round(value, 6) AS value, round((value - med) / (mad * 1.4826), 6) AS robust_z, n AS n_obs
FROM events JOIN mad USING (event_type) WHERE mad > 0 AND abs((value - med) / (mad * 1.4826)) > 3
""")
def k5_robust_outlier(t: Tables) -> DataFrame:
    out = series.robust_outliers(t.events, ["event_type"], "ts", "value", months=3, n_mad=3.0, min_obs=100)
    return out.select("event_id", "event_type", _r("value"), _r("robust_z"), "n_obs")


@query("""
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS med, round(quantile_cont(value, 0.9), 6) AS p90, count(value) AS n FROM events GROUP BY 1
""")
def e5_large_group_quantiles(t: Tables) -> DataFrame:
    med = series.group_quantile(t.events, ["event_type"], "value", 0.5, "med")
    return med.join(series.group_quantile(t.events, ["event_type"], "value", 0.9, "p90").drop("n"), "event_type").select("event_type", _r("med"), _r("p90"), "n")


@query(ORACLE_SQL["k5_robust_outlier"])
def k5_robust_large_groups(t: Tables) -> DataFrame:
    out = series.robust_outliers(t.events, ["event_type"], "ts", "value", months=3, n_mad=3.0, min_obs=100, large_groups=True)
    return out.select("event_id", "event_type", _r("value"), _r("robust_z"), "n_obs")


@query("""
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY 1 HAVING stddev_samp(value) > 0)
SELECT event_id, event_type, round((value - m) / sd, 6) AS z FROM events JOIN s USING (event_type) WHERE abs((value - m) / sd) > 2.5
""")
def k4_sigma_outliers(t: Tables) -> DataFrame:
    return checks.sigma_outliers(t.events, ["event_type"], "value", 2.5).select("event_id", "event_type", _r("z"))


@query("""
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min_value,
    round(max(value), 6) AS max_value, round(quantile_cont(value, 0.01), 6) AS p1, round(quantile_cont(value, 0.25), 6) AS p25,
    round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY 1
""")
def k3_distribution(t: Tables) -> DataFrame:
    out = checks.distribution(t.events, ["event_type"], "value")
    return out.select("event_type", "n", *[_r(c) for c in out.columns[2:]])


@query("""
WITH p AS (SELECT user_id, event_type, ts, event_id, value, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS b FROM events),
x AS (SELECT event_type, (value - b) / nullif(b, 0) AS ret FROM p)
SELECT event_type, count(ret) AS n, round(avg(ret), 4) AS mean, round(quantile_cont(ret, 0.05), 4) AS p5, round(quantile_cont(ret, 0.5), 4) AS p50, round(quantile_cont(ret, 0.95), 4) AS p95
FROM x WHERE ret IS NOT NULL GROUP BY 1
""")
def e4_return_distribution(t: Tables) -> DataFrame:
    ordered = t.events.withColumn("at", F.struct("ts", "event_id"))
    before = F.lag("value").over(series._w(["user_id", "event_type"], "at"))
    returns = ordered.withColumn("ret", (F.col("value") - before) / F.nullif(before, F.lit(0.0))).where("ret is not null")
    out = checks.distribution(returns, ["event_type"], "ret", (0.05, 0.5, 0.95))
    return out.select("event_type", "n", _r("mean", 4), _r("p5", 4), _r("p50", 4), _r("p95", 4))


@query(f"""
WITH p AS (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS b FROM events)
SELECT event_id, user_id, event_type, {_S.format('ts')}, round((value - b) / abs(b) * 100, 4) AS pct_change FROM p
WHERE abs(b) > 1e-12 AND abs((value - b) / abs(b) * 100) > 500
""")
def f1_pct_change(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    return series.pct_change(e, ["user_id", "event_type"], "at", "value", threshold=500.0).select("event_id", "user_id", "event_type", stamp("ts"), _r("pct_change", 4))


@query(f"""
SELECT event_id, user_id, event_type, {_S.format('ts')}, round(value, 6) AS value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1
""")
def f2_keep_latest(t: Tables) -> DataFrame:
    out = series.keep_one(t.events, ["user_id", "event_type"], F.desc("ts"), F.desc("event_id"))
    return out.select("event_id", "user_id", "event_type", stamp("ts"), _r("value"))


@query("""
SELECT user_id, ts::DATE AS mark_date, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2
""", dates=("mark_date",))
def f3_last_mark_of_day(t: Tables) -> DataFrame:
    return series.last_mark_of_day(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts").select("user_id", "mark_date", "event_id")


@query(f"""
WITH d AS (SELECT DISTINCT event_type, ts FROM events), g AS (SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS next_ts FROM d)
SELECT event_type, {_S.format('ts')}, {_S.format('next_ts')}, round(epoch_us(next_ts - ts) / 3.6e9, 6) AS gap_hours FROM g WHERE epoch_us(next_ts - ts) / 3.6e9 > 2
""")
def f5_gaps(t: Tables) -> DataFrame:
    return series.gaps(t.events, ["event_type"], "ts", 2.0).select("event_type", stamp("ts"), stamp("next_ts"), _r("gap_hours"))


@query("""
WITH h AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS hour FROM events),
o AS (SELECT * FROM h WHERE CASE isodow(hour) WHEN 7 THEN hour(hour) >= 21 WHEN 5 THEN hour(hour) < 21 WHEN 6 THEN false ELSE true END),
s AS (SELECT event_type, count(*) AS actual_hours, min(hour) AS a, max(hour) AS b FROM o GROUP BY 1),
x AS (SELECT *, (SELECT count(*) FROM generate_series(a, b, INTERVAL 1 HOUR) g(hour) WHERE CASE isodow(hour) WHEN 7 THEN hour(hour) >= 21 WHEN 5 THEN hour(hour) < 21 WHEN 6 THEN false ELSE true END) AS expected_hours FROM s)
SELECT event_type, strftime(a, '%Y-%m-%d %H:%M:%S') AS first_hour, strftime(b, '%Y-%m-%d %H:%M:%S') AS last_hour, actual_hours, expected_hours,
    round(actual_hours * 100.0 / greatest(expected_hours, 1), 2) AS coverage_pct FROM x
""")
def e10_market_hours_coverage(t: Tables) -> DataFrame:
    out = checks.hourly_coverage(t.events, ["event_type"], "ts", parse.is_fx_open)
    return out.select("event_type", stamp("first_hour"), stamp("last_hour"), "actual_hours", "expected_hours", F.col("coverage_pct").cast("double").alias("coverage_pct"))


@query("""
SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bar_ts, round(arg_min(value, (ts, value)), 6) AS open_px, round(max(value), 6) AS high_px,
    round(min(value), 6) AS low_px, round(arg_max(value, (ts, value)), 6) AS close_px, round(avg(value), 6) AS mean_px,
    round(quantile_cont(value, 0.5), 6) AS median_px, count(*) AS n_ticks
FROM events WHERE value IS NOT NULL GROUP BY event_type, date_trunc('hour', ts) HAVING count(*) >= 2
""")
def e16_ohlc_bars(t: Tables) -> DataFrame:
    bars = checks.ohlc_bars(t.events, ["event_type"], "ts", "value", min_ticks=2)
    return bars.select("event_type", stamp("bar_ts"), *[_r(c) for c in ("open_px", "high_px", "low_px", "close_px", "mean_px", "median_px")], "n_ticks")


@query("""
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), r AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' AND value IS NOT NULL GROUP BY 1, 2),
j AS (SELECT l.event_id, r.ts AS rts, r.value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts > r.ts)
SELECT l.event_id, l.user_id, CASE WHEN epoch_us(l.ts) - epoch_us(rts) <= 5 * 86400000000 THEN strftime(rts, '%Y-%m-%d %H:%M:%S') END AS asof_ts,
    CASE WHEN epoch_us(l.ts) - epoch_us(rts) <= 5 * 86400000000 THEN round(j.value, 6) END AS asof_value FROM l JOIN j USING (event_id)
""")
def d7_asof_join(t: Tables) -> DataFrame:
    left = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    out = joins.asof_join(left, t.events.where("event_type = 'click'"), ["user_id"], "ts", "value", 5 * 86_400)
    return out.select("event_id", "user_id", stamp("asof_ts"), _r("asof_value"))


@query("""
WITH e AS (SELECT event_type, date_trunc('hour', ts) AS ts, max(value) AS value FROM events GROUP BY 1, 2),
a AS (SELECT e.event_type, e.ts, e.value, p.value AS v6, p.ts AS t6 FROM e ASOF LEFT JOIN e p ON e.event_type = p.event_type AND e.ts - INTERVAL 6 HOUR >= p.ts),
b AS (SELECT a.*, q.value AS v24, q.ts AS t24 FROM a ASOF LEFT JOIN e q ON a.event_type = q.event_type AND a.ts - INTERVAL 24 HOUR >= q.ts)
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(value, 6) AS value, round(CASE WHEN ts - INTERVAL 6 HOUR - t6 <= INTERVAL 7 DAY THEN v6 END, 6) AS value_6h,
    round(CASE WHEN ts - INTERVAL 24 HOUR - t24 <= INTERVAL 7 DAY THEN v24 END, 6) AS value_24h FROM b
""")
def d8_asof_lags(t: Tables) -> DataFrame:
    hourly = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(F.max("value").alias("value"))
    return joins.asof_lags(hourly, ["event_type"], "ts", "value", [6, 24]).select("event_type", stamp("ts"), _r("value"), _r("value_6h"), _r("value_24h"))


@query("""
WITH d AS (SELECT DISTINCT event_type, date_trunc('day', ts) AS ts FROM events)
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(lag(ts) OVER (PARTITION BY event_type ORDER BY ts), '%Y-%m-%d %H:%M:%S') AS prior_ts FROM d
""")
def d9_previous_snapshot(t: Tables) -> DataFrame:
    daily = t.events.select("event_type", F.date_trunc("day", "ts").alias("ts"))
    return joins.previous_snapshot(daily, ["event_type"], "ts").select("event_type", stamp("ts"), stamp("prior_ts"))


@query("""
WITH h AS (SELECT event_type, ts::DATE AS d, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT a.d, round(a.v, 6) AS base_value, round(b.v, 6) AS other_value, round(b.v - a.v, 6) AS basis FROM h a JOIN h b ON a.d = b.d AND a.event_type = 'click' AND b.event_type = 'view'
""", dates=("d",))
def d5_series_basis(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.avg("value").alias("v"))
    return joins.series_basis(daily, ["d"], "event_type", "v", "click", "view").select("d", _r("base_value"), _r("other_value"), _r("basis"))


@query("""
WITH h AS (SELECT event_type, ts::DATE AS d, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT a.d, round(a.v / nullif(b.v, 0), 6) AS ratio FROM h a JOIN h b ON a.d = b.d AND a.event_type = 'click' AND b.event_type = 'view'
""", dates=("d",))
def d20_ratio(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.avg("value").alias("v"))
    return joins.ratio(daily.where("event_type = 'click'"), daily.where("event_type = 'view'"), ["d"], "v").select("d", _r("ratio"))


@query("""
WITH a AS (SELECT date_trunc('hour', ts) AS h, sum(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1), b AS (SELECT date_trunc('hour', ts) AS h, sum(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT strftime(coalesce(a.h, b.h), '%Y-%m-%d %H:%M:%S') AS h, round(a.v, 4) AS left_value, round(b.v, 4) AS right_value, round(a.v - b.v, 4) AS balance FROM a FULL JOIN b ON a.h = b.h
""")
def d21_balance(t: Tables) -> DataFrame:
    hourly = lambda kind: t.events.where(F.col("event_type") == kind).groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.sum("value").alias("v"))
    return joins.balance(hourly("click"), hourly("view"), ["h"], "v").select(stamp("h"), _r("left_value", 4), _r("right_value", 4), _r("balance", 4))


@query("""
SELECT event_type, ts::DATE AS day, count(*) AS n_rows, list_aggregate(list_sort(list_distinct(list(hour(ts)))), 'string_agg', ',') AS hours, 24 - count(DISTINCT hour(ts)) AS n_missing FROM events GROUP BY 1, 2
""", dates=("day",))
def e13_captured_hours(t: Tables) -> DataFrame:
    out = checks.captured_hours(t.events, ["event_type"], "ts", list(range(24)))
    return out.select("event_type", "day", "n_rows", F.array_join(F.col("hours").cast("array<string>"), ",").alias("hours"), F.size("missing").cast("long").alias("n_missing"))


@query("""
WITH p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events), c AS (SELECT *, round(value - b, 9) AS move FROM p)
SELECT event_id, round(move, 6) AS move, CASE WHEN move IS NULL THEN 'NEW' WHEN abs(value - b) >= 10 THEN 'BIG' WHEN abs(value - b) >= 5 THEN 'MID' WHEN abs(value - b) >= 1 THEN 'SMALL' ELSE 'FLAT' END AS move_class FROM c
""")
def f8_move_classes(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    return series.classify_moves(e, ["user_id"], "at", "value", big=10, mid=5, small=1).select("event_id", _r("move"), "move_class")


@query("""
WITH s AS (SELECT event_id, user_id, ts, CAST(floor(value / 20) AS BIGINT) AS v FROM events), f AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR v IS DISTINCT FROM lag(v) OVER w THEN 1 ELSE 0 END AS n FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f), d AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS dwell FROM r)
SELECT event_id, user_id, v, dwell FROM d WHERE n = 1
""")
def f7_compress_steps(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", F.struct("ts", "event_id").alias("at"), F.floor(F.col("value") / 20).alias("v"))
    return series.compress_steps(e, ["user_id"], "at", "v").select("event_id", "user_id", "v", "dwell")


@query("""
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER b AS t0,
    first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER a AS t1 FROM e
    WINDOW b AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, v0 + (v1 - v0) * (epoch_us(ts) - t0) / nullif(t1 - t0, 0), v0), 4) AS filled FROM f
""")
def h1_interpolate(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return series.interpolate(e, ["user_id"], "ts", "v").select("event_id", _r("filled", 4))


@query("""
WITH b AS (SELECT event_id, event_type, ts, value, quantile_cont(CASE WHEN value > 0 THEN value END, 0.5) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS baseline FROM events)
SELECT event_id, round(baseline, 6) AS baseline, round(value / nullif(baseline, 0), 4) AS vol_ratio FROM b
""")
def e26_burst_ratio(t: Tables) -> DataFrame:
    return prediction.burst_ratio(t.events, ["event_type"], "ts", "value", 1).select("event_id", _r("baseline"), _r("vol_ratio", 4))


@query("""
WITH p AS (SELECT *, rank() OVER (PARTITION BY event_type, ts::DATE ORDER BY value DESC, event_id) AS n FROM events)
SELECT event_type, ts::DATE AS d, count(*) AS n_markets, round(max(value), 6) AS modal_price, round(max(value) FILTER (n = 2), 6) AS runner_up, round(sum(value), 4) AS prob_sum, round(sum(value * value), 4) AS hhi FROM p GROUP BY 1, 2
""", dates=("d",))
def e23_event_metrics(t: Tables) -> DataFrame:
    daily = t.events.withColumn("d", F.col("ts").cast("date"))
    out = prediction.event_metrics(daily, ["event_type", "d"], "value", "value")
    return out.select("event_type", "d", "n_markets", _r("modal_price"), _r("runner_up"), _r("prob_sum", 4), _r("hhi", 4))


@query("""
WITH p AS (SELECT event_type, ts::DATE AS d, event_id, value, row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY value DESC, event_id) AS n FROM events)
SELECT event_type, d, event_id, round(value, 6) AS value FROM p WHERE n = 1
""", dates=("d",))
def f16_modal_child(t: Tables) -> DataFrame:
    daily = t.events.withColumn("d", F.col("ts").cast("date"))
    return series.modal_child(daily, ["event_type", "d"], "event_id", "value").select("event_type", "d", "event_id", _r("value"))


@query("""
WITH p AS (SELECT event_type, ts::DATE AS d, event_id, value, row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY value DESC, event_id) AS place FROM events)
SELECT event_type, d, event_id, place FROM p WHERE place BETWEEN 2 AND 6 AND value >= 0.02
""", dates=("d",))
def g6_tail_markets(t: Tables) -> DataFrame:
    daily = t.events.withColumn("d", F.col("ts").cast("date"))
    return prediction.tail_markets(daily, ["event_type", "d"], "event_id", "value").select("event_type", "d", "event_id", F.col("place").cast("long").alias("place"))


@query("""
WITH m AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d, ts, event_id FROM events),
c AS (SELECT *, d - avg(d) OVER (PARTITION BY user_id) AS x FROM m WHERE d IS NOT NULL), l AS (SELECT *, lag(x) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS x1 FROM c)
SELECT user_id, count(*) + 1 AS n_points, round(sqrt(avg(x * x)), 6) AS move_std, round(sum(x * x1) / nullif(sum(x * x), 0), 6) AS autocorr_1 FROM l GROUP BY 1 HAVING count(*) + 1 >= 7
""")
def e25_event_statistics(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    return prediction.event_statistics(e, "user_id", "at", "value").select("user_id", "n_points", _r("move_std"), _r("autocorr_1"))


@query("""
SELECT event_type, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month, round(avg(value), 6) AS level, round((avg(value) / nullif(CASE WHEN lag(date_trunc('month', ts)) OVER w = date_trunc('month', ts) - INTERVAL 1 MONTH THEN lag(avg(value)) OVER w END, 0) - 1) * 100, 4) AS mom_pct
FROM events GROUP BY event_type, date_trunc('month', ts) WINDOW w AS (PARTITION BY event_type ORDER BY date_trunc('month', ts))
""")
def e18_month_on_month(t: Tables) -> DataFrame:
    return checks.month_on_month(t.events, ["event_type"], "ts", "value").select("event_type", F.date_format("month", "yyyy-MM-dd").alias("month"), _r("level"), _r("mom_pct", 4))


@query("""
WITH o AS (SELECT event_type, user_id, ts::DATE AS day, max(value) AS v FROM events WHERE value BETWEEN 1 AND 1000 GROUP BY 1, 2, 3)
SELECT event_type, date_trunc('week', day)::DATE AS week, round(quantile_cont(v, 0.5), 6) AS median_value, count(DISTINCT user_id) AS n_markets FROM o GROUP BY 1, 2 HAVING count(DISTINCT user_id) >= 5
""", dates=("week",))
def e17_weekly_median(t: Tables) -> DataFrame:
    out = checks.weekly_median(t.events, ["event_type"], "user_id", "ts", "value", floor=1.0, cap=1000.0)
    return out.select("event_type", "week", _r("median_value"), "n_markets")


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (value IS NULL) AS n_null, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
    round(epoch_us(TIMESTAMP '2030-01-01' - max(ts)) / 3.6e9, 4) AS age_hours FROM events
""")
def e7_table_facts(t: Tables) -> DataFrame:
    out = checks.table_facts(t.events, "ts", "value", F.lit("2030-01-01").cast("timestamp"))
    return out.select("n_rows", "n_null", _r("min_value"), _r("max_value"), stamp("newest"), _r("age_hours", 4))


@query("""
SELECT event_type, min(ts)::DATE AS first_day, count(*) AS n_rows, count(DISTINCT ts::DATE) AS n_dates, max(ts)::DATE AS last_day FROM events GROUP BY 1
""", dates=("first_day", "last_day",))
def e8_coverage(t: Tables) -> DataFrame:
    return checks.coverage(t.events, ["event_type"], "ts").select("event_type", F.col("first_date").cast("date").alias("first_day"), "n_rows", "n_dates", F.col("last_date").cast("date").alias("last_day"))


@query("""
SELECT c.check_name, (SELECT count(*) FROM events) AS n_rows, c.n AS n_failed, CASE WHEN c.n > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (
    SELECT 'null_value' AS check_name, count(*) FILTER (value IS NULL) AS n FROM events UNION ALL SELECT 'nonpositive', count(*) FILTER (value <= 0) FROM events
    UNION ALL SELECT 'above_limit', count(*) FILTER (value > 100) FROM events) c
""")
def k1_check_suite(t: Tables) -> DataFrame:
    v = F.col("value")
    return checks.run_checks(t.events, {"null_value": v.isNull(), "nonpositive": v <= 0, "above_limit": v > 100})


@query("""
SELECT event_id, CASE WHEN value IS NULL THEN 'null_value' WHEN value <= 1 THEN 'too_small' WHEN user_id % 7 = 0 THEN 'unmapped' END AS reject_reason FROM events
""")
def c14_reject_reasons(t: Tables) -> DataFrame:
    v = F.col("value")
    return checks.with_reject_reason(t.events, {"null_value": v.isNull(), "too_small": v <= 1, "unmapped": F.col("user_id") % 7 == 0}).select("event_id", "reject_reason")


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (value < 5) AS n_low FROM events GROUP BY 1
""")
def e1_conditional_counts(t: Tables) -> DataFrame:
    return checks.conditional_counts(t.events, ["event_type"], {"n_high": F.col("value") > 50, "n_low": F.col("value") < 5})


@query("""
SELECT event_id FROM events WHERE isodow(ts) < 6
""")
def c15_weekdays(t: Tables) -> DataFrame:
    return checks.weekdays_only(t.events, "ts").select("event_id")


@query("""
SELECT event_id, CASE isodow(ts) WHEN 7 THEN hour(ts) >= 21 WHEN 5 THEN hour(ts) < 21 WHEN 6 THEN false ELSE true END AS is_open FROM events
""")
def b32_market_open(t: Tables) -> DataFrame:
    return t.events.select("event_id", parse.is_fx_open(F.col("ts")).alias("is_open"))


@query("""
WITH s AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 6 * 3600000000 THEN 0 ELSE 1 END AS n FROM events),
r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM s)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM r GROUP BY user_id, k
""")
def m10_feed_sessions(t: Tables) -> DataFrame:
    from tidemark.streaming.streams import feed_sessions

    return feed_sessions(t.events, ["user_id"], "ts", gap="6 hours").select("user_id", stamp("start"), "n")


@query("""
WITH m AS (SELECT *, quantile_cont(value, 0.5) OVER w AS med, count(value) OVER w AS seen, count(*) OVER (PARTITION BY event_type) AS n FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW)),
d AS (SELECT *, quantile_cont(abs(value - med), 0.5) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW) AS mad FROM m WHERE n >= 30)
SELECT event_id, round(med, 6) AS rolling_median, round(mad, 6) AS rolling_mad, round((value - med) / nullif(mad * 1.4826, 0), 6) AS robust_z FROM d WHERE seen >= 30 AND abs((value - med) / nullif(mad * 1.4826, 0)) > 3
""")
def f6_rolling_robust(t: Tables) -> DataFrame:
    out = series.rolling_robust_outliers(t.events, ["event_type"], "ts", "value", days=1, n_mad=3.0, min_obs=30)
    return out.select("event_id", _r("rolling_median"), _r("rolling_mad"), _r("robust_z"))


ALERTS_SQL = """
m AS (SELECT event_type AS event, user_id AS market, date_trunc('hour', ts) AS ts, least(value / 100, 1.0) AS price, value * 1000 AS volume, (0.02 + 0.2 * (event_id % 7 = 0)::INT + 0.4 * (event_id % 11 = 0)::INT)::DOUBLE AS spread
    FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id, date_trunc('hour', ts) ORDER BY least(value / 100, 1.0) DESC, spread) = 1),
b AS (SELECT *, quantile_cont(CASE WHEN volume > 0 THEN volume END, 0.5) OVER (PARTITION BY event, market ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS baseline FROM m),
o AS (SELECT event, ts, market, price, volume / baseline AS vol_ratio, volume, spread FROM b WHERE price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event, ts ORDER BY price DESC, market) = 1),
l AS (SELECT *, lag(market) OVER w AS prior_market, lag(price) OVER w AS prior_price FROM o WINDOW w AS (PARTITION BY event ORDER BY ts)),
d AS (SELECT l.*, coalesce(l.price - prior_price, 0) AS delta, l.price - a.price AS drift FROM l ASOF LEFT JOIN o a ON l.event = a.event AND l.ts - INTERVAL 6 HOUR >= a.ts),
c AS (SELECT *, list_filter([CASE WHEN prior_market <> market AND abs(delta) >= 0.02 THEN 'MODAL_FLIP' END, CASE WHEN abs(delta) >= 0.1 THEN 'SPIKE' END, CASE WHEN abs(drift) >= 0.25 AND volume >= 10000 THEN 'DRIFT' END, CASE WHEN vol_ratio >= 5 THEN 'VOL_BURST' END], lambda x: x IS NOT NULL) AS classes,
    CASE WHEN (spread > 0.3 OR spread / greatest(least(price, 1 - price), 0.05) > 0.5) AND greatest(abs(delta), coalesce(abs(drift), 0)) < 0.3 THEN 'ILLIQUID' WHEN (price <= 0.03 OR price >= 0.97) AND (prior_price <= 0.03 OR prior_price >= 0.97) THEN 'RESOLVED' END AS held FROM d),
f AS (SELECT * FROM c WHERE len(classes) > 0)"""
WALK_SQL = """
s AS (SELECT event, 0::BIGINT AS k, NULL::TIMESTAMP AS last_at, NULL::DOUBLE AS last_price, NULL::VARCHAR AS held FROM f GROUP BY 1
UNION ALL SELECT event, k, CASE WHEN h IS NULL THEN ts ELSE last_at END, CASE WHEN h IS NULL THEN price ELSE last_price END, h FROM (
    SELECT n.event, n.k, n.ts, n.price, s.last_at, s.last_price, CASE WHEN n.held IS NOT NULL THEN n.held WHEN n.ts - s.last_at < INTERVAL 30 MINUTE AND abs(n.price - s.last_price) < 0.05 THEN 'COOLDOWN' WHEN n.classes = ['DRIFT'] THEN 'DRIFT_ONLY' END AS h
    FROM s JOIN n ON n.event = s.event AND n.k = s.k + 1))"""


def alert_markets(t: Tables) -> DataFrame:
    """Hourly snapshots of markets from the events: users are markets, types events; the dearest row of an hour counts."""
    spread = F.lit(0.02) + F.when(F.col("event_id") % 7 == 0, 0.2).otherwise(0.0) + F.when(F.col("event_id") % 11 == 0, 0.4).otherwise(0.0)
    markets = t.events.select(F.col("event_type").alias("event"), F.col("user_id").alias("market"), F.date_trunc("hour", "ts").alias("ts"), F.least(F.col("value") / 100, F.lit(1.0)).alias("price"), (F.col("value") * 1000).alias("volume"), spread.alias("spread"))
    return markets.groupBy("event", "market", "ts").agg(F.max_by(F.struct("price", "volume", "spread"), F.struct("price", -F.col("spread"))).alias("r")).select("event", "market", "ts", "r.*")


@query(f"""
WITH RECURSIVE {ALERTS_SQL},
n AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY ts) AS k FROM f),
{WALK_SQL}
SELECT n.event, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(price, 6) AS price, array_to_string(classes, ',') AS classes, s.held, s.held IS NULL AS sent FROM n JOIN s ON n.event = s.event AND n.k = s.k
""")
def l1_alerts(t: Tables) -> DataFrame:
    found = prediction.alerts(alert_markets(t), "event", "market", "ts", "price", "volume", "spread")
    return prediction.cool_down(found, "event", "ts", "price").select("event", stamp("ts"), _r("price"), F.array_join("classes", ",").alias("classes"), "held", "sent")
