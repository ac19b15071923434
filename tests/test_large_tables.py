"""Faults that only larger tables had shown: ties, zero predecessors, rows evaluated twice, tasks that hold too much."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from tidemark.operators import calendars, series, writes
from tidemark.plans import registry, source_queries


def _both(spark, folder, name, **tables):
    """The rows of a query and of its SQL on small tables."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    want = con.sql(registry.ORACLE_SQL[name])
    return sorted(map(tuple, got.select(*want.columns).collect())), sorted(want.fetchall())


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")


AT = dt.datetime(2024, 1, 1)


def test_responses_do_not_depend_on_row_order(spark, tmp_path):
    rows = [(k, AT, k % 3, ("click", "view", "purchase", "signup")[k // 3 % 4], float(k)) for k in range(24)]
    made = []
    for n, order in enumerate((rows, rows[::-1])):
        _events(spark, order).coalesce(1).write.parquet(f"{tmp_path}/{n}/events.parquet")
        made.append(sorted(r[0] for r in source_queries._responses(registry.Tables(spark, f"{tmp_path}/{n}")).select(F.to_json("body")).collect()))
    assert made[0] == made[1]


def test_flow_settles_ties_by_the_earliest_issue(spark, tmp_path):
    rows = [(1, s, 1, 2.0, AT) for s in (7, 3, 9)] + [(2, 4, 1, 5.0, AT)]
    for n, order in enumerate((rows, rows[::-1])):
        lines = spark.createDataFrame(order, "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp")
        got, want = _both(spark, tmp_path / str(n), "e20_flow", lineitem=lines)
        assert got == want == [(3, 2.0), (4, 5.0)]


def test_a_predecessor_of_zero_has_no_percentage(spark, tmp_path):
    kinds = ("signup", "view", "purchase", "click")
    rows = [(2 * k + n, AT + dt.timedelta(hours=n), k, kind, (0.0, 30.0)[n]) for k, kind in enumerate(kinds) for n in (0, 1)]
    got, want = _both(spark, tmp_path, "j8_tiered_change", events=_events(spark, rows))
    assert got == want == [(7,)]


def test_quota_adds_no_frame_anew(spark):
    us = 86_400_000_000
    at = [0, 0, 1, us - 1, us, us, us + 1, 2 * us, 5 * us, 5 * us + 7, 6 * us + 7, None]
    rows = [(k, key, t, (None, 1.5, 2.25)[k % 3]) for key in ("a", "b", None) for k, t in enumerate(at)]
    log = spark.createDataFrame(rows, "id int, key string, t long, v double").withColumn("ts", F.timestamp_micros("t"))
    out = writes.quota_used(log, "ts", "v", 10, ["key"])
    assert "-86399999999" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        inside = [v for _, key, t, v in rows if key == r["key"] and v is not None and (t == r["t"] if r["t"] is None or t is None else r["t"] - us < t <= r["t"])]
        assert r["used_24h"] == (sum(inside) if inside else None), r
    assert out.columns == [*log.columns, "used_24h", "remaining"] and out.count() == len(rows)


def test_quantile_cuts_are_made_once(spark):
    values = [None, -0.0, 0.0, 1e300, float("inf"), 2.5, *[7.0] * 900, *range(300)]
    rows = [(k, None if v is None else float(v)) for k in ("a", "b") for v in values] + [("c", 4.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    for p in (0.0, 0.1, 0.5, 0.97, 1.0):
        out = series.group_quantile(df, ["k"], "v", p, "q", bins=8)
        assert "percentile_approx" not in out._jdf.queryExecution().optimizedPlan().toString()
        want = df.where("v is not null").groupBy("k").agg(F.expr(f"percentile(v, {p}D)").alias("q"), F.count("v").alias("n"))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.select("k", "q", "n").collect()))


def _parts(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")


def test_active_flags_hold_so_many_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(series, "ROWS_EACH", 10)
    rows = [(k % 5, k % 7, AT + dt.timedelta(days=k % 11) if k % 13 else None) for k in range(300)] + [(None, 1, AT), (9, 1, None)]
    df = spark.createDataFrame(rows, "issuer int, instrument int, d timestamp")
    out = series.active_flags(df, "issuer", "instrument", "d")
    assert _parts(out) == 1 and ", 31" in out._jdf.queryExecution().optimizedPlan().toString()
    last = {i: max((d for j, _, d in rows if j == i and d), default=None) for i, _, _ in rows}
    own = {(i, n): max((d for j, m, d in rows if (j, m) == (i, n) and d), default=None) for i, n, _ in rows}
    want = {k: None if d is None else d == last[k[0]] for k, d in own.items()}
    assert {(r[0], r[1]): r[2] for r in out.collect()} == want and out.count() == len(want)


def test_trading_days_hold_so_many_rows_a_task(spark, monkeypatch):
    cal = spark.createDataFrame([("a", "5,6"), ("b", "4,5"), ("c", "")], "calendar string, weekend string")
    off = spark.createDataFrame([("a", "2024-01-03"), ("a", "2024-01-03"), ("b", "2024-01-05"), ("a", "2023-01-03"), ("x", "2024-01-04"), (None, "2024-01-04")], "calendar string, day string").select("calendar", F.col("day").cast("date").alias("holiday_date"))
    first, last = (F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-31"))
    whole = calendars.trading_days(cal, off, first, last)
    monkeypatch.setattr(series, "ROWS_EACH", 10)
    split = calendars.trading_days(cal, off, first, last)
    assert _parts(split) == 1 and ", 10" in split._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(map(tuple, split.select("calendar", "d", "is_holiday", "is_weekend", "is_trading", "trading_no").collect()))
    assert rows == sorted(map(tuple, whole.select("calendar", "d", "is_holiday", "is_weekend", "is_trading", "trading_no").collect()))
    assert len(rows) == 93 and [(r[0], str(r[1])) for r in rows if r[2]] == [("a", "2024-01-03"), ("b", "2024-01-05")]
    assert {c: max(r[5] for r in rows if r[0] == c) for c in "abc"} == {"a": 22, "b": 23, "c": 31}
