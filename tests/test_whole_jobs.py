"""Whole tables and ranges: what operators and queries must not leave out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, series
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


def test_month_end_snapshots_beyond_a_month(spark):
    d = lambda s: dt.date.fromisoformat(s)
    rows = [("a", d("2024-01-25")), ("a", d("2024-01-31")), ("a", d("2024-05-02")), ("b", d("2023-12-30")), ("b", d("2024-02-29")), ("c", d("2024-04-30"))]
    ends = [d("2024-01-31"), d("2024-02-29"), d("2024-03-31"), d("2024-04-30"), d("2024-05-31")]
    df = spark.createDataFrame(rows, "k string, d date")
    for within in (0, 5, 28, 45, 100):
        got = {(r.k, r.month_end): r.snapshot for r in joins.month_end_snapshots(df, ["k"], "d", F.lit(ends[0]), F.lit(ends[-1]), within).collect()}
        assert got == {(k, e): max((x for i, x in rows if i == k and 0 <= (e - x).days <= within), default=None) for k in "abc" for e in ends}


def test_month_ends_of_every_customer(spark):
    got = registry.QUERIES["d26_month_end_snapshots_all"](spark, SF)
    o = spark.read.parquet(f"{SF}/orders.parquet")
    months = o.select(F.months_between(F.trunc(F.max("o_orderdate"), "MM"), F.trunc(F.min("o_orderdate"), "MM")) + 1).first()[0]
    assert got.count() == o.select("o_custkey").distinct().count() * months


def test_every_order_and_shipment_is_matched(spark):
    o, i = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    got = registry.QUERIES["d12_window_match_all"](spark, SF).toPandas()
    left = got[got["left_date"].notna()]
    assert len(left) == o.select("o_custkey", F.to_date("o_orderdate")).distinct().count()
    shipped = i.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.to_date("l_shipdate").cast("string")).distinct().collect()
    ordered = set(zip(left["k"], left["left_date"], strict=True))
    near = {(k, str(dt.date.fromisoformat(d) + dt.timedelta(days=n))) for k, d in ordered for n in range(-3, 4)}
    alone = got[got["status"] == "RIGHT_ONLY"]
    assert set(zip(alone["k"], alone["right_date"], strict=True)) == {(k, d) for k, d in shipped if (k, d) not in near}


def test_backfill_and_calendars_take_whole_tables(spark):
    o, i = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    at = dict(o.select("o_orderkey", "o_custkey").collect())
    stored = {(at[r.l_orderkey], r.l_shipdate) for r in i.select("l_orderkey", "l_shipdate").collect() if r.l_orderkey in at}
    last = max(ts for _, ts in stored)
    want = [r.o_orderkey for r in o.collect() if r.o_orderdate < last and (r.o_custkey, r.o_orderdate) not in stored]
    assert sorted(r.o_orderkey for r in registry.QUERIES["l4_clamp_backfill_all"](spark, SF).collect()) == sorted(want)
    off = registry.QUERIES["i2_trading_days_all"](spark, SF).where("is_holiday").select("calendar", "d")
    assert off.count() == i.select("l_suppkey", F.to_date("l_shipdate")).distinct().count()


def test_rules_that_every_task_gets_are_counted_first(spark):
    assert joins.bounded(spark.range(3), 3).count() == 3
    with pytest.raises(ValueError, match="more than 3"):
        joins.bounded(spark.range(4), 3)


def test_large_groups_are_counted_and_give_the_same_outliers(spark, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.when(F.col("id") % 97 == 0, 900.0).otherwise((F.col("id") * 7919 % 101).cast("double")).alias("v"))
    found = lambda **o: sorted((r.k, r.ts, round(r.robust_z, 9)) for r in series.robust_outliers(rows, ["k"], "ts", "v", n_mad=4.0, **o).collect())
    plain = found()
    monkeypatch.setattr(series, "LARGE_GROUP", 100)
    calls = []
    quantile = series.group_quantile
    monkeypatch.setattr(series, "group_quantile", lambda *a, **o: calls.append(1) or quantile(*a, **o))
    assert plain and found() == plain and len(calls) == 2
    assert found(large_groups=False) == plain and len(calls) == 2
