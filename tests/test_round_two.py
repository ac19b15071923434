"""Edges of the operators for rolling medians, event upserts, surrogate ids, title twins, landed pairs and polls."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendars, documents, reports, series, writes
from tidemark.sources import scans
from tidemark.streaming import streams

T0 = dt.datetime(2024, 1, 1)
DAY = 86_400_000_000


def test_rolling_median_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, T0 + dt.timedelta(hours=rng.randrange(24 * 40)), None if rng.random() < 0.1 else float(rng.randrange(50))) for k in ("a", "b", None) for _ in range(150)] + [("a", None, 1.0), ("a", None, 3.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    for closed in (False, True):
        got = series.rolling_median(df, ["k"], "ts", "v", 3 * DAY, "m", closed=closed, seen="n").collect()
        assert len(got) == len(rows)
        for r in got:
            back = dt.timedelta(days=3)
            near = [v for k, ts, v in rows if k == r.k and v is not None and (ts is None) == (r.ts is None) and (ts is None or (r.ts - back < ts or closed and ts == r.ts - back) and ts <= r.ts)]
            assert r.n == len(near)
            assert r.m is None if not near else r.m == pytest.approx(float(np.median(near)))
    assert series.rolling_median(df.limit(0), ["k"], "ts", "v", DAY, "m").count() == 0


def test_interpolation_keeps_leading_nulls(spark):
    rows = [("a", T0 + dt.timedelta(hours=h), v) for h, v in enumerate([None, 1.0, None, 3.0, None])]
    got = series.interpolate(spark.createDataFrame(rows, "k string, ts timestamp, v double"), ["k"], "ts", "v").orderBy("ts").collect()
    assert [r.filled for r in got] == [None, 1.0, 2.0, 3.0, 3.0]


def test_event_upsert_keys_guard_and_changes(spark):
    schema = "country string, event_date date, ticker string, name string, survey double, actual double"
    d = dt.date(2024, 1, 5)
    stored = spark.createDataFrame([("US", d, "T1", "cpi", 1.0, None), ("US", d, None, "cpi", 2.0, 2.5), ("US", d, None, "gdp", 1.0, 1.0)], schema)
    batch = [("US", d, "T1", "cpi again", None, 1.5), ("US", d, "T1", "cpi older", None, 1.4), ("US", d, None, "cpi", 2.0, None), ("US", d, None, "gdp", 3.0, 1.0), ("DE", d, None, "pmi", 5.0, 6.0), ("DE", dt.date(2030, 1, 1), None, "pmi", 5.0, 6.0)]
    table, changes = writes.upsert_events(stored, spark.createDataFrame(batch, schema), ["country", "event_date"], F.lit("2024-06-01").cast("timestamp"), [F.desc("actual")])
    got = {(r.country, r.event_date.year, r.ticker, r.name): (r.survey, r.actual, r._action) for r in table.collect()}
    assert got == {("US", 2024, "T1", "cpi"): (1.0, 1.5, "updated"), ("US", 2024, None, "cpi"): (2.0, 2.5, "kept"), ("US", 2024, None, "gdp"): (3.0, 1.0, "updated"), ("DE", 2024, None, "pmi"): (5.0, 6.0, "inserted"), ("DE", 2030, None, "pmi"): (5.0, None, "inserted")}
    assert sorted((r.name, r.old_actual, r.new_actual) for r in changes.collect()) == [("cpi", None, 1.5), ("pmi", None, 6.0)]


def test_new_keys_are_numbered_without_gaps(spark):
    stored = spark.createDataFrame([("b", 7)], "k string, id long")
    keys = [f"k{n:04d}" for n in range(500)]
    incoming = spark.createDataFrame([(k,) for k in [*keys, *keys, "b", None]], "k string").repartition(7)
    got = {r.k: r.id for r in writes.seed_dimension(stored, incoming, "k").collect()}
    assert got == {"b": 7} | {k: 8 + n for n, k in enumerate(keys)}
    one, two = (writes.hash_ids(stored, incoming.repartition(n), "k") for n in (1, 5))
    assert {(r.k, r.id) for r in one.collect()} == {(r.k, r.id) for r in two.collect()}
    assert one.select("id").distinct().count() == 501


def test_title_twins_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(n % 2, n, " ".join(rng.choice("alpha beta gamma delta omega kappa sigma".split()) for _ in range(rng.randrange(0, 7)))) for n in range(120)]
    got = {(r.a, r.b): round(r.jaccard, 9) for r in documents.title_twins(spark.createDataFrame(rows, "block int, id int, title string"), ["block"], "id", "title").collect()}
    sets = {n: (b, frozenset(t.split())) for b, n, t in rows if t}
    node = {}
    for n, s in sets.items():
        node.setdefault(s, n)
    want = {(node[s], n): 1.0 for n, s in sets.items() if node[s] != n}
    for (s, a), (u, b) in itertools.combinations(sorted(node.items(), key=lambda x: x[1]), 2):
        shared = len(s[1] & u[1])
        if s[0] == u[0] and (shared / len(s[1] | u[1]) >= 0.6 or shared >= 3 and shared == min(len(s[1]), len(u[1]))):
            want[a, b] = round(shared / len(s[1] | u[1]), 9)
    assert got == want


def test_relaxed_only_on_known_closed_days(spark):
    d = dt.date(2024, 1, 6)
    results = spark.createDataFrame([("X", d, "FAIL"), ("X", d, "PASS"), ("Y", d, "FAIL"), ("Z", d, "FAIL")], "calendar string, d date, status string")
    days = spark.createDataFrame([("X", d, False), ("Y", d, True)], "calendar string, d date, is_trading boolean")
    assert sorted((r.calendar, r.status) for r in calendars.relaxed(results, days, ["calendar", "d"]).collect()) == [("X", "PASS"), ("X", "RELAXED"), ("Y", "FAIL"), ("Z", "FAIL")]


def test_subtotals_take_the_first_rate_of_a_date(spark):
    rows = spark.createDataFrame([("d1", 10.0, True), ("d1", 99.0, False), ("d2", 5.0, True)], "d string, v double, total boolean")
    rates = spark.createDataFrame([("d1", 1, None), ("d1", 2, 2.0), ("d1", 3, 4.0)], "d string, n int, rate double")
    got = reports.converted_subtotals(rows, F.col("total"), ["d"], "d", ["v"], rates, "rate", "n")
    assert sorted((r.d, r.value, r.converted) for r in got.collect()) == [("d1", 10.0, 5.0), ("d2", 5.0, None)]


def test_latest_pair_needs_both_sides(spark, tmp_path):
    one = spark.range(3)
    scans.write_pair(one, one, str(tmp_path), "20240101")
    one.limit(1).write.parquet(str(tmp_path / "dim" / "load=20240102"))  # its facts never came
    dim, fact = scans.latest_pair(spark, str(tmp_path))
    assert (dim.count(), fact.count()) == (3, 3)
    with pytest.raises(Exception, match="already exists"):
        scans.write_pair(one, one, str(tmp_path), "20240101")


def test_polls_replay_and_report_dead_events(spark, tmp_path):
    schema = "id int, markets array<struct<market: string, closed: boolean, prices: string>>"
    polled = spark.createDataFrame([(1, [("m1", False, '["0.4","0.6"]'), ("m2", True, '["1","0"]')]), (2, [("m3", True, "bad")])], schema)
    write = streams.poll_events(polled, ["id"], "markets", "prices", str(tmp_path / "out"), str(tmp_path / "log"))
    for _ in range(2):
        write(polled, 0)
    assert [(r.id, r.market, r.yes) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "m1", 0.4)]
    assert [(r.n_markets, r.n_closed, r.n_dead_events) for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [(3, 2, 1)]
