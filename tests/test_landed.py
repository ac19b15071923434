"""Polls as a data source, drifting panels, growing coverage, observed writes, the SQL surface, the vector index and mended joins."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse, surface
from tidemark.operators import calendars, coverage, joins, series, vector_index
from tidemark.operators.documents import semantic_search
from tidemark.sources import landed
from tidemark.streaming import streams


def _land(spark, path, number, *responses):
    spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in responses], "value string").repartition(2).write.text(f"{path}/poll={number}")


@pytest.fixture
def polls(spark, tmp_path):
    path = str(tmp_path / "polls")
    _land(spark, path, 0, {"status": "ok", "body": {"a": {"x": [1, 2], "c": [1.5, None]}, "b": {"type": "ERROR", "x": [1], "c": [9]}}}, {"status": "ERROR", "body": {"a": {"x": [9], "c": [9]}}}, "{broken", "[1]")
    _land(spark, path, 1, {"status": "ok", "body": {"a": {"x": [3], "c": [2]}, "c": {"x": [4], "c": [7.0]}}}, {"status": "ok"})
    (tmp_path / "polls" / "poll=7").mkdir()
    (tmp_path / "polls" / "poll=7" / "part-0").write_text('{"status": "ok", "body": {"a": {"x": [8], "c": [8]}}}')  # not whole yet: no _SUCCESS
    return path


def test_polls_are_read_in_partitions_and_pruned_at_the_source(spark, polls):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    df = landed.poll_frame(spark, polls, files_each=1)
    assert rows(df) == [(0, "a", 1, 1.5), (1, "a", 3, 2.0), (1, "c", 4, 7.0)]
    assert rows(df.where("poll >= 1 and tag in ('c', 'z')")) == [(1, "c", 4, 7.0)]
    assert rows(df.where("poll < 1 or x = 4")) == [(0, "a", 1, 1.5), (1, "c", 4, 7.0)]
    assert rows(landed.poll_frame(spark, polls, first=1, tags=["c", "z"])) == [(1, "c", 4, 7.0)]
    assert rows(landed.poll_frame(spark, polls, last=0)) == [(0, "a", 1, 1.5)] and rows(landed.poll_frame(spark, polls, first=5)) == []
    reader = landed.PollReader({"path": polls, "filesEach": "1", "first": "1", "tags": '["a"]'})
    assert {p.poll for p in reader.partitions()} == {1} and {p.tags for p in reader.partitions()} == {frozenset("a")} and len(reader.partitions()) == 2


def test_a_restart_repeats_no_poll(spark, polls, tmp_path):
    out = str(tmp_path / "out")
    seen = []
    for number in (2, 3, None):
        rows = streams.drain(landed.poll_frame(spark, polls, stream=True), out)
        seen.append(sorted((r.poll, r.x) for r in rows.collect()))
        if number is not None:
            _land(spark, polls, number, {"status": "ok", "body": {"a": {"x": [number * 10], "c": [1]}}})
    assert seen == [[(0, 1), (1, 3), (1, 4)], [(0, 1), (1, 3), (1, 4), (2, 20)], [(0, 1), (1, 3), (1, 4), (2, 20), (3, 30)]]


def test_no_polls_are_an_empty_table(spark, tmp_path):
    assert landed.poll_frame(spark, str(tmp_path / "nothing")).count() == 0


def test_drifting_panel(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"id":1,"v":1.5}\n{"id":2,"v":"2.5"}\n{"id":3,"v":{"value":3.5}}\n{"id":4,"v":[4.5]}\n{broken\n\n   \n{"id":"six","v":true}\n7\n')
    records, bad = landed.drifting_panel(spark, str(tmp_path / "p.json"))
    got = records.select(landed.variant_field(F.col("record"), ["$.id"], "long").alias("id"), landed.variant_field(F.col("record"), ["$.v.value", "$.v[0]", "$.v"], "double").alias("v")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, 1.5), (2, 2.5), (3, 3.5), (4, 4.5), (None, 1.0), (None, None)], key=str)
    assert [r.line for r in bad.collect()] == ["{broken"]
    assert "id" in landed.panel_shape(records.where("try_variant_get(record, '$.id', 'long') < 3")).first()["shape"]


def test_variant_series_of_any_shape(spark):
    body = '{"a":{"x":[1,2,3],"c":[1.0,null,"3"]},"b":[[5,6.5],[7,"8"]],"c":3,"d":"no","e":null,"f":{"x":[1]},"g":[]}'
    df = spark.createDataFrame([(1, body), (2, "{}"), (3, None)], "k int, j string").withColumn("body", F.parse_json("j"))
    got = sorted((r.k, r.tag, r.x, r.value) for r in landed.variant_series(df, "body", ["k"]).where("tag != 'c'").collect())
    assert got == [(1, "a", 1, 1.0), (1, "a", 3, 3.0), (1, "b", 5, 6.5), (1, "b", 7, 8.0)]
    assert [(r.x, r.value) for r in landed.variant_series(df, "body", ["k"]).where("tag = 'c'").collect()] == [(None, 3.0)]


def test_a_new_day_merges_without_the_old_ones(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(240)), rng.randrange(3000)) for _ in range(20_000)] + [("c", None, 1)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, item int")
    path = str(tmp_path / "days")
    for day in range(1, 11):  # each day is sketched from its own rows and appended
        coverage.daily_sketches(df.where(F.dayofmonth("ts") == day), ["k"], "ts", ["item"]).write.mode("append").parquet(path)
    got = {r.k: r for r in coverage.merged_coverage(spark.read.parquet(path), ["k"], ["item"]).collect()}
    assert set(got) == {"a", "b"}
    for k in "ab":
        own = [r for r in rows if r[0] == k]
        exact = len({r[2] for r in own})
        assert (got[k].n_rows, got[k].n_days, got[k].n_hours) == (len(own), 10, 24)
        assert (got[k].first_ts, got[k].last_ts) == (min(r[1] for r in own), max(r[1] for r in own))
        assert abs(got[k].n_item - exact) <= 4 * coverage.relative_error() * exact
    whole = coverage.merged_coverage(coverage.daily_sketches(df, ["k"], "ts", ["item"]), ["k"], ["item"])
    assert {r.k: r.n_item for r in whole.collect()} == {k: got[k].n_item for k in "ab"}  # the order of merging changes nothing


def test_counts_come_from_the_job_that_writes(spark, tmp_path):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    found = coverage.observed_write(spark.range(10), str(tmp_path / "w"), {"odd": F.col("id") % 2 == 1, "none": F.col("id").isNull()}, keep=F.col("id") < 7)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before) <= 1
    assert found == {"rows_extracted": 10, "failing_odd": 5, "failing_none": 0, "rows_loaded": 7}
    assert spark.read.parquet(str(tmp_path / "w")).count() == 7
    assert coverage.observed_write(spark.range(0), str(tmp_path / "e"), {"odd": F.col("id") % 2 == 1})["rows_loaded"] == 0


def test_each_micro_batch_is_counted(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 4 + k).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema("id long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = coverage.observed_stream(stream, {"odd": F.col("id") % 2 == 1}).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    assert run.awaitTermination(120) in (True, None)
    assert sorted((m["rows_extracted"], m["failing_odd"]) for m in coverage.batch_metrics(run)) == [(4, 2), (5, 2), (6, 3)]


def test_functions_called_from_sql(spark):
    surface.register_functions(spark)
    rows = spark.range(400).select(F.timestamp_seconds(F.col("id") * 1800 + 1_704_412_800).alias("ts"))
    rows.createOrReplaceTempView("some_hours")
    got = spark.sql("SELECT ts, fx_open(ts) AS o FROM some_hours").withColumn("want", parse.is_fx_open(F.col("ts")))
    assert got.where("o IS DISTINCT FROM want").count() == 0 and got.where("o").count() > 0
    assert tuple(spark.sql("SELECT tag_part('a.b', 2), tag_part('a.b', 3), tag_part(NULL, 1), round(spread_bps(1D, 1.1D), 3), mid_price(NULL, 2D), fx_open(NULL)").first()) == ("b", None, None, 952.381, 2.0, False)
    table = spark.sql("SELECT tag, t.* FROM VALUES ('a.b.c'), ('a.b'), (NULL) AS v(tag), LATERAL tag_axes(v.tag, 'ccy.curve.tenor') AS t")
    assert table.columns == ["tag", "ccy", "curve", "tenor"]
    assert sorted(map(tuple, table.collect())) == [("a.b", None, None, None), ("a.b.c", "a", "b", "c")]
    for bad in ("SELECT * FROM tag_axes('a', NULL)", "SELECT * FROM tag_axes('a', '')"):
        with pytest.raises(Exception, match="constant text"):
            spark.sql(bad).collect()


def test_callables_become_columns(spark):
    df = spark.range(3)
    built = surface.column_of(lambda c: c + 1, "int", "id")
    called = surface.column_of(lambda v: f"{int(v)}!", "string", "id")
    assert [tuple(r) for r in df.select(built, called).collect()] == [(1, "0!"), (2, "1!"), (3, "2!")]
    assert "Python" not in df.select(built)._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(80, 16))[rng.integers(0, 80, 6000)] + 0.2 * rng.normal(size=(6000, 16))
    rows = [(k, k % 7, f"r{k // 5}", x) for k, x in enumerate(v.tolist())] + [(9000, 1, "bad", None), (9001, 1, "bad", [0.0] * 16), (9002, 1, "bad", [float("nan")] * 16)]
    return v, spark.createDataFrame(rows, "page long, vendor long, report_id string, vector array<double>")


def test_index_recall_and_reads(spark, tmp_path, clustered):
    v, df = clustered
    index = vector_index.build_index(df, str(tmp_path / "index"), tables=4, bucket_length=0.15)
    rng, hits, read = np.random.default_rng(1), 0, 0
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    ours = np.flatnonzero(np.arange(6000) % 7 != 3)
    for q in v[rng.integers(0, 6000, 12)] + 0.05 * rng.normal(size=(12, 16)):
        found = vector_index.candidates(spark, index, q.tolist(), where=F.col("vendor") != 3, probes=0).select("page", "score").toPandas()
        near = unit[ours] @ (q / np.linalg.norm(q))
        best = set(ours[np.argsort(-near)[:10]].tolist())
        hits += len(best & set(found.sort_values(["score", "page"], ascending=[False, True])["page"][:10]))
        read += len(found)
        assert np.allclose(found.set_index("page")["score"].sort_index(), unit[np.sort(found["page"])] @ (q / np.linalg.norm(q)))
    assert hits / 120 >= 0.9
    assert read / 12 < 0.8 * len(ours)  # and less than all rows
    got, want = vector_index.indexed_search(spark, index, v[5].tolist(), 3), semantic_search(df.where("page < 6000"), v[5].tolist(), 3)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    plan = vector_index.candidates(spark, index, v[5].tolist(), where=F.col("vendor") == 2)._jdf.queryExecution().toString()
    assert "lsh_part" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0] and "EqualTo(vendor,2)" in plan


def test_empty_index(spark, tmp_path, clustered):
    _, df = clustered
    index = vector_index.build_index(df.limit(0), str(tmp_path / "none"))
    assert vector_index.candidates(spark, index, [1.0]).count() == 0


def test_word_match_equals_all_pairs(spark):
    rng, day = random.Random(7), dt.date(2024, 1, 1)
    row = lambda: (rng.choice("ab"), day + dt.timedelta(days=rng.randrange(30)), rng.choices(["cpi", "us", "the", "gdp", "uk", "pmi"], k=rng.randrange(6)))
    left, right = [row() for _ in range(60)] + [("a", None, ["cpi", "us"])], [row() for _ in range(80)] + [("a", day, None)]
    for least in (1, 2, 3):
        got = joins.match_by_words(*(spark.createDataFrame(x, "k string, d date, w array<string>") for x in (left, right)), ["k"], "d", "w", days=3, least_shared=least)
        want = {}
        for k, d, w in left:
            near = [(abs((d - e).days), -len(set(w) & set(x)), e, x) for j, e, x in right if d and j == k and x is not None and abs((d - e).days) <= 3 and len(set(w) & set(x)) >= least]
            if near:
                best = min(near)
                want[k, d, tuple(w)] = (best[2], -best[1])
        assert {(r.k, r.left_date, tuple(r.left_words)): (r.right_date, r.shared) for r in got.collect()} == want


@pytest.mark.parametrize("most_pairs", [0, 40, 50_000])
def test_word_match_in_small_and_large_stretches(spark, most_pairs):
    """Stretches below and above ``most_pairs``, a match across their border, a null word (it is none) and a row without a partner."""
    rng, day = random.Random(11), dt.date(2024, 1, 1)
    row = lambda key: (key, day + dt.timedelta(days=rng.randrange(90)), rng.choices(["cpi", "us", "the", "gdp", "uk", "pmi", None], k=rng.randrange(6)))
    left, right = ([row(rng.choice("aaaaab")) for _ in range(n)] + [(None, day, ["cpi", "us"])] for n in (90, 120))
    left += [("c", dt.date(2024, 1, 25), ["x", "y", None]), ("d", day, ["x", "y"])]
    right += [("c", dt.date(2024, 1, 28), ["y", None, "x"]), ("c", dt.date(2024, 1, 29), ["x", "y"])]
    got = joins.match_by_words(*(spark.createDataFrame(x, "k string, d date, w array<string>") for x in (left, right)), ["k"], "d", "w", most_pairs=most_pairs)
    want, own = {}, lambda x: set(x) - {None}
    for k, d, w in left:
        near = [(abs((d - e).days), -len(own(w) & own(x)), e) for j, e, x in right if k is not None and j == k and abs((d - e).days) <= 3 and len(own(w) & own(x)) >= 2]
        if near:
            want[k, d, tuple(w)] = (min(near)[2], -min(near)[1])
    found = got.collect()
    assert {(r.k, r.left_date, tuple(r.left_words)): (r.right_date, r.shared) for r in found} == want and len(found) == len(want)
    assert want["c", dt.date(2024, 1, 25), ("x", "y", None)] == (dt.date(2024, 1, 28), 2)


def test_business_days_with_holidays_by_number(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 40, 3)]
    off = [dt.date(2024, 1, 5), dt.date(2024, 1, 15), dt.date(2024, 1, 20), dt.date(2024, 2, 5), dt.date(2024, 3, 1)]
    df, holidays = spark.createDataFrame([(d,) for d in days], "d date"), spark.createDataFrame([(d,) for d in off + off[:1]], "holiday_date date")
    reference = dt.date(2024, 2, 8)
    got = {r.d: r.days_behind for r in calendars.business_days_behind(df, "d", F.lit(reference), holidays).collect()}
    span = lambda a: sum(1 for k in range(1, (reference - a).days + 1) if (x := a + dt.timedelta(days=k)).weekday() < 5 and x not in off)
    assert {d: n for d, n in got.items() if d <= reference} == {d: span(d) for d in days if d <= reference}


def test_curve_horizons_in_one_aggregation(spark):
    nodes = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 4.0), ("b", 2.0, 5.0)], "k string, t double, v double")
    got = {(r.k, r.horizon): r.level for r in series.curve_at(nodes, ["k"], "t", "v", [0.5, 2.0, 3.0, 9.0]).collect()}
    assert got == {("a", 0.5): 2.0, ("a", 2.0): 3.0, ("a", 3.0): 4.0, ("a", 9.0): None, ("b", 0.5): 5.0, ("b", 2.0): 5.0, ("b", 3.0): None, ("b", 9.0): None}


def test_all_lags_in_one_pass(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [("a", t(0), 1.0), ("a", t(6), 2.0), ("a", t(7), None), ("a", t(400), 3.0), (None, t(0), 9.0), (None, t(8), 9.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    for lookback, far in ((3 * 86_400, None), (None, 2.0)):
        got = {(r.k, r.ts): (r.v_1h, r.v_6h) for r in joins.asof_lags(df, ["k"], "ts", "v", [1, 6], lookback).collect()}
        assert got == {("a", t(0)): (None, None), ("a", t(6)): (1.0, 1.0), ("a", t(7)): (2.0, 1.0), ("a", t(400)): (far, far), (None, t(0)): (None, None), (None, t(8)): (None, None)}
