"""Semantics on tiny literal frames: edges, ties, nulls, idempotence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import calendars, checks, documents, joins, prediction, series, writes
from tidemark.sources import scans


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("20240131", "2024-01-31 00:00"), ("202401", "2024-01-01 00:00"), ("202431", "2024-07-29 00:00"), ("2024013107", "2024-01-31 07:00"), ("20240131073", "2024-01-31 07:30"), ("202401310745", "2024-01-31 07:45"), ("abc", None), ("2024", None)])
def test_parse_stamp(spark, text, want):
    got = one(spark, F.date_format(parse.parse_stamp(F.col("c")), "yyyy-MM-dd HH:mm"), c=text)
    assert got == want


@pytest.mark.parametrize(("text", "style", "anchor", "want"), [("2024-Q2", "sdmx", "start", "2024-04-01"), ("2024-Q5", "sdmx", "start", None), ("2024-M13", "bls", "start", None), ("2024-Q05", "bls", "start", None), ("2024-M02", "bls", "end", "2024-02-29"), ("2024.03", "dotted", "end", "2024-03-31"), ("2024Q4", "bea", "end", "2024-12-31")])
def test_periods(spark, text, style, anchor, want):
    assert one(spark, parse.period_to_date(F.col("c"), style, anchor).cast("string"), c=text) == want


@pytest.mark.parametrize(("text", "options", "want"), [("1,234.5", {}, 1234.5), ("(7)", {"paren_negative": True}, -7.0), ("(NA)", {}, None), ("n.a.", {}, None), ("1.234,5", {"decimal": ","}, 1234.5), ("12,34,567", {}, 1234567.0)])
def test_numbers(spark, text, options, want):
    assert one(spark, parse.parse_number(F.col("c"), **options), c=text) == want


def test_question_dates(spark):
    got = {q: one(spark, parse.question_date(F.col("q"), 2025).cast("string"), q=q) for q in ("Rate cut in Q2 2025?", "Above 4% by end of June?", "Recession before 2026?", "Cut at the March meeting?", "Hike on May 7?", "nothing")}
    assert list(got.values()) == ["2025-06-30", "2025-06-30", "2026-12-31", "2025-03-15", "2025-05-07", None]


def test_asof_is_strict_and_bounded(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    left = spark.createDataFrame([("a", t(10)), ("a", t(40)), ("b", t(1)), (None, t(10))], "k string, ts timestamp")
    right = spark.createDataFrame([("a", t(10), 9.0), ("a", t(9), 1.0), ("a", t(8), None), (None, t(9), 3.0)], "k string, ts timestamp, v double")
    got = {(r.k, r.ts): r.asof_value for r in joins.asof_join(left, right, ["k"], "ts", "v", 24 * 3600).collect()}
    assert got == {("a", t(10)): 1.0, ("a", t(40)): None, ("b", t(1)): None, (None, t(10)): None}
    loose = joins.asof_join(left.limit(1), right, ["k"], "ts", "v", 3600, strict=False).first()
    assert loose.asof_value == 9.0


def test_upsert_is_idempotent_and_null_keeps(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0)], "k int, z string, v double")
    source = spark.createDataFrame([(1, "b", None), (2, "c", 3.0), (3, "d", 4.0)], "k int, z string, v double")
    spec = writes.MergeSpec(["k"], ["v"], insert_only=["z"])
    once = writes.merge_upsert(target, source, spec)
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1.0, "kept"), (2, None, 3.0, "updated"), (3, "d", 4.0, "inserted")]
    twice = writes.merge_upsert(once.drop("_action"), source, spec)
    assert {r._action for r in twice.collect()} == {"kept"}
    with pytest.raises(Exception, match="duplicate source key"):
        writes.merge_upsert(target, source.union(source), spec).collect()


def test_vintages_skip_equal_and_null(spark):
    old = spark.createDataFrame([("a", 0, 1), ("b", 3, 5), ("c", 0, 7)], "k string, vintage int, v int")
    new = spark.createDataFrame([("a", 1, "2024-01-02"), ("b", 6, "2024-01-02"), ("b", 9, "2024-01-01"), ("c", None, "2024-01-02"), ("d", 2, "2024-01-02")], "k string, v int, release string")
    got = {r.k: (r._action, r.vintage) for r in writes.vintage_load(old, new, ["k"], "v", "release").collect()}
    assert got == {"a": ("skip", None), "b": ("revision", 4), "c": ("skip", None), "d": ("new", 0)}


def test_cleaning_sees_one_snapshot(spark):
    df = spark.createDataFrame([(1, 5.0, 4.0), (2, 1.0, 2.0), (3, 9.0, 1.0)], "id int, bid double, ask double")
    rules = [writes.CleaningRule("inverted", "swap", checks.bid_ask_inversions), writes.CleaningRule("big", "null", lambda d: d.where("bid > 8"))]
    cleaned, log = writes.clean(df, "id", rules, ["bid", "ask"], ("bid", "ask"))
    assert sorted(map(tuple, cleaned.collect())) == [(1, 4.0, 5.0), (2, 1.0, 2.0), (3, None, None)]
    assert log.count() == 3


def test_interpolation_edges(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([(t(0), None), (t(1), 1.0), (t(2), None), (t(4), 4.0), (t(5), None)], "ts timestamp, v double")
    got = [r.filled for r in series.interpolate(df.withColumn("k", F.lit(1)), ["k"], "ts", "v").orderBy("ts").collect()]
    assert got == [None, 1.0, 2.0, 4.0, 4.0]


def test_weekdays_between(spark):
    day = lambda s: F.lit(s).cast("date")
    got = spark.range(1).select(*[calendars.weekdays_between(day(a), day(b)) for a, b in (("2024-01-05", "2024-01-08"), ("2024-01-05", "2024-01-07"), ("2024-01-01", "2024-01-15"), ("2024-01-08", "2024-01-05"))]).first()
    assert list(got) == [1, 0, 10, -1]


def test_robust_outlier_planted_and_gated(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=k), float(k % 5)) for k in range(120)] + [("a", t0 + dt.timedelta(hours=121), 500.0)] + [("b", t0, 900.0)] + [("c", t0 + dt.timedelta(hours=k), 1.0) for k in range(120)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    out = series.robust_outliers(df, ["k"], "ts", "v", n_mad=6, min_obs=100).collect()
    assert [(r.k, r.v) for r in out] == [("a", 500.0)]


def test_window_match(spark):
    d = lambda s: dt.date.fromisoformat(s)
    left = spark.createDataFrame([("a", d("2024-01-10")), ("a", d("2024-02-01"))], "k string, d date")
    right = spark.createDataFrame([("a", d("2024-01-12")), ("a", d("2024-01-07")), ("b", d("2024-01-01"))], "k string, d date")
    got = {(r.k, r.left_date, r.right_date, r.status) for r in joins.match_within_days(left, right, ["k"], "d").collect()}
    assert got == {("a", d("2024-01-10"), d("2024-01-07"), "DATE_MISMATCH"), ("a", d("2024-02-01"), None, "LEFT_ONLY"), ("b", None, d("2024-01-01"), "RIGHT_ONLY")}


def test_cool_down(spark):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [("e", t(0), 0.5, None, ["SPIKE"]), ("e", t(10), 0.52, None, ["SPIKE"]), ("e", t(20), 0.7, None, ["SPIKE"]), ("e", t(25), 0.71, "ILLIQUID", ["SPIKE"]), ("e", t(60), 0.7, None, ["DRIFT"])]
    df = spark.createDataFrame(rows, "event string, ts timestamp, price double, held string, classes array<string>")
    got = [r.sent for r in prediction.cool_down(df, "event", "ts", "price").orderBy("ts").collect()]
    assert got == [True, False, True, False, False]  # a drift alone is logged, not sent


def test_matrix_sheet(spark):
    cells = [("s", 0, 1, "2023"), ("s", 1, 1, "11"), ("s", 1, 2, "12"), ("s", 1, 3, "1"), ("s", 2, 0, " GDP "), ("s", 2, 1, "1,000"), ("s", 2, 2, "x"), ("s", 2, 3, "3")]
    df = spark.createDataFrame(cells, "sheet string, row int, col int, text string")
    got = sorted(tuple(r) for r in documents.matrix_to_long(df, "sheet", 0, 1, 2, 0).collect())
    assert got == [("s", "GDP", 2023, 11, 1000.0), ("s", "GDP", 2024, 1, 3.0)]


def test_three_header_csv(spark, tmp_path):
    (tmp_path / "USD_SOFR_ois").mkdir()
    (tmp_path / "USD_SOFR_ois" / "x.csv").write_text("T,EUR1 Curncy,GBP1 Curncy\nA,EUR1M,GBP1M\nF,PX,PX\n31/01/2024,1.5,bad\nnodate,1,2\n")
    got = [(r.alias, r.value, str(r.obs_date)) for r in scans.three_header_csv(spark, str(tmp_path / "USD_SOFR_ois")).collect()]
    assert got == [("EUR1M", 1.5, "2024-01-31")]


def test_three_header_csv_quotes_encoding_and_checks(spark, tmp_path):
    lines = ['Ticker,"EUR1, mid",GBP1', 'Tenor, 1M ,"2""M"', "Field,PX,PX", '"31/01/2024","1,234.5",2.5', "", "01/02/2024,1.5,", '02/02/2024,"3.5","4.5"', '03/02/2024,"5\n",6.5']
    (tmp_path / "a.csv").write_bytes("\r\n".join(lines).replace("mid", "m\u00eed").encode("latin-1"))
    got = sorted((str(r.obs_date), r.ticker, r.alias, r.value) for r in scans.three_header_csv(spark, str(tmp_path / "a.csv"), corner="Ticker", second="Tenor").collect())
    assert got == [("2024-01-31", "GBP1", '2"M', 2.5), ("2024-02-01", "EUR1, m\u00eed", "1M", 1.5), ("2024-02-02", "EUR1, m\u00eed", "1M", 3.5), ("2024-02-02", "GBP1", '2"M', 4.5), ("2024-02-03", "EUR1, m\u00eed", "1M", 5.0), ("2024-02-03", "GBP1", '2"M', 6.5)]
    for options in ({"corner": "T"}, {"second": "Alias"}):
        with pytest.raises(Exception, match="the first cell"):
            scans.three_header_csv(spark, str(tmp_path / "a.csv"), **options).collect()
    (tmp_path / "b.csv").write_text("Ticker,a\nTenor,b\nField,c\n")
    with pytest.raises(Exception, match="fewer than four"):
        scans.three_header_csv(spark, str(tmp_path / "b.csv")).collect()


def test_partitioned_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "archive")
    first = spark.createDataFrame([("a", "2024-01", 1, 1.0), ("a", "2024-02", 2, 2.0)], "ccy string, month string, k int, v double")
    second = spark.createDataFrame([("a", "2024-01", 1, 9.0), ("a", "2024-01", 3, 3.0)], "ccy string, month string, k int, v double")
    for frame in (first, second, second):
        scans.write_partitioned(frame, path, ["ccy", "month"], ["ccy", "month", "k"], ["v"])
    got = sorted(tuple(r) for r in spark.read.schema(first.schema).parquet(path).select("ccy", "month", "k", "v").collect())
    assert got == [("a", "2024-01", 1, 9.0), ("a", "2024-01", 3, 3.0), ("a", "2024-02", 2, 2.0)]


def test_guard_rejects_changes(spark):
    spark.range(3).createOrReplaceTempView("allowed_view")
    assert scans.guarded_query(spark, "WITH x AS (SELECT * FROM allowed_view) SELECT * FROM x", {"allowed_view"}, 2).count() == 2
    bad = ["DROP TABLE x", "SELECT 1; SELECT 2", "SELECT * FROM secret", "SELECT * FROM allowed_view, secret", "SELECT * FROM `secret`", "SELECT * FROM allowed_view JOIN db.`secret` USING (id)", "SELECT (SELECT max(id) FROM secret)", "SELECT * FROM allowed_view WHERE id IN (SELECT id FROM secret)"]
    bad += ["WITH x AS (SELECT * FROM secret) SELECT * FROM x", "WITH x AS (SELECT 1) INSERT INTO allowed_view SELECT * FROM x", "SELECT * FROM parquet.`/tmp`", "SELECT java_method('java.lang.System', 'getenv')", "SELECT * FROM my_table_function()", "FROM allowed_view INSERT INTO t SELECT *", "/* x */ DROP VIEW allowed_view", "SELECT * FROM allowed_view WHERE EXISTS (SELECT 1 FROM (SELECT * FROM secret) AS s)"]
    for sql in bad:
        with pytest.raises(ValueError):
            scans.guarded_query(spark, sql, {"allowed_view"})
    for sql in ("SELECT 'drop table secret, update' AS t, count(*) FROM allowed_view -- delete", "/* from secret */ SELECT * FROM `allowed_view` AS `a`", "SELECT * FROM Allowed_View;", "SELECT max(id) FROM (SELECT * FROM allowed_view) WHERE id < (SELECT 9)"):
        assert scans.guarded_query(spark, sql, {"allowed_view"}).count() > 0


def test_each_query_is_logged(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("allowed_view")
    log = str(tmp_path / "log")
    assert scans.logged_query(spark, "SELECT id FROM allowed_view", log, called_by="me", allowed={"allowed_view"}, max_rows=2).count() == 2
    for sql, error in (("SELECT * FROM secret", ValueError), ("SELECT raise_error('no') FROM allowed_view", Exception)):
        with pytest.raises(error):
            scans.logged_query(spark, sql, log, called_by="me", allowed={"allowed_view"})
    rows = sorted((r.sql_text, r.called_by, r.row_count, r.error_message is None, r.execution_ms >= 0) for r in spark.read.parquet(log).collect())
    assert rows == [("SELECT * FROM secret", "me", None, False, True), ("SELECT id FROM allowed_view", "me", 2, True, True), ("SELECT raise_error('no') FROM allowed_view", "me", None, False, True)]


def test_catalog_columns(spark):
    spark.range(3).selectExpr("id", "'x' AS name").createOrReplaceTempView("listed_view")
    got = {tuple(r) for r in scans.catalog_columns(spark, tables={"listed_view"}).select("table_name", "kind", "place", "column_name", "data_type", "n_rows").collect()}
    assert got == {("listed_view", "TEMPORARY", 0, "id", "bigint", 3), ("listed_view", "TEMPORARY", 1, "name", "string", 3)}
    assert scans.catalog_columns(spark, tables={"no_such"}).count() == 0


def test_retention_removes_only_what_has_expired(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [("a", "2023-01", 1), ("a", "2023-12", 2), ("b", "2023-01", 3), ("b", "2024-01", 4), ("b", "other", 5)]
    spark.createDataFrame(rows, "ccy string, month string, v int").write.partitionBy("ccy", "month").parquet(path)
    today = dt.date(2024, 3, 1)
    for dry in (True, False):
        report = scans.drop_expired(spark, path, "month", today, 12, dry_run=dry).collect()
        assert sorted(r.folder.split("archive/")[1] for r in report) == ["ccy=a/month=2023-01", "ccy=b/month=2023-01"]
        assert all(r.dropped is not dry and r.n_files > 0 and r.n_bytes > 0 for r in report)
        assert spark.read.parquet(path).count() == (5 if dry else 3)
    assert scans.drop_expired(spark, path, "month", today, 12).count() == 0
    assert scans.drop_expired(spark, path, "month", dt.date(2024, 1, 30), 0).count() == 1  # December 2023 has ended, January 2024 has not


def test_carry_over_stretches(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), v) for h, v in [(0, None), (1, 1.0), (5, None), (200, None), (201, 5.0), (500, None)]] + [("b", dt.datetime(2024, 1, 2), None), (None, dt.datetime(2024, 1, 1), 7.0), (None, dt.datetime(2024, 2, 1), None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    out = series.carried(df, ["k"], "ts", {"last": F.col("v")})
    out = series.carried(out, ["k"], "ts", {"next": F.col("v")}, backwards=True)
    got = {(r.k, r.ts): (r.last, r.next) for r in out.collect()}
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    assert [got["a", t(h)] for h in (0, 1, 5, 200, 201, 500)] == [(None, 1.0), (1.0, 1.0), (1.0, 5.0), (1.0, 5.0), (5.0, 5.0), (5.0, None)]
    assert got["b", dt.datetime(2024, 1, 2)] == (None, None) and got[None, dt.datetime(2024, 2, 1)] == (7.0, None)


def test_one_key_s_history_is_spread_over_tasks(spark):
    rows = spark.range(40_000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 600_000_000).alias("ts"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("v"))
    whole = series.interpolate(rows, ["k"], "ts", "v", micros=1 << 60).orderBy("ts").select("filled").toPandas()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = series.interpolate(rows, ["k"], "ts", "v")
        assert spread.orderBy("ts").select("filled").toPandas().equals(whole)
        counts = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(counts) == 4 and max(counts) < 20_000


def test_vendor_response(spark):
    body = {"t1": {"x": [1, 2], "c": [1.0, None], "type": "OK"}, "t2": {"x": [1], "c": [5.0], "type": "ERROR"}}
    df = spark.createDataFrame([("ok", body), ("error", body)], "status string, body map<string, struct<x: array<long>, c: array<double>, type: string>>")
    assert [tuple(r) for r in scans.series_response(df).collect()] == [("t1", 1, 1.0)]
