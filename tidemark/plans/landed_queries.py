"""Queries over landed polls, drifting panels, archives, sketches, observed writes and the SQL surface."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import surface
from tidemark.operators import coverage, vector_index
from tidemark.plans.registry import Tables, query
from tidemark.plans.source_queries import _responses
from tidemark.session import scratch_path
from tidemark.sources import landed, scans
from tidemark.streaming import streams


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


def _polls(t: Tables) -> str:
    """The events as three polls of vendor responses, by a hash of the response.

    The responses are made once and handed over, so every response lands in one poll however its rows were dealt.
    """
    path = scratch_path(t.spark, "polls")
    made = scratch_path(t.spark, "responses")
    _responses(t).withColumn("poll", F.pmod(F.xxhash64(F.to_json("body")), F.lit(3))).write.parquet(made)
    responses = t.spark.read.parquet(made)
    for n in range(3):
        responses.where(F.col("poll") == n).drop("poll").write.json(f"{path}/poll={n}")
    return path


@query("SELECT event_type AS tag, event_id AS x, round(value, 6) AS value FROM events WHERE event_type IN ('click', 'purchase') AND value IS NOT NULL")
def a18_polled_source(t: Tables) -> DataFrame:
    """The source is asked for two tags: no point of another one leaves it."""
    return landed.poll_frame(t.spark, _polls(t), tags=["click", "purchase"]).select("tag", "x", _r("value"))


@query("SELECT event_type AS tag, count(*) AS n_points, round(sum(value), 4) AS total FROM events WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY 1")
def m1_polled_stream(t: Tables) -> DataFrame:
    """Each poll is streamed once, over restarts from the checkpoint."""
    path = _polls(t)
    points = landed.poll_frame(t.spark, path, stream=True)
    streams.drain(points, f"{path}/out")
    out = streams.drain(points, f"{path}/out")
    return out.groupBy("tag").agg(F.count(F.lit(1)).alias("n_points"), F.round(F.sum("value"), 4).alias("total"))


@query("""
SELECT event_type, count(*) FILTER (event_id % 13 <> 0) AS n_records, count(*) FILTER (event_id % 13 = 0) AS n_bad, round(sum(value) FILTER (event_id % 13 <> 0), 4) AS total FROM events GROUP BY 1
""")
def a12_drifting_panel(t: Tables) -> DataFrame:
    """The value is a number, a text, an object or an array, depending on the type; every thirteenth line is broken off."""
    v, head = F.col("value").cast("string"), F.concat(F.lit('{"type": "'), "event_type", F.lit('", "v": '))
    shaped = F.when(F.col("event_type") == "click", v).when(F.col("event_type") == "view", F.concat(F.lit('"'), v, F.lit('"'))).when(F.col("event_type") == "error", F.concat(F.lit('{"value": '), v, F.lit("}"))).otherwise(F.concat(F.lit("["), v, F.lit("]")))
    path = scratch_path(t.spark, "drifting")
    t.events.select(F.concat(head, shaped, F.when(F.col("event_id") % 13 == 0, "").otherwise("}")).alias("line")).write.text(path)
    records, bad = landed.drifting_panel(t.spark, path)
    field = landed.variant_field
    good = records.select(field(F.col("record"), ["$.type"], "string").alias("event_type"), field(F.col("record"), ["$.v.value", "$.v[0]", "$.v"], "double").alias("v"), F.lit(0).alias("bad"))
    lost = bad.select(F.regexp_extract("line", '"type": "([^"]*)"', 1).alias("event_type"), F.lit(None).cast("double").alias("v"), F.lit(1).alias("bad"))
    return good.unionByName(lost).groupBy("event_type").agg(F.count_if(F.col("bad") == 0).alias("n_records"), F.count_if(F.col("bad") == 1).alias("n_bad"), F.round(F.sum("v"), 4).alias("total"))


@query("SELECT event_type AS tag, user_id, event_id AS x, round(value, 6) AS value FROM events WHERE value IS NOT NULL")
def h13_variant_series(t: Tables) -> DataFrame:
    """Series of one response in different shapes: arrays of x and c, or pairs."""
    points = t.events.where("value is not null").groupBy("user_id", "event_type").agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("p"))
    arrays = F.to_json(F.struct(F.transform("p", lambda p: p["event_id"]).alias("x"), F.transform("p", lambda p: p["value"]).alias("c")))
    pairs = F.concat(F.lit("["), F.array_join(F.transform("p", lambda p: F.concat(F.lit("["), p["event_id"].cast("string"), F.lit(","), p["value"].cast("string"), F.lit("]"))), ","), F.lit("]"))
    one = F.concat(F.lit('"'), "event_type", F.lit('":'), F.when(F.col("event_type").isin("click", "view"), arrays).otherwise(pairs))
    bodies = points.groupBy("user_id").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(one), ","), F.lit("}")).alias("json"))
    series = landed.variant_series(bodies.withColumn("body", F.parse_json("json")), "body", ["user_id"])
    return series.select("tag", "user_id", "x", _r("value"))


@query("SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2, 3")
def a14_archive_upsert(t: Tables) -> DataFrame:
    """Three loads into one archive, the months' later orders last: the last arrival of a customer's month stays."""
    path = scratch_path(t.spark, "archive")
    o = t.orders.select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey", "o_orderkey", "o_orderdate")
    day = F.dayofmonth("o_orderdate")
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        scans.write_partitioned(o.where(part), path, ["o_orderpriority", "month"], ["o_orderpriority", "month", "o_custkey"], ["o_orderkey"], ["o_orderdate", "o_orderkey"])
    return t.spark.read.parquet(path).select("o_orderpriority", "month", "o_custkey", "o_orderkey")


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, last_day(max(o_orderdate)::DATE) < DATE '2000-06-30' - 720 AS dropped FROM orders GROUP BY 1
""")
def a17_retention(t: Tables) -> DataFrame:
    """The expired months of an archive are removed, the others are still there: both as the archive has them afterwards."""
    path = scratch_path(t.spark, "kept")
    t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).write.partitionBy("month").parquet(path)
    report = scans.drop_expired(t.spark, path, "month", dt.date(2000, 6, 30), 24, dry_run=False)
    gone = report.select(F.regexp_extract("folder", "month=([0-9-]+)", 1).alias("month"), "dropped")
    return gone.unionByName(t.spark.read.parquet(path).select(F.date_format(F.to_date("month"), "yyyy-MM").alias("month"), F.lit(False).alias("dropped")).distinct())


@query("""
SELECT table_name, place, column_name, n_rows FROM (
    SELECT 'orders_listed' AS table_name, cid::INT AS place, name AS column_name, (SELECT count(*) FROM orders) AS n_rows FROM pragma_table_info('orders')
    UNION ALL SELECT 'customer_listed', cid::INT, name, (SELECT count(*) FROM customer) FROM pragma_table_info('customer'))
""")
def a5_catalog(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders_listed")
    t.customer.createOrReplaceTempView("customer_listed")
    return scans.catalog_columns(t.spark, tables={"orders_listed", "customer_listed"}).select("table_name", "place", "column_name", "n_rows")


@query("SELECT event_type, count(*) AS n_rows, count(DISTINCT ts::DATE) AS n_days, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, count(DISTINCT hour(ts)) AS n_hours, true AS users_within_error FROM events WHERE ts IS NOT NULL GROUP BY 1")
def e8_merged_coverage(t: Tables) -> DataFrame:
    """Days are sketched one slice after the other and merged; the estimate of users is held against the exact count (four standard errors)."""
    path = scratch_path(t.spark, "days")
    for half in (F.dayofmonth("ts") <= 15, F.dayofmonth("ts") > 15):
        coverage.daily_sketches(t.events.where(half), ["event_type"], "ts", ["user_id"]).write.mode("append").partitionBy("day").parquet(path)
    merged = coverage.merged_coverage(t.spark.read.parquet(path), ["event_type"], ["user_id"])
    exact = t.events.where("ts is not null").groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    near = F.abs(F.col("n_user_id") - F.col("exact")) <= 4 * coverage.relative_error() * F.col("exact") + 1
    return merged.join(exact, "event_type").select("event_type", "n_rows", "n_days", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_ts"), "n_hours", near.alias("users_within_error"))


@query("""
SELECT count(*) AS rows_extracted, count(*) FILTER (value > 0) AS rows_loaded, count(*) FILTER (value IS NULL) AS failing_null_value, count(*) FILTER (value <= 0) AS failing_nonpositive, count(*) FILTER (value > 100) AS failing_above_limit FROM events
""")
def k1_observed_write(t: Tables) -> DataFrame:
    """The counts come from the job that writes the rows."""
    v = F.col("value")
    found = coverage.observed_write(t.events, scratch_path(t.spark, "observed"), {"null_value": v.isNull(), "nonpositive": v <= 0, "above_limit": v > 100}, keep=v > 0)
    return t.spark.createDataFrame([found], ", ".join(f"{name} long" for name in found))


@query("""
SELECT event_id, coalesce(CASE isodow(ts) WHEN 7 THEN hour(ts) >= 21 WHEN 5 THEN hour(ts) < 21 WHEN 6 THEN false ELSE ts IS NOT NULL END, false) AS is_open, event_type AS kind, user_id::VARCHAR AS who FROM events
""")
def u1_sql_surface(t: Tables) -> DataFrame:
    """Functions and the table function of tags (U3) called from one SQL text."""
    surface.register_functions(t.spark)
    t.events.createOrReplaceTempView("events_tagged")
    return t.spark.sql("""
        SELECT event_id, coalesce(fx_open(ts), false) AS is_open, a.kind, a.who FROM (SELECT *, concat(event_type, '.', user_id) AS tag FROM events_tagged) AS e, LATERAL tag_axes(e.tag, 'kind.who') AS a
        WHERE tag_part(e.tag, 1) = a.kind
    """)


@query(None)
def n1_indexed_search(t: Tables) -> DataFrame:
    first = t.embeddings.orderBy("vec_id").select("embedding").first()[0]  # one query vector
    chunks = t.embeddings.select(F.col("label").alias("report_id"), F.col("vec_id").alias("page"), F.col("embedding").alias("vector"))
    index = vector_index.build_index(chunks, scratch_path(t.spark, "index"))
    return vector_index.indexed_search(t.spark, index, list(first), 5, where=F.col("page") % 3 != 0).select("report_id", _r("best_score"), "best_page", "n_chunks")
