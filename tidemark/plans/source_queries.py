"""Queries for reading and writing landed files, and for the text columns of vendor rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators import documents, reports, series
from tidemark.plans.registry import Tables, query, stamp
from tidemark.session import scratch_path
from tidemark.sources import scans


def _r(c: str, n: int = 6) -> Column:
    return F.round(F.col(c), n).alias(c)


def _day(c: str, name: str | None = None) -> Column:
    return F.col(c).cast("date").alias(name or c)


@query("""
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice >= 100000 GROUP BY 1
""")
def a3_sql_frame(t: Tables) -> DataFrame:
    sql = "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} WHERE o_totalprice >= :least GROUP BY 1"
    return scans.sql_frame(t.spark, sql, {"least": 100_000}, orders=t.orders)


@query("""
SELECT 'orders' AS table_name, (SELECT count(*) FROM (DESCRIBE orders)) AS n_columns, count(*) AS n_rows FROM orders UNION ALL
SELECT 'lineitem', (SELECT count(*) FROM (DESCRIBE lineitem)), count(*) FROM lineitem UNION ALL SELECT 'events', (SELECT count(*) FROM (DESCRIBE events)), count(*) FROM events
UNION ALL SELECT 'documents', (SELECT count(*) FROM (DESCRIBE documents)), count(*) FROM documents
""")
def a5_table_sizes(t: Tables) -> DataFrame:
    return scans.table_sizes({name: getattr(t, name) for name in ("orders", "lineitem", "events", "documents")})


@query("""
SELECT o_orderkey, o_orderstatus, coalesce(n_name, 'unknown') AS n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
WHERE o_orderstatus IN ('F', 'P') AND o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
""")
def a6_partitioned_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "archive")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", _day("o_orderdate", "d"))
    orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").write.partitionBy("o_orderstatus").parquet(path)
    dim = t.nation.where("n_regionkey != 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    days = [F.lit(d).cast("date") for d in ("1996-01-01", "1999-12-31")]
    out = scans.partitioned_scan(t.spark, path, {"o_orderstatus": ["F", "P"]}, date="d", start=days[0], end=days[1], dim=dim, on=["c_nationkey"], label="n_name")
    return out.select("o_orderkey", "o_orderstatus", "n_name")


def _sheets(t: Tables, kind: Column) -> str:
    """Land the events as a sheet for each type: rows are days, columns hours with the sums (BID) and one more (ASK)."""
    cells = t.events.groupBy("event_type", _day("ts", "d"), F.hour("ts").alias("h")).agg(F.round(F.sum("value"), 4).alias("v"))
    hours = [str(h) for h in range(24)]
    wide = cells.groupBy("event_type", "d").pivot("h", list(range(24))).agg(F.max("v"))
    pairs = [x for h in hours for x in (F.coalesce(F.col(h).cast("string"), F.lit("")), F.coalesce((F.col(h) + 1).cast("string"), F.lit("")))]
    line = F.concat_ws(",", F.date_format("d", "dd/MM/yyyy"), *pairs)
    body = wide.groupBy("event_type").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    heads = [",".join(["date"] + [f(h, side) for h in hours for side in ("BID", "ASK")]) for f in (lambda h, s: f"T{h} Curncy", lambda h, s: f"H{h}", lambda h, s: s)]
    path = scratch_path(t.spark, "sheets")
    body.select(F.concat(F.lit("\n".join(heads) + "\n"), "lines").alias("value"), F.concat_ws("_", F.upper("event_type"), F.lit("SUM"), kind).alias("folder")).write.partitionBy("folder").text(path)
    return path


_SHEET_SQL = "SELECT event_type, ts::DATE AS d, hour(ts) AS h, round(sum(value), 4) AS v FROM events GROUP BY 1, 2, 3"


@query(f"""
WITH c AS ({_SHEET_SQL}), f AS (SELECT 'BID' AS field, 0 AS plus UNION ALL SELECT 'ASK', 1)
SELECT upper(event_type) AS sheet, d AS obs_date, 'T' || h || ' Curncy' AS ticker, 'H' || h AS alias, field, round(v + plus, 4) AS value FROM c, f
""", dates=("obs_date",))
def a7_three_header_sheets(t: Tables) -> DataFrame:
    cells = scans.three_header_csv(t.spark, _sheets(t, F.lit("live")))
    return cells.select(F.regexp_extract("path", r"folder=([A-Z]+)_", 1).alias("sheet"), "obs_date", "ticker", "alias", "field", _r("value", 4))


@query(f"""
WITH c AS ({_SHEET_SQL}), s AS (SELECT o_orderdate::DATE + INTERVAL 9131 DAY AS d, count(*) AS spot FROM orders GROUP BY 1)
SELECT upper(event_type) AS sheet, c.d AS obs_date, 'H' || h AS alias, round(v + 0.5, 4) AS mid, round(v + 0.5 - spot, 4) AS points FROM c JOIN s ON c.d = s.d::DATE
""", dates=("obs_date",))
def a8_sheet_quotes(t: Tables) -> DataFrame:
    spot = t.orders.groupBy(F.date_add(_day("o_orderdate"), 9131).alias("obs_date")).agg(F.count(F.lit(1)).alias("spot"))
    quotes = scans.sheet_quotes(scans.three_header_csv(t.spark, _sheets(t, F.lit("live"))), "BID", "ASK", spot)
    return quotes.select(F.regexp_extract("path", r"folder=([A-Z]+)_", 1).alias("sheet"), "obs_date", "alias", _r("mid", 4), _r("points", 4))


@query(f"""
WITH c AS ({_SHEET_SQL}), l AS (SELECT *, max(d) OVER (PARTITION BY event_type) AS last FROM c)
SELECT upper(event_type) AS ccy, 'SUM' AS curve, CASE WHEN event_type IN ('click', 'view') THEN 'historical' ELSE 'live' END AS curve_type, d AS obs_date, 'H' || h AS alias, round(v, 4) AS value
FROM l WHERE d = last OR event_type IN ('click', 'view')
""", dates=("obs_date",))
def a9_curve_folders(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "view"), "historical").otherwise("live")
    cells = scans.three_header_csv(t.spark, _sheets(t, kind)).withColumn("path", F.regexp_replace("path", "folder=", ""))
    cells = cells.where("field = 'BID'").select("path", *scans.folder_axes(F.col("path")), "obs_date", "alias", _r("value", 4))
    live = scans.live_only(cells.where("curve_type = 'live'"), ["path"], "obs_date")
    return live.unionByName(cells.where("curve_type = 'historical'")).drop("path")


@query(f"""
SELECT d AS obs_date, event_type AS kind, h::VARCHAR AS hour_label, v AS value FROM ({_SHEET_SQL}) WHERE event_type <> 'error'
""", dates=("obs_date",))
def a10_axes_from_headers(t: Tables) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    names = [f"x{h}y error" if k == "error" else f"{k}_H{h}" for k in kinds for h in range(24)]  # headers that do not match are left out
    label = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.hour("ts").cast("string"), F.lit("y error"))).otherwise(F.concat("event_type", F.lit("_H"), F.hour("ts").cast("string")))
    cells = t.events.groupBy(_day("ts", "obs_date"), label.alias("label")).agg(F.round(F.sum("value"), 4).alias("v"))
    wide = cells.groupBy("obs_date").pivot("label", names).agg(F.max("v"))
    return reports.wide_skew_to_long(wide, "obs_date", r"^([a-z]+)_H(\d+)$", ["kind", "hour_label"]).where("value is not null")


def _responses(t: Tables) -> DataFrame:
    """The events as vendor responses, one for each user: a map from type to instants and values; errors are failed series."""
    points = t.events.groupBy("user_id", "event_type").agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("p"))
    one = F.struct(F.when(F.col("event_type") == "error", "ERROR").otherwise("SERIES").alias("type"), F.transform("p", lambda p: p["event_id"]).alias("x"), F.transform("p", lambda p: p["value"]).alias("c"))
    return points.groupBy("user_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", one)))).alias("body")).select(F.lit("OK").alias("status"), "body")


@query("SELECT event_type AS tag, event_id AS x, round(value, 6) AS value FROM events WHERE event_type <> 'error' AND value IS NOT NULL")
def a11_series_response(t: Tables) -> DataFrame:
    return scans.series_response(_responses(t)).select("tag", "x", _r("value"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def a12_json_panel(t: Tables) -> DataFrame:
    whole = F.to_json(F.struct("event_id", "user_id", "event_type"))
    path = scratch_path(t.spark, "panel")
    t.events.select(F.when(F.col("event_type") == "error", F.substring(whole, 1, 12)).otherwise(whole).alias("value")).write.text(path)  # a bad line for each error
    good, _ = scans.json_panel(t.spark, path, "event_id long, user_id long, event_type string")
    return good


@query("""
SELECT o_custkey, o_orderdate::DATE AS d, max(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1, 2
""", dates=("d",))
def a13_snapshot_read(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", _day("o_orderdate", "d"), "o_orderkey", "o_totalprice")
    keys = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return reports.snapshot_read(o, keys, "o_custkey", "d", F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date"), "o_orderkey").select("o_custkey", "d", "o_orderkey")


@query("""
SELECT c_mktsegment AS segment, count(DISTINCT c_custkey) AS n_customers, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def a15_dim_fact_pair(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pair")
    scans.write_pair(t.customer, t.orders, path, "20240101T000000")
    dim, fact = (t.spark.read.parquet(f"{path}/{kind}") for kind in ("dim", "fact"))
    return dim.join(fact, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.countDistinct("c_custkey").alias("n_customers"), F.count("o_orderkey").alias("n_orders"))


@query("""
SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'
""")
def a19_latest_pair(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pair")
    scans.write_pair(t.customer, t.orders.where("o_orderstatus = 'F'"), path, "20240101T000000")
    scans.write_pair(t.customer, t.orders.where("o_orderstatus != 'P'"), path, "20240102T000000")
    dim, fact = scans.latest_pair(t.spark, path)
    return fact.join(dim, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@query("SELECT 'X' || event_type AS symbol, event_id AS id, round(value, 6) AS close_px FROM events")
def a16_migrate_bars(t: Tables) -> DataFrame:
    old = t.events.select(F.concat(F.lit(".X."), "event_type").alias("sym"), "event_id", F.round("value", 6).alias("close"))
    return scans.migrate_bars(old, {"sym": "symbol", "event_id": "id", "close": "close_px"}, ["symbol", "id", "close_px"])


@query("""
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE last_day(o_orderdate::DATE) < DATE '2000-06-30' - 30 * 24
""")
def a17_expired_partitions(t: Tables) -> DataFrame:
    return scans.expired_partitions(t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month")), "month", F.lit("2000-06-30").cast("date"), 24)


@query("SELECT event_type AS tag, event_id AS x, round(value, 6) AS value FROM events WHERE event_type <> 'error' AND value IS NOT NULL")
def a18_landed_responses(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "responses")
    _responses(t).write.json(path)
    return scans.landed_responses(t.spark, path).select("tag", "x", _r("value"))


_STAMPS = "CASE event_type WHEN 'click' THEN date_trunc('month', ts) WHEN 'view' THEN date_trunc('day', ts) WHEN 'error' THEN date_trunc('hour', ts) WHEN 'purchase' THEN date_trunc('hour', ts) + INTERVAL 10 MINUTE * (minute(ts) // 10) ELSE date_trunc('minute', ts) END"


@query(f"SELECT event_id, strftime({_STAMPS}, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def b1_digit_stamps(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    written = F.date_format("ts", "yyyyMMddHHmm")
    cut = F.substring(written, F.lit(1), F.when(kind == "click", 6).when(kind == "view", 8).when(kind == "error", 10).when(kind == "purchase", 11).otherwise(12))
    return t.events.select("event_id", parse.parse_stamp(cut).alias("at")).select("event_id", stamp("at"))


@query("SELECT p_partkey, p_retailprice AS price FROM part")
def b4_first_number(t: Tables) -> DataFrame:
    cell = F.concat(F.lit("USD "), F.format_number("p_retailprice", 2), F.lit(" a piece, size "), F.col("p_size").cast("string"))
    return t.part.select("p_partkey", parse.first_number(cell).alias("price"))


@query("SELECT p_partkey, p_size::VARCHAR AS value, p_type = 'PROMO' AS is_revised FROM part")
def b5_split_revised(t: Tables) -> DataFrame:
    value, revised = parse.split_revised(F.concat(F.col("p_size").cast("string"), F.when(F.col("p_type") == "PROMO", " *").otherwise("")))
    return t.part.select("p_partkey", value.alias("value"), revised.alias("is_revised"))


@query("""
SELECT doc_id, sha256(regexp_replace(trim(translate(lower(coalesce(text, '')), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS h FROM documents
""")
def b6_normal_names(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha2(parse.normalize_name(F.coalesce("text", F.lit(""))), 256).alias("h"))


@query("""
SELECT p_partkey, CASE WHEN p_size > 30 THEN p_size || 'y' || 's' || (p_size % 12 + 1) || 'm' ELSE (p_size % 12 + 1) || 'M' END AS tenor, CASE WHEN p_size > 30 THEN p_size || 'Y,' ELSE '' END || (p_size % 12 + 1) || 'M' AS legs FROM part
""")
def b8_tenor_codec(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    tenor = parse.encode_tenor(F.when(F.col("p_size") > 30, F.concat(size, F.lit("Y"))), F.concat((F.col("p_size") % 12 + 1).cast("string"), F.lit("m")))
    return t.part.select("p_partkey", tenor.alias("tenor")).withColumn("legs", F.array_join(parse.decode_tenor(F.col("tenor")), ","))


@query("""
SELECT p_partkey, CASE WHEN p_size > 5 THEN 'RATES' END AS family, CASE WHEN p_size > 5 THEN p_brand END AS ccy, CASE WHEN p_size > 5 THEN p_type END AS curve, CASE WHEN p_size > 5 THEN p_size::VARCHAR END AS tenor FROM part
""")
def b9_tag_axes(t: Tables) -> DataFrame:
    tag = F.concat_ws(".", F.lit("RATES"), "p_brand", "p_type", F.when(F.col("p_size") > 5, F.col("p_size").cast("string")))
    return t.part.select("p_partkey", *parse.tag_axes(tag, "family", "ccy", "curve", "tenor"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'forward' WHEN 'SMALL' THEN 'implied' WHEN 'LARGE' THEN 'implied' END AS product, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN p_brand END AS rest FROM part
""")
def b10_index_products(t: Tables) -> DataFrame:
    found = reports.index_series(F.concat_ws(".", "p_type", "p_brand"), {"forward": r"^PROMO\.(.+)$", "implied": r"^(?:SMALL|LARGE)\.(.+)$"})
    return t.part.select("p_partkey", found.alias("f")).select("p_partkey", "f.product", "f.rest")


@query("SELECT p_partkey, CASE WHEN p_size >= 12 AND p_size % 12 = 0 THEN (p_size // 12) || 'Y' ELSE p_size || 'M' END AS tenor FROM part")
def b11_normal_tenors(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", parse.normalize_tenor(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("m"))).alias("tenor"))


@query("SELECT l_orderkey, l_linenumber, round((l_extendedprice * (1 + l_tax) - l_extendedprice * (1 - l_discount)) / nullif(l_extendedprice, 0) * 10000, 4) AS bps FROM lineitem")
def b14_spread_bps(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(parse.spread_bps(price * (1 - F.col("l_discount")), price * (1 + F.col("l_tax")), price), 4).alias("bps"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'beat' WHEN l_quantity < 25 THEN 'miss' ELSE 'neutral' END AS outcome FROM lineitem")
def b15_beat_miss(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", parse.beat_miss(F.concat(F.col("l_quantity").cast("string"), F.lit("K")), F.lit("25.0K")).alias("outcome"))


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN p_size::DOUBLE WHEN p_type = 'PROMO' THEN 100.0 WHEN p_type = 'LARGE' THEN 60.0 WHEN p_type = 'SMALL' THEN 20.0 END AS relevance FROM part")
def b16_relevance(t: Tables) -> DataFrame:
    label = F.when(F.col("p_size") > 40, F.concat(F.lit("rel. "), F.col("p_size").cast("string")))
    tier = F.when(F.col("p_type") == "PROMO", "policy").otherwise(F.lower("p_type"))
    return t.part.select("p_partkey", parse.relevance(label, tier, {"large": 60.0, "small": 20.0}).alias("relevance"))


@query("SELECT event_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE AS d FROM events", dates=("d",))
def b17_local_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", parse.local_date(F.col("ts"), "America/New_York").alias("d"))


@query("""
WITH e AS (SELECT event_type, min(date_trunc('hour', ts)) AS a, max(ts) AS b FROM events GROUP BY 1)
SELECT event_type, strftime(unnest(generate_series(a, date_trunc('hour', b) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)), '%Y-%m-%d %H:%M:%S') AS start FROM e
""")
def b18_hour_windows(t: Tables) -> DataFrame:
    ends = t.events.groupBy("event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("event_type", F.explode(parse.hour_starts(F.col("a"), F.col("b"))).alias("start")).select("event_type", stamp("start"))


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN last_day(d) WHEN '2-HIGH' THEN make_date(year(d), month(d), 15) WHEN '3-MEDIUM' THEN make_date(year(d), month(d), day(d))
    WHEN '5-LOW' THEN last_day(make_date(year(d), quarter(d) * 3, 1)) ELSE make_date(year(d), 12, 31) END AS due FROM (SELECT *, o_orderdate::DATE + 3652 AS d FROM orders)
""", dates=("due",))
def b20_question_dates(t: Tables) -> DataFrame:
    d = F.date_add(_day("o_orderdate"), 3652)
    month, year = F.date_format(d, "MMMM"), F.year(d).cast("string")
    asked = {"1-URGENT": F.concat(F.lit("Above 4% by the end of "), month, F.lit("?")), "2-HIGH": F.concat(F.lit("A cut at the "), month, F.lit(" meeting?")), "3-MEDIUM": F.concat(F.lit("A hike on "), month, F.lit(" "), F.dayofmonth(d).cast("string"), F.lit("?")), "5-LOW": F.concat(F.lit("Recession in Q"), F.quarter(d).cast("string"), F.lit("?"))}
    question = F.coalesce(*[F.when(F.col("o_orderpriority") == k, v) for k, v in asked.items()], F.concat(F.lit("Default before "), year, F.lit("?")))
    return t.orders.select("o_orderkey", parse.question_date(question, F.year(d)).alias("due"))


@query("SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'Rings' WHEN p_name LIKE '%hot%' THEN 'Warm' WHEN p_name LIKE '%bolt%' THEN 'Fixings' ELSE 'Other' END AS region FROM part")
def b22_canonical_regions(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", parse.first_rule(F.upper("p_name"), [("ring", "Rings"), ("hot", "Warm"), ("bolt", "Fixings")], "Other").alias("region"))


@query("""
WITH p AS (SELECT p_partkey, p_name, (p_name LIKE '%red%')::INT + (p_name LIKE '%bolt%')::INT + (p_name LIKE '%gear%')::INT AS n FROM part)
SELECT p_partkey, CASE WHEN n = 1 AND p_name NOT LIKE '%large%' THEN CASE WHEN p_name LIKE '%red%' THEN 'RED' WHEN p_name LIKE '%bolt%' THEN 'BOLT' ELSE 'GEAR' END END AS country FROM p
""")
def b23_single_country(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", parse.single_match(F.col("p_name"), {"RED": r"\bred\b", "BOLT": r"\bbolt\b", "GEAR": r"\bgear\b"}, r"\blarge\b").alias("country"))


@query("""
SELECT conv_id, turn, CASE WHEN lower(text) LIKE '%the%' THEN 'minutes' WHEN lower(text) LIKE '%une%' THEN 'decision' WHEN lower(text) LIKE '%?%' THEN 'question' END AS kind FROM conversations
""")
def b24_event_kinds(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", parse.first_rule(F.col("text"), [("the", "minutes"), ("une", "decision"), ("?", "question")]).alias("kind"))


@query("""
SELECT p_partkey, CASE WHEN p_type = 'PROMO' AND p_name LIKE '%hot%' THEN 'credit' WHEN p_type = 'PROMO' THEN 'macro' WHEN p_type = 'SMALL' AND p_name LIKE '%ring%' THEN 'rates' ELSE 'other' END AS doc_class FROM part
""")
def b26_document_classes(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([(0, "PROMO", r"\bhot\b", "credit"), (1, "PROMO", ".", "macro"), (0, "SMALL", "ring", "rates")], "rule_place int, rule_hub string, rule_pattern string, rule_class string")
    return reports.classify_documents(t.part.select("p_partkey", "p_type", "p_name"), rules, "p_type", "p_name").select("p_partkey", "doc_class")


@query("SELECT c_custkey, c_name || '|' || c_mktsegment || '|N' || c_nationkey AS names FROM customer")
def b28_author_lists(t: Tables) -> DataFrame:
    raw = F.concat("c_name", F.lit(" ,"), "c_mktsegment", F.lit(" and N"), F.col("c_nationkey").cast("string"), F.lit("; "), "c_name")
    return t.customer.select("c_custkey", F.array_join(parse.authors(raw), "|").alias("names"))


@query("SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN 'L' WHEN 'SMALL' THEN 'S' ELSE p_type END AS code, round(p_retailprice / 1000, 6) AS thousands FROM part")
def b29_aliases_and_units(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", parse.aliased(F.col("p_type"), {"LARGE": "L", "SMALL": "S"}).alias("code"), F.round(F.col("p_retailprice") / 1000, 6).alias("thousands"))


@query("SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN 'Big' WHEN 'SMALL' THEN 'Little' END AS canonical, CASE p_type WHEN 'LARGE' THEN 'A' WHEN 'SMALL' THEN 'B' END AS tier FROM part")
def b30_basket(t: Tables) -> DataFrame:
    dim = t.spark.createDataFrame([("large ", "Big", "A"), ("Small", "Little", "B")], "raw_name string, canonical string, tier string")
    return reports.basket(t.part, dim, "p_type").select("p_partkey", "canonical", "tier")


@query("SELECT event_id, CASE WHEN hour(ts) >= 18 THEN 18 WHEN hour(ts) >= 12 THEN 12 WHEN hour(ts) >= 7 THEN 7 ELSE 18 END AS slot, ts::DATE - (hour(ts) < 7)::INT AS slot_date FROM events", dates=("slot_date",))
def b33_load_passes(t: Tables) -> DataFrame:
    before = F.hour("ts") < 7
    return t.events.select("event_id", parse.pass_hour(F.col("ts"), (7, 12, 18)).alias("slot"), F.when(before, F.date_sub(_day("ts"), 1)).otherwise(_day("ts")).alias("slot_date"))


def _cells(t: Tables) -> DataFrame:
    """The order totals as sheets of cells, a sheet for each status: priorities down, months across, the year over the first month only."""
    first = t.orders.agg(F.min(F.year("o_orderdate")).alias("y0"))
    at = t.orders.crossJoin(F.broadcast(first)).select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), (F.year("o_orderdate") * 12 + F.month("o_orderdate") - F.col("y0") * 12).alias("col"))
    sums = at.groupBy("o_orderstatus", "o_orderpriority", "y", "m", "col").agg(F.count(F.lit(1)).alias("n"))
    heads = sums.select("o_orderstatus", "y", "m", "col").distinct()
    left = heads.groupBy("o_orderstatus").agg(F.min(F.struct("col", "y")).alias("a"))
    cell = lambda row, col, text: (row.cast("int").alias("row"), col.cast("int").alias("col"), text.cast("string").alias("text"))
    place = F.substring("o_orderpriority", 1, 1).cast("int") + 1
    parts = [
        left.select("o_orderstatus", *cell(F.lit(0), F.col("a.col"), F.col("a.y"))),
        heads.select("o_orderstatus", *cell(F.lit(1), F.col("col"), F.col("m"))),
        sums.select("o_orderstatus", "o_orderpriority").distinct().select("o_orderstatus", *cell(place, F.lit(0), F.col("o_orderpriority"))),
        sums.select("o_orderstatus", *cell(place, F.col("col"), F.col("n"))),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_MONTHLY = "SELECT o_orderstatus, o_orderpriority AS label, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*)::DOUBLE AS value FROM orders GROUP BY 1, 2, 3, 4"


@query(f"SELECT o_orderstatus, year, month, sum(value) AS total FROM ({_MONTHLY}) GROUP BY 1, 2, 3")
def b34_years_by_rollover(t: Tables) -> DataFrame:
    return documents.matrix_to_long(_cells(t), "o_orderstatus", 0, 1, 2, 0).groupBy("o_orderstatus", "year", "month").agg(F.sum("value").alias("total"))


@query(_MONTHLY)
def n11_matrix_sheets(t: Tables) -> DataFrame:
    return documents.matrix_to_long(_cells(t), "o_orderstatus", 0, 1, 2, 0)


@query("SELECT event_id, value / 1000 > 0.3 OR value / 1000 / greatest(least(value / 600, 1 - value / 600), 0.05) > 0.5 AS illiquid FROM events")
def b35_liquidity(t: Tables) -> DataFrame:
    return t.events.select("event_id", parse.is_illiquid(F.col("value") / 1000, F.col("value") / 600).alias("illiquid"))


@query("SELECT o_orderkey, o_orderdate::DATE AS d FROM orders", dates=("d",))
def b37_text_dates(t: Tables) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    text = F.when(p == "1", F.date_format("o_orderdate", "d MMM yyyy")).when(p == "2", F.date_format("o_orderdate", "MMMM d, yyyy")).when(p == "3", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "d-MMM-yyyy"))
    return t.orders.select("o_orderkey", parse.parse_text_date(text).alias("d"))


@query("SELECT trim(o_orderstatus) AS market, o_orderdate::DATE AS d, round(o_totalprice, 2) AS price FROM orders WHERE o_orderpriority <> '5-LOW'", dates=("d",))
def n12_price_rows(t: Tables) -> DataFrame:
    date = F.when(F.col("o_orderpriority") == "5-LOW", "n.a.").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    raw = t.orders.select(F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("market"), date.alias("d"), F.format_number("o_totalprice", 2).alias("price"))
    return reports.clean_price_rows(raw, "price", "d", ["market"]).select("market", "d", _r("price", 2))


@query("SELECT p_partkey, 'retail' AS measure, round(p_retailprice, 2) AS value FROM part UNION ALL SELECT p_partkey, 'size', p_size::DOUBLE FROM part WHERE p_type <> 'PROMO'")
def j14_measures_to_rows(t: Tables) -> DataFrame:
    wide = t.part.select("p_partkey", F.round("p_retailprice", 2).alias("retail"), F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("double")).alias("size"))
    return series.wide_to_long(wide, ["p_partkey"], ["retail", "size"], "measure")
