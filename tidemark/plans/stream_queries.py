"""Streams over the event table, landed and run in several slices of time, against their batch twins in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import prediction

from tidemark.plans.market_queries import ALERTS_SQL, WALK_SQL, alert_markets
from tidemark.plans.registry import Tables, query, stamp
from tidemark.session import scratch_path
from tidemark.streaming import stateful, streams


def _r(c: str, n: int = 6) -> F.Column:
    return F.round(F.col(c), n).alias(c)


SLICES = 3


def _landed(t: Tables, path: str, rows: DataFrame, ts: str = "ts") -> Iterator[DataFrame]:
    """The rows as a stream of landed files: yields the stream after each slice of time has landed, for a run up to there.

    Every run starts anew from the checkpoint of the one before. Rows without an instant land first.
    """
    low, high = rows.agg(F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))).first()
    width = ((high or 0) - (low or 0)) // SLICES + 1
    place = F.coalesce(F.floor((F.unix_micros(ts) - (low or 0)) / width), F.lit(0))
    for k in range(SLICES):
        rows.where(place == k).write.parquet(f"{path}/landed/{k}")
        yield t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{path}/landed")


def _run(t: Tables, name: str, make: Callable[[DataFrame], DataFrame], rows: DataFrame | None = None, batch: Callable | None = None) -> DataFrame | None:
    path, out = scratch_path(t.spark, name), None
    for stream in _landed(t, path, t.events if rows is None else rows):
        out = streams.drain(make(stream), path, batch=batch)
    return out


@query("""
SELECT user_id, event_type AS market, round(value / 100, 6) AS yes FROM events WHERE event_type <> 'error'
""")
def m1_polled_events(t: Tables) -> DataFrame:
    prices = F.to_json(F.array((F.col("value") / 100).cast("string"), (1 - F.col("value") / 100).cast("string")))
    market = F.struct(F.col("event_type").alias("market"), (F.col("event_type") == "error").alias("closed"), prices.alias("prices"))
    nested = t.events.select("user_id", "ts", F.array(market).alias("markets"))
    path = scratch_path(t.spark, "poll")
    _run(t, "poll", lambda stream: stream, nested, streams.poll_events(nested, ["user_id"], "markets", "prices", f"{path}/out", f"{path}/log"))
    return t.spark.read.parquet(f"{path}/out").select("user_id", "market", _r("yes"))


@query("""
WITH b AS (SELECT event_type, date_trunc('hour', ts) AS bar_ts, round(arg_min(value, (ts, value)), 6) AS open_px, max(value) AS high_px, min(value) AS low_px, round(arg_max(value, (ts, value)), 6) AS close_px, count(*) AS n_ticks FROM events GROUP BY 1, 2)
SELECT event_type, strftime(bar_ts, '%Y-%m-%d %H:%M:%S') AS bar_ts, open_px, high_px, low_px, close_px, n_ticks FROM b WHERE bar_ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def m2_hourly_bars(t: Tables) -> DataFrame:
    bars = _run(t, "bars", lambda stream: streams.stream_bars(stream, ["event_type"], "ts", "value"))
    return bars.select("event_type", stamp("bar_ts"), _r("open_px"), "high_px", "low_px", _r("close_px"), "n_ticks")


@query(f"""
WITH RECURSIVE {ALERTS_SQL},
n AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY ts) AS k FROM f),
{WALK_SQL}
SELECT n.event, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(price, 6) AS price, unnest(classes) AS alert_class, round(delta, 6) AS delta, round(drift, 6) AS drift, s.held, s.held IS NULL AS sent
FROM n JOIN s ON n.event = s.event AND n.k = s.k WHERE ts <= (SELECT max(date_trunc('hour', ts)) - INTERVAL 10 MINUTE FROM events)
""")
def m3_alert_stream(t: Tables) -> DataFrame:
    markets = alert_markets(t)
    modal = F.row_number().over(Window.partitionBy("event", "ts").orderBy(F.desc("price"), "market")) == 1
    found = _run(t, "alerts", lambda stream: stateful.stream_alerts(stream, "event", "market", "ts", "price", "volume", "spread", "modal"), markets.withColumn("modal", modal))
    return prediction.alert_log(found).select("event", stamp("ts"), _r("price"), "alert_class", _r("delta"), _r("drift"), "held", "sent")


_MOVES = "SELECT user_id, ts, v, lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM (SELECT user_id, ts, event_id, floor(value / 50) AS v FROM events)"
_CLOSED = "ts <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(f"SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, v::DOUBLE AS v FROM ({_MOVES}) WHERE (b IS NULL OR b <> v) AND {_CLOSED}")
def m4_changes_only(t: Tables) -> DataFrame:
    rows = t.events.withColumn("v", F.floor(F.col("value") / 50))
    moves = _run(t, "moves", lambda stream: stateful.stream_changes(stream, "user_id", "ts", "v", tie="event_id"), rows)
    return moves.select("user_id", stamp("ts"), "v")


@query(f"""
WITH seed AS (SELECT c_custkey AS user_id, floor(c_acctbal / 50) AS v FROM customer WHERE c_acctbal IS NOT NULL), m AS ({_MOVES}), p AS (SELECT m.user_id, m.ts, m.v, coalesce(b, seed.v) AS b FROM m LEFT JOIN seed ON m.user_id = seed.user_id)
SELECT user_id, sum(v - b)::DOUBLE AS moved, count(*) AS n_trades FROM p WHERE b <> v AND {_CLOSED} GROUP BY 1
""")
def m5_trade_deltas(t: Tables) -> DataFrame:
    seed = t.customer.select(F.col("c_custkey").alias("user_id"), F.floor(F.col("c_acctbal") / 50).alias("v"))
    rows = t.events.withColumn("v", F.floor(F.col("value") / 50))
    trades = _run(t, "trades", lambda stream: stateful.stream_changes(stream, "user_id", "ts", "v", tie="event_id", seed=seed), rows)
    return trades.where("prev_value is not null").groupBy("user_id").agg(F.sum(F.col("v") - F.col("prev_value")).alias("moved"), F.count(F.lit(1)).alias("n_trades"))


@query("SELECT DISTINCT user_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def m6_replay_once(t: Tables) -> DataFrame:
    """Every slice lands twice: the second time it is a replay and must append nothing."""
    path, out = scratch_path(t.spark, "once"), None
    hours = t.events.select("user_id", "event_type", F.date_trunc("hour", "ts").alias("ts"))
    for k, stream in enumerate(_landed(t, path, hours)):
        once = streams.stream_once(stream, ["user_id", "event_type", "ts"], "ts", "40 days")
        streams.drain(once, path)
        t.spark.read.schema(hours.schema).parquet(f"{path}/landed/{k}").write.parquet(f"{path}/landed/{k}-again")
        out = streams.drain(once, path)
    return out.select("user_id", "event_type", stamp("ts"))


@query("""
WITH l AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type IN ('click', 'view') AND ts < TIMESTAMP '2024-01-20')
SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events e WHERE ts < (SELECT max(ts) FROM l) AND NOT EXISTS (SELECT 1 FROM l WHERE l.user_id = e.user_id AND l.ts = e.ts)
""")
def m7_late_backfill(t: Tables) -> DataFrame:
    live = t.events.where("event_type in ('click', 'view') and ts < '2024-01-20'")
    path = scratch_path(t.spark, "backfill")
    ends = [F.lit(d).cast("timestamp") for d in ("2000-01-01", "2100-01-01")]
    _run(t, "backfill", lambda stream: stream.select("user_id", "ts"), None, streams.backfill_sink(f"{path}/out", live, ["user_id"], "ts", *ends))
    return t.spark.read.parquet(f"{path}/out").select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("SELECT event_type, user_id, round(arg_max(value, (ts, event_id)), 6) AS value FROM events GROUP BY 1, 2")
def m8_upsert_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "upsert")
    _run(t, "upsert", lambda stream: stream.select("event_type", "user_id", "value", "ts", "event_id"), None, streams.upsert_sink(f"{path}/table", ["event_type", "user_id"], ["event_type"], ["ts", "event_id"]))
    return t.spark.read.parquet(f"{path}/table").select("event_type", "user_id", _r("value"))


@query("""
WITH e AS (SELECT *, event_id % 5 = 0 AS held_back, epoch_us(ts) AS us FROM events), s AS (SELECT min(us) AS low, (max(us) - min(us)) // 3 + 1 AS width FROM e),
p AS (SELECT e.*, least((us - low) // width + held_back::INT, 2) AS slice FROM e, s), m AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM p GROUP BY 1)
SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bar_ts, round(arg_min(value, (ts, value)), 6) AS open_px, max(value) AS high_px, min(value) AS low_px, round(arg_max(value, (ts, value)), 6) AS close_px, round(avg(value), 6) AS mean_px, count(*) AS n_ticks,
    count(*) FILTER (ts < mark - INTERVAL 10 MINUTE) AS n_late FROM p JOIN m USING (slice) WHERE value IS NOT NULL GROUP BY 1, 2
""")
def m8_late_revision(t: Tables) -> DataFrame:
    """A fifth of the ticks come a slice late, with the next slice: their bars are corrected, and each is known as late."""
    low, high = t.events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = (high - low) // SLICES + 1
    arrival = F.least(F.floor((F.unix_micros("ts") - low) / width) + (F.col("event_id") % 5 == 0).cast("int"), F.lit(SLICES - 1))
    rows = t.events.withColumn("arrived", F.timestamp_micros(arrival * width + low))
    path = scratch_path(t.spark, "revised")
    for stream in _landed(t, path, rows, "arrived"):
        streams.drain(stream, path, batch=streams.bars_sink(path, ["event_type"], "ts", "value"))
    bars = streams.merged_bars(t.spark.read.parquet(f"{path}/bars"), ["event_type"])
    return bars.select("event_type", stamp("bar_ts"), _r("open_px"), "high_px", "low_px", _r("close_px"), _r("mean_px"), "n_ticks", "n_late")


@query("""
WITH w AS (SELECT event_type, unnest(generate_series(date_trunc('day', ts), date_trunc('day', ts) + INTERVAL 6 DAY, INTERVAL 1 DAY)) + INTERVAL 1 DAY AS window_end, value FROM events WHERE value > 0)
SELECT event_type, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, round(avg(value), 6) AS baseline, count(*) AS n FROM w WHERE window_end <= (SELECT max(ts) FILTER (value > 0) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2
""")
def m9_stream_baseline(t: Tables) -> DataFrame:
    base = _run(t, "baseline", lambda stream: streams.stream_baseline(stream, ["event_type"], "ts", "value"))
    return base.select("event_type", stamp("window_end"), _r("baseline"), "n")
