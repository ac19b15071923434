"""Streams over files that land in several slices, each run anew from the checkpoint, against their batch twins."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import prediction
from tidemark.streaming import stateful, streams

SCHEMA = "k string, ts timestamp, v double"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def _slices(spark, tmp_path, slices, make, schema=SCHEMA, **options):
    """Land each slice, run the stream over what is there, and return the sink's rows at the end."""
    out = None
    for k, rows in enumerate(slices):
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "in" / str(k)))
        source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        out = streams.drain(make(source), str(tmp_path / "out"), **options)
    return out


def test_moves_carry_over_batches_and_restarts(spark, tmp_path):
    values = [1.0, 1.0, 2.0, 2.0, 1.0, 1.0, 3.0, 3.0, 3.0, 1.0]
    rows = [("a", at(10 * m), v) for m, v in enumerate(values)] + [("z", at(10 * m), 5.0) for m in range(12)]
    rows.sort(key=lambda r: r[1])
    out = _slices(spark, tmp_path, [rows[:8], rows[8:14], rows[14:]], lambda s: stateful.stream_changes(s, "k", "ts", "v"))
    got = [(r.k, r.v, r.prev_value) for r in out.orderBy("ts", "k").collect()]
    assert got == [("a", 1.0, None), ("z", 5.0, None), ("a", 2.0, 1.0), ("a", 1.0, 2.0), ("a", 3.0, 1.0), ("a", 1.0, 3.0)]


def test_rows_of_one_batch_are_taken_in_time_order_and_late_ones_go(spark, tmp_path):
    first = [("a", at(5), 2.0), ("a", at(0), 1.0), ("a", at(9), 2.0), ("b", at(120), 7.0)]
    second = [("a", at(8), 99.0), ("a", at(130), 3.0), ("b", at(300), 7.0)]
    out = _slices(spark, tmp_path, [first, second], lambda s: stateful.stream_changes(s, "k", "ts", "v"))
    assert [(r.k, r.v, r.prev_value) for r in out.orderBy("ts").collect()] == [("a", 1.0, None), ("a", 2.0, 1.0), ("b", 7.0, None), ("a", 3.0, 2.0)]


def test_trades_start_from_a_snapshot_and_forget_the_silent(spark, tmp_path):
    seed = spark.createDataFrame([("a", 4.0), ("a", 5.0), ("b", 1.0), ("c", None)], "k string, v double")
    slices = [[("a", at(0), 5.0), ("a", at(10), 6.0), ("c", at(11), 2.0)], [("z", at(24 * 60), 1.0)], [("a", at(24 * 60 + 30), 6.0), ("z", at(48 * 60), 1.0)]]
    out = _slices(spark, tmp_path, slices, lambda s: stateful.stream_changes(s, "k", "ts", "v", keep_hours=6, seed=seed))
    got = [(r.k, r.v, r.prev_value) for r in out.orderBy("ts").collect()]
    assert got == [("a", 6.0, 5.0), ("c", 2.0, None), ("z", 1.0, None), ("a", 6.0, None)]  # a was forgotten, and counts as new


WALK, BASELINES = 0, 1  # the stateful operators of the alert stream


def _kept(spark, tmp_path, name, operator=0):
    """How many entries a state has after the last batch."""
    return spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name).load(str(tmp_path / "out" / "checkpoint")).count()


def test_trades_of_many_keys_share_states(spark, tmp_path):
    seed = spark.createDataFrame([(k, float(k % 3)) for k in range(0, 900, 2)] + [(5000, 1.0)], "k long, v double")
    rows = [(k, at(m), float((k + m // 10) % 3)) for m in (0, 10, 30) for k in range(900)]
    slices = [rows[:1200], [*rows[1200:], (-1, at(60), 0.0)], [(-1, at(90), 0.0)]]
    out = _slices(spark, tmp_path, slices, lambda s: stateful.stream_changes(s, "k", "ts", "v", seed=seed, buckets=8), "k long, ts timestamp, v double")
    want, last = [], {r.k: r.v for r in seed.collect()}
    for k, ts, v in [*rows, (-1, at(60), 0.0)]:
        if last.get(k) != v:
            want.append((k, ts, v, last.get(k)))
        last[k] = v
    assert sorted(((r.k, r.ts, r.v, r.prev_value) for r in out.collect()), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
    assert _kept(spark, tmp_path, "last") <= 8


def test_moves_of_odd_keys_ties_and_numbers(spark, tmp_path):
    big, nan, schema = 2**53 + 1, float("nan"), "k long, ts timestamp, v double, n long"
    rows = [(None, at(0), 1.0, 2), (None, at(0), 3.0, None), (big, at(1), nan, 1), (big, at(2), nan, 2), (big - 1, at(3), 1.0, 1), (None, at(4), 1.0, None), (big, at(5), 2.0, 9), (big, at(5), 4.0, 8)]
    rows += [(k, at(6 + j), float(j // 2), k) for k in range(600) for j in range(3)]
    got = _slices(spark, tmp_path, [rows[:5], [*rows[5:], (-1, at(60), 0.0, None)]], lambda s: stateful.stream_changes(s, "k", "ts", "v", tie="n", buckets=8), schema)
    want = [(None, 0, "3.0", None, "None"), (None, 0, "1.0", 2, "3.0"), (big, 1, "nan", 1, "None"), (big, 2, "nan", 2, "nan"), (big - 1, 3, "1.0", 1, "None"), (big, 5, "4.0", 8, "nan"), (big, 5, "2.0", 9, "4.0")]
    want += [(k, 6 + 2 * j, f"{j}.0", k, "None" if j == 0 else "0.0") for k in range(600) for j in range(2)]
    assert sorted(((r.k, int((r.ts - T0).total_seconds()) // 60, str(r.v), r.tie, str(r.prev_value)) for r in got.collect()), key=str) == sorted(want, key=str)
    assert _kept(spark, tmp_path, "last") <= 8


def _polls(hole):
    rng, rows = random.Random(3), []
    for event in "abc":
        prices = {m: rng.random() for m in ("m1", "m2", "m3")}
        for k in range(100):
            for m in prices:
                if rng.random() < 0.15:
                    prices[m] = rng.random()
                if rng.random() < 0.1:
                    prices[m] = rng.choice([0.01, 0.99])
                rows.append((event, m, at(20 * k + (hole if k > 60 else 0)), round(prices[m], 4), round(rng.random() ** 4 * 60_000, 1), rng.choice([0.02, 0.1, 0.5])))
    return sorted(rows, key=lambda r: r[2])


@pytest.mark.parametrize("hole", [0, 9 * 24 * 60])
def test_alert_stream_equals_the_batch_walk(spark, tmp_path, hole):
    schema = "event string, market string, ts timestamp, price double, volume double, spread double"
    rows = _polls(hole)
    batch = spark.createDataFrame(rows, schema)
    marked = batch.withColumn("modal", F.row_number().over(Window.partitionBy("event", "ts").orderBy(F.desc("price"), "market")) == 1)
    done = [tuple(r) for r in marked.orderBy("ts").collect()]
    n = len(done) // 4
    out = _slices(spark, tmp_path, [done[k * n : (k + 1) * n if k < 3 else None] for k in range(4)], lambda s: stateful.stream_alerts(s, "event", "market", "ts", "price", "volume", "spread", "modal"), schema + ", modal boolean")
    found = prediction.cool_down(prediction.alerts(batch, "event", "market", "ts", "price", "volume", "spread"), "event", "ts", "price")
    flat = lambda df: {(r.event, r.ts, r.market, r.price, ",".join(r.classes), r.held, r.sent, round(r.delta, 9)) for r in df.collect()}
    want = flat(found.where(F.col("ts") <= F.lit(rows[-1][2] - dt.timedelta(minutes=10))))
    assert flat(out) == want
    held = {r[5] for r in want}
    assert {None, "ILLIQUID", "RESOLVED", "COOLDOWN"} <= held
    assert prediction.alert_log(out).count() == sum(len(r[4].split(",")) for r in want)


def _alert_rows(df):
    return {(r.event, r.ts, r.market, r.price, ",".join(r.classes), r.held, r.sent, round(r.delta, 9), None if r.vol_ratio is None else round(r.vol_ratio, 9)) for r in df.collect()}


ALERT_COLUMNS = ["event", "market", "ts", "price", "volume", "spread"]


def test_alerts_of_many_markets_share_states(spark, tmp_path):
    rng, schema = random.Random(5), "event long, market date, ts timestamp, price double, volume double, spread double, modal boolean"
    polls = [(k, e, rng.random()) for k in range(40) for e in (1, 2)]
    rows = [(e, dt.date(2024, 1, 1) + dt.timedelta(m) if m else None, at(360 * k), round(high * rng.random(), 3), rng.choice([None, 0.0, round(rng.random() ** 4 * 60_000, 1)]), rng.choice([0.02, 0.5, None])) for k, e, high in polls for m in range(300)]
    top = {}
    for r in rows:
        top[r[0], r[2]] = max(top.get((r[0], r[2]), r), r, key=lambda x: (x[3], -(x[1] or dt.date.min).toordinal()))
    marked = [(*r, top[r[0], r[2]] is r) for r in rows]
    n = len(rows) // 3
    out = _slices(spark, tmp_path, [marked[:n], marked[n : 2 * n], marked[2 * n :]], lambda s: stateful.stream_alerts(s, *ALERT_COLUMNS, "modal", buckets=8), schema)
    batch = spark.createDataFrame(rows, schema.removesuffix(", modal boolean"))
    found = prediction.cool_down(prediction.alerts(batch, *ALERT_COLUMNS), "event", "ts", "price")
    want = _alert_rows(found.where(F.col("ts") <= F.lit(rows[-1][2] - dt.timedelta(minutes=10))))
    assert _alert_rows(out) == want and len(want) > 40
    assert 2 < _kept(spark, tmp_path, "volumes", BASELINES) <= 8  # the markets of an event are spread, and share states
    assert _kept(spark, tmp_path, "snapshot", WALK) == 2


def test_alerts_at_the_watermark_and_after_silence(spark, tmp_path):
    schema = "event string, market string, ts timestamp, price double, volume double, spread double, modal boolean"
    day = 24 * 60
    slices = [
        [("e", "x", at(0), 0.2, 100.0, 0.01, True), ("e", "x", at(10), 0.4, 100.0, 0.01, True)],  # the watermark is at(0)
        [("e", "x", at(30), 0.6, 600.0, 0.01, True), ("e", "x", at(0), 0.9, 1.0, 0.01, True), ("e", "y", at(30), None, 1.0, 0.01, True), ("e", "y", at(40), 0.1, 5.0, 0.01, False), ("e", "x", at(40), 0.6, None, 0.01, True)],
        [("f", "x", at(7 * day + 19), 0.5, 1.0, 0.01, True)],
        [("e", "x", at(7 * day + 10), 0.6, 900.0, 0.01, True), ("e", "x", at(7 * day + 11), 0.6, 900.0, 0.01, True), ("f", "x", at(9 * day), 0.5, 1.0, 0.01, True)],
        [("f", "x", at(20 * day), 0.5, 1.0, 0.01, True), ("f", "x", at(20 * day + 11), 0.5, 1.0, 0.01, True)],
    ]
    out = _slices(spark, tmp_path, slices, lambda s: stateful.stream_alerts(s, *ALERT_COLUMNS, "modal", prediction.Thresholds(burst=1.5), buckets=64), schema)
    got = {(r.event, int((r.ts - T0).total_seconds()) // 60): (",".join(r.classes), r.held, r.vol_ratio) for r in out.collect()}
    assert got == {("e", 10): ("SPIKE", None, 1.0), ("e", 30): ("SPIKE,VOL_BURST", None, 6.0), ("e", 7 * day + 10): ("VOL_BURST", None, 1.5)}
    assert _kept(spark, tmp_path, "volumes", BASELINES) == 1  # those of e are out of use


def _bars(rows):
    out = {}
    for k, ts, v in rows:
        out.setdefault((k, ts.replace(minute=0)), []).append((ts, v))
    return {key: (min(x)[1], max(v for _, v in x), min(v for _, v in x), max(x)[1], len(x)) for key, x in out.items()}


def test_late_ticks_correct_their_bars(spark, tmp_path):
    rows = [("a", at(7 * m), float((m * 37) % 11)) for m in range(60)]
    late = [("a", at(3), -5.0), ("a", at(61), 50.0)]
    path = str(tmp_path / "bars")
    sink = streams.bars_sink(path, ["k"], "ts", "v")
    _slices(spark, tmp_path, [rows[:25], rows[25:40], rows[40:] + late], lambda s: s, batch=sink)
    read = lambda: {(r.k, r.bar_ts): (r.open_px, r.high_px, r.low_px, r.close_px, r.n_ticks) for r in streams.merged_bars(spark.read.parquet(f"{path}/bars"), ["k"]).collect()}
    assert read() == _bars(rows + late)
    assert {(r.ts, r.v) for r in spark.read.parquet(f"{path}/late").collect()} == {(ts, v) for _, ts, v in late}
    sink(spark.createDataFrame(rows[40:] + late, SCHEMA), 2)  # the last batch is replayed
    assert read() == _bars(rows + late)
    streams.compact_bars(spark, path, ["k"], 1)
    assert read() == _bars(rows + late)
    assert {r.batch for r in spark.read.parquet(f"{path}/bars").select("batch").distinct().collect()} == {1, 2}


def test_upsert_takes_the_last_arrival(spark, tmp_path):
    schema = "k string, p string, v double, n int"
    path = str(tmp_path / "table")
    slices = [[("a", "x", 9.0, 1), ("a", "x", 1.0, 2), ("b", "y", 5.0, 1)], [("a", "x", 0.5, 3)], [("c", "y", 2.0, 1)]]
    _slices(spark, tmp_path, slices, lambda s: s, schema, batch=streams.upsert_sink(path, ["k"], ["p"], ["n"]))
    assert {(r.k, r.p, r.v) for r in spark.read.parquet(path).collect()} == {("a", "x", 0.5), ("b", "y", 5.0), ("c", "y", 2.0)}
    assert [p.name for p in tmp_path.glob("table__staged*")] == []


def test_bars_match_batch(spark, tmp_path):
    rows = [("a", at(7 * m), float(m % 9)) for m in range(60)]
    out = _slices(spark, tmp_path, [rows[:20], rows[20:40], rows[40:]], lambda s: streams.stream_bars(s, ["k"], "ts", "v"))
    want = {key: bar for key, bar in _bars(rows).items() if key[1] + dt.timedelta(minutes=60) <= rows[-1][1] - dt.timedelta(minutes=10)}
    assert {(r.k, r.bar_ts): (r.open_px, r.high_px, r.low_px, r.close_px, r.n_ticks) for r in out.collect()} == want


def test_replay_appends_once(spark, tmp_path):
    rows = [("a", T0, 1.0), ("a", T0, 1.0), ("b", T0, 1.0)]
    out = _slices(spark, tmp_path, [rows, rows, [*rows, ("c", at(5), 1.0)]], lambda s: streams.stream_once(s, ["k", "ts"], "ts"))
    assert out.count() == 3
