"""Streams with state of their own per key: moves of a value, trades against a seeded last price, the alert walk.

All are ``transformWithState`` processors. Moves and the baselines of alerts keep a bucket of keys in one
state, the alert walk a key. Rows wait in a list state until the watermark has passed them, an event-time
timer at the earliest of them wakes the bucket or key, and they are taken in time order, so results do not depend on how rows are
dealt over micro-batches or tasks. A row that comes after the watermark is dropped by the engine; ``refused`` in
``streams`` keeps such rows. State lies in the state store on disk (``use_rocksdb``) and ends with its timers.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import series
from tidemark.operators.prediction import BASELINE_DAYS, Thresholds, may_send

HOUR_MS = 3_600_000
PUT_AT_ONCE = 1000
BUCKETS = 1024
STORED = {"key": pa.string(), "at": pa.int64(), "tie": pa.int64(), "tied": pa.bool_(), "value": pa.float64()}
STORED |= {"event": pa.string(), "market": pa.string(), "us": pa.int64(), "price": pa.float64(), "volume": pa.float64(), "spread": pa.float64(), "modal": pa.bool_(), "known": pa.bool_()}


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that ``transformWithState`` needs; set it before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def packed(table: pa.Table) -> bytes:
    """A table as bytes for the state store."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(stored: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(stored)).read_all()


def as_table(frame: pd.DataFrame | None, columns: list[str]) -> pa.Table:
    """A frame's columns in the types of the state store; without a frame, a table without rows. NaN stays a number."""
    schema = pa.schema([(c, STORED[c]) for c in columns])
    return schema.empty_table() if frame is None else pa.table([pa.array(frame[c].to_numpy(), STORED[c], from_pandas=not pa.types.is_floating(STORED[c])) for c in columns], schema=schema)


def put_all(state, rows: list[tuple]) -> None:
    """A list state's new rows, in parts."""
    state.clear()
    for k in range(0, len(rows), PUT_AT_ONCE):
        state.appendList(rows[k : k + PUT_AT_ONCE])


class InOrder(StatefulProcessor):
    """Hands each key's rows to ``step`` in time order once the watermark has passed them.

    ``fields`` are the columns after the key; the first is the instant in milliseconds, the others settle ties in order.
    Subclasses open their states in ``open``, turn the rows that are due into results in ``step``, and may keep a key
    after its rows by ``idle_at``: the instant at which ``forget`` is called if nothing came since.
    """

    def __init__(self, key: str, schema: str, fields: list[str]):
        self.key, self.schema, self.fields = key, schema, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def step(self, key: tuple, rows: list[tuple]) -> Iterator[Row]:
        raise NotImplementedError

    def idle_at(self) -> int | None:
        return None

    def forget(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  the engine's names
        first, part = None, []
        for row in rows:
            part.append(tuple(row[f] for f in self.fields))
            first = part[-1][0] if first is None else min(first, part[-1][0])
            if len(part) == PUT_AT_ONCE:
                self.waiting.appendList(part)
                part = []
        if part:
            self.waiting.appendList(part)
        if first is not None:
            self.handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        due, later = [], []
        for row in self.waiting.get() if self.waiting.exists() else ():
            (due if row[0] <= passed else later).append(tuple(row))
        if due:
            due.sort(key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
            yield from self.step(key, due)
            if later:
                self.waiting.put(later)
                self.handle.registerTimer(min(r[0] for r in later))
            else:
                self.waiting.clear()
        idle = self.idle_at()
        if idle is not None and idle <= passed and not later:
            self.forget()
        elif idle is not None and due:
            self.handle.registerTimer(idle)

    def close(self) -> None:
        pass


class InColumns(StatefulProcessor):
    """Rows of a bucket of keys that wait for the watermark, in columns, as calls to the state store cost more than the rows: a
    bucket's calls are the same for a thousand keys as for one. They are kept as Arrow tables, in parts.

    Subclasses name the columns in ``ROWS``, ``at`` among them, open their states in ``open`` and take ``due`` rows when a timer expires.
    """

    ROWS: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, parts = None, []
        for frame in rows:
            if len(frame):
                earliest = int(frame["at"].min())
                first = earliest if first is None else min(first, earliest)
                parts.append((packed(as_table(frame, self.ROWS)),))
        if parts:
            self.waiting.appendList(parts)
            self.handle.registerTimer(first)
        return iter(())

    def due(self, passed: int) -> tuple[pa.Table, pa.Table]:
        """The waiting rows that the watermark has passed, and the others."""
        rows = pa.concat_tables([as_table(None, self.ROWS), *[unpacked(part[0]) for part in self.waiting.get()]])
        is_due = pc.less_equal(rows["at"], passed)
        return rows.filter(is_due), rows.filter(pc.invert(is_due))

    def wait_on(self, later: pa.Table) -> None:
        """Only these rows wait from now on."""
        if later.num_rows:
            self.waiting.put([(packed(later),)])
            self.handle.registerTimer(pc.min(later["at"]).as_py())
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


class Moves(InColumns):
    """A row whenever a key's value differs from its last one; the last value may be seeded and is forgotten after ``keep_hours``.

    A group is a bucket of keys; state are the rows that wait and the last value of each key. A seeded key has no instant until its
    first row, so it is not forgotten before.
    """

    LAST, ROWS = ["key", "at", "value"], ["key", "at", "tie", "tied", "value"]

    def __init__(self, keep_hours: int | None):
        self.keep = None if keep_hours is None else keep_hours * HOUR_MS

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "rows binary")

    def _last(self) -> list[pa.Table]:
        found = self.last.get()
        return [] if found is None else [unpacked(found[0])]

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        seeds = as_table(initialState.assign(at=None), self.LAST)
        self.last.update((packed(pa.concat_tables([*self._last(), seeds])),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        due, later = self.due(passed)
        if not due.num_rows and self.keep is None:
            return
        moved, last = self._moves(pa.concat_tables([as_table(None, self.LAST), *self._last()]), due)
        if len(moved):
            yield moved
        if self.keep is not None:
            old = pc.fill_null(pc.less_equal(last["at"], passed - self.keep), False)
            last = last.filter(pc.or_(pc.invert(old), pc.is_in(last["key"], value_set=later["key"].combine_chunks())))
            idle = pc.min(last["at"]).as_py()
            if idle is not None:
                self.handle.registerTimer(max(idle + self.keep, passed + 1))
        self.last.update((packed(last),))
        if due.num_rows:
            self.wait_on(later)

    def _moves(self, last: pa.Table, due: pa.Table) -> tuple[pd.DataFrame, pa.Table]:
        """The due rows that differ from the row before, and the keys' last values after them: a key's last value stands before its rows."""
        n = last.num_rows
        keys = pa.chunked_array([*last["key"].chunks, *due["key"].chunks], pa.string())
        code = keys.combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        both = lambda c, of_last: np.concatenate([of_last, due[c].to_numpy()])
        at, tie, tied = both("at", pc.fill_null(last["at"], 0).to_numpy()), both("tie", np.zeros(n, "int64")), both("tied", np.zeros(n, bool))
        value, is_row = both("value", last["value"].to_numpy()), np.arange(len(keys)) >= n
        order = np.lexsort((value, tie, tied, at, is_row, code))
        code, value_then = code[order], value[order]
        first = np.append(True, code[1:] != code[:-1])[: len(code)]
        before = np.roll(value_then, 1)
        moved = is_row[order] & (first | (value_then != before))
        took = order[moved]
        out = pd.DataFrame({"key": keys.take(pa.array(took)).to_pandas(), "at": at[took], "tie": tie[took], "tied": tied[took], "value": value[took], "prev_value": before[moved], "known": ~first[moved]})
        ends = order[np.append(code[1:] != code[:-1], True)[: len(code)]]
        unseen = pa.array(~is_row[ends] & pc.is_null(last["at"]).to_numpy()[np.minimum(ends, n - 1)] if n else np.zeros(len(ends), bool))
        kept = [keys.take(pa.array(ends)), pc.if_else(unseen, pa.scalar(None, pa.int64()), pa.array(at[ends])), pa.array(value[ends])]
        return out, pa.table(kept, schema=pa.schema([(c, STORED[c]) for c in self.LAST]))


class Baselines(InColumns):
    """The modal rows that the watermark has passed, each with the median of its market's positive volumes of the baseline's days.

    A group is a bucket of markets, so those of one event are spread over many tasks; state are the rows that wait and the volumes that
    a later row can still ask for, with the instant from which none of them is of use. Of one market's positive volumes at one instant one counts.
    """

    KEPT, ROWS = ["event", "market", "at", "volume"], ["event", "market", "at", "us", "price", "volume", "spread", "modal", "known"]
    WEEK = BASELINE_DAYS * 24 * HOUR_MS

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.volumes = handle.getValueState("volumes", "rows binary, until long")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        due, later = self.due(passed)
        stored, until = self.volumes.get() or (None, None)
        if not due.num_rows and (until is None or until > passed):
            return
        judged, kept = self._baselines(as_table(None, self.KEPT) if stored is None else unpacked(stored), due)
        if len(judged):
            yield judged
        kept = kept.filter(pc.greater_equal(kept["at"], passed - self.WEEK))
        if until is not None and until > passed:
            self.handle.deleteTimer(until)
        if kept.num_rows:
            until = pc.max(kept["at"]).as_py() + self.WEEK + 1
            self.volumes.update((packed(kept), until))
            self.handle.registerTimer(until)
        else:
            self.volumes.clear()
        if due.num_rows:
            self.wait_on(later)

    def _baselines(self, kept: pa.Table, due: pa.Table) -> tuple[pd.DataFrame, pa.Table]:
        """The modal ones of the due rows with their baselines, and the volumes after them. Only those markets' volumes are searched."""
        n = kept.num_rows
        names = {c: pa.chunked_array([*kept[c].chunks, *due[c].chunks], pa.string()).combine_chunks() for c in ("event", "market")}
        event, market = (c.dictionary_encode("encode") for c in names.values())
        code = event.indices.to_numpy(zero_copy_only=False).astype("int64") * len(market.dictionary) + market.indices.to_numpy(zero_copy_only=False)
        at, volume = (np.concatenate([kept[c].to_numpy(), due[c].to_numpy()]) for c in ("at", "volume"))
        modal = np.concatenate([np.zeros(n, bool), due["modal"].to_numpy()])
        price, spread = (np.concatenate([np.zeros(n), due[c].to_numpy()]) for c in ("price", "spread"))
        low = [np.where(np.isnan(x), -np.inf, x) for x in (spread, volume, price)]
        order = np.lexsort((modal, *low, np.arange(len(code)) >= n, volume > 0, at, code))
        code, at, volume, modal = code[order], at[order], volume[order], modal[order]
        counts = np.append((code[1:] != code[:-1]) | (at[1:] != at[:-1]), True)[: len(code)] & (volume > 0)
        columns = [names["event"].take(pa.array(order[counts])), names["market"].take(pa.array(order[counts])), pa.array(at[counts]), pa.array(volume[counts])]
        asked = np.isin(code, code[modal])
        out = due.take(pa.array(order[modal] - n)).to_pandas()
        out = out.assign(ts=out["us"].to_numpy().astype("datetime64[us]"), baseline=self._medians(code[asked], at[asked], np.where(counts, volume, np.nan)[asked], modal[asked]))
        out["ts"] = out["ts"].dt.tz_localize("UTC")
        return out[["event", "market", "ts", "price", "volume", "spread", "known", "baseline"]], pa.table(columns, schema=pa.schema([(c, STORED[c]) for c in self.KEPT]))

    def _medians(self, code: np.ndarray, at: np.ndarray, volume: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For the wanted rows the medians of the volumes of the days up to them; rows are in order and NaN does not count."""
        if not len(code):
            return np.zeros(0)
        place, since = np.unique(code, return_inverse=True)[1], at - at.min()
        t = place * (since.max() + 2 * self.WEEK) + since  # windows end inside their market
        first, last = np.searchsorted(t, t - self.WEEK, "left"), np.searchsorted(t, t, "right")
        if np.isinf(volume).any():  # the rolling median would leave them out
            windows = (volume[a:b][volume[a:b] > 0] for a, b in zip(first[wanted], last[wanted], strict=True))
            return np.array([np.median(w) if len(w) else np.nan for w in windows])
        return pd.Series(volume).rolling(series._Spans(first, last), min_periods=1).median().to_numpy()[wanted]


class AlertWalk(InOrder):
    """The alert classes of every snapshot, and which go out: the stream's form of ``prediction.alerts`` and ``cool_down``.

    Its rows are the modal ones with their baselines. Kept for each event: the last snapshot and the last alert sent (value states), and the
    prices back to the last snapshot beyond the drift look-back (a list, written anew at every step). An event that is silent for the
    baseline's days forgets what was sent.
    """

    FIELDS = ["at", "market", "price", "volume", "spread", "baseline"]

    def __init__(self, key: str, market_type: str, limits: Thresholds):
        super().__init__(key, f"at long, market {market_type}, price double, volume double, spread double, baseline double", self.FIELDS)
        self.market_type, self.limits = market_type, limits

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("snapshot", f"at long, market {self.market_type}, price double")
        self.sent = handle.getValueState("sent", "at long, price double")
        self.prices = handle.getListState("prices", "at long, price double")

    def step(self, key: tuple, rows: list[tuple]) -> Iterator[Row]:
        t = self.limits
        _, market_before, price_before = self.now.get() if self.now.exists() else (None, None, None)
        sent_at, sent_price = self.sent.get() if self.sent.exists() else (None, None)
        before = [tuple(r) for r in self.prices.get()] if self.prices.exists() else []
        times, prices = [r[0] for r in before], [r[1] for r in before]
        for at, market, price, volume, spread, baseline in rows:
            delta = price - price_before if price_before is not None else 0.0
            anchor = bisect_right(times, at - t.drift_hours * HOUR_MS) - 1
            drift = price - prices[anchor] if anchor >= 0 else None
            ratio = volume / baseline if baseline is not None and volume is not None else None
            classes = [name for name, there in (
                ("MODAL_FLIP", market_before is not None and market_before != market and abs(delta) >= t.flip),
                ("SPIKE", abs(delta) >= t.spike),
                ("DRIFT", drift is not None and abs(drift) >= t.drift and (volume or 0.0) >= t.drift_volume),
                ("VOL_BURST", ratio is not None and ratio >= t.burst),
            ) if there]
            if classes:
                pinned = [p is not None and (p <= t.resolved_band or p >= 1 - t.resolved_band) for p in (price, price_before)]
                wide = spread is not None and (spread > t.illiquid_abs or spread / max(min(price, 1 - price), 0.05) > t.illiquid_rel)
                held = "ILLIQUID" if wide and max(abs(delta), abs(drift or 0.0)) < t.override else "RESOLVED" if all(pinned) else None
                held = may_send(at / 1000, price, held, classes, None if sent_at is None else sent_at / 1000, sent_price, t)
                if held is None:
                    sent_at, sent_price = at, price
                yield Row(key=key[0], at=at, market=market, price=price, prior_price=price_before, delta=delta, drift=drift, vol_ratio=ratio, illiquid=wide, classes=classes, held=held, sent=held is None)
            market_before, price_before = market, price
            if times and times[-1] == at:
                prices[-1] = price
            else:
                times.append(at)
                prices.append(price)
        self.now.update((times[-1], market_before, price_before))
        if sent_at is not None:
            self.sent.update((sent_at, sent_price))
        anchor = max(bisect_right(times, times[-1] - t.drift_hours * HOUR_MS) - 1, 0)
        put_all(self.prices, list(zip(times[anchor:], prices[anchor:], strict=True)))

    def idle_at(self) -> int | None:
        return self.now.get()[0] + BASELINE_DAYS * 24 * HOUR_MS if self.now.exists() else None

    def forget(self) -> None:
        self.sent.clear()


def _millis(ts: str) -> F.Column:
    return F.unix_millis(ts).alias("at")


def _as_text(key: str, kind: str) -> F.Column:
    """A key as text, for buckets of keys of any type; ``_of_text`` gives it back."""
    if kind == "binary" or kind.startswith(("array", "map", "struct", "variant")):
        raise ValueError(f"a key of type {kind} cannot go as text: cast it first")
    return F.when(F.col(key).isNotNull(), (F.unix_micros(key) if kind == "timestamp" else F.col(key)).cast("string"))


def _of_text(text: str, kind: str) -> F.Column:
    return F.timestamp_micros(F.col(text).cast("long")) if kind == "timestamp" else F.col(text).cast(kind)


def stream_changes(df: DataFrame, key: str, ts: str, value: str, *, tie: str | None = None, late: str = "10 minutes", keep_hours: int | None = None, seed: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """M4, M5: a row only when a key's value moved: ``key, ts, tie, value, prev_value`` (null at its first).

    Rows are taken in time order, those of one millisecond by ``tie`` (a whole number), then value; null values do not count. ``seed`` is a
    snapshot with ``key`` and ``value`` (and ``ts`` if it has one): the values before the stream began. With ``keep_hours`` a key that is
    silent for so long is forgotten, and its next row counts as its first. State is kept for ``buckets`` of keys, which bounds the calls to the
    state store whatever the number of keys; a task holds one bucket's waiting rows. The number is fixed with the first run of a checkpoint.
    """
    use_rocksdb(df.sparkSession)
    kind = dict(df.dtypes)[key]
    text = _as_text(key, kind).alias("key")
    bucket = F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("bucket")
    order = (F.lit(0) if tie is None else F.col(tie)).cast("long")
    ties = [F.coalesce(order, F.lit(0)).alias("tie"), order.isNotNull().alias("tied")]
    rows = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late).select(bucket, ts, text, _millis(ts), *ties, F.col(value).cast("double").alias("value"))
    initial = None
    if seed is not None:
        by = F.struct(ts, value) if ts in seed.columns else F.struct(value)
        known = seed.where(F.col(value).isNotNull()).select(F.col(key).cast(kind).alias(key), *[F.col(c) for c in dict.fromkeys([ts, value]) if c in seed.columns])
        initial = known.groupBy(text).agg(F.max_by(value, by).cast("double").alias("value")).select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", "value").groupBy("bucket")
    out = rows.groupBy("bucket").transformWithStateInPandas(Moves(keep_hours), "key string, at long, tie long, tied boolean, value double, prev_value double, known boolean", "append", "eventTime", initial)
    back = _of_text("key", kind)
    nan = F.lit(float("nan"))  # the engine reads a frame's NaN as null
    return out.select(back.alias(key), F.timestamp_millis("at").alias(ts), F.when(F.col("tied"), F.col("tie")).alias("tie"), F.coalesce("value", nan).alias(value), F.when(F.col("known"), F.coalesce("prev_value", nan)).alias("prev_value"))


def stream_alerts(df: DataFrame, event: str, market: str, ts: str, price: str, volume: str, spread: str, modal: str, t: Thresholds = Thresholds(), *, late: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:  # noqa: B008
    """M3: alerts of polled snapshots with their classes, why they are held back and whether they go out.

    ``df`` has a row for each market of an event and snapshot; ``modal`` marks the one of the highest price. All markets feed their
    volume baselines, modal ones are judged. ``prediction.alert_log`` turns the result into the log. Alerts come once the
    watermark has passed their snapshot. Of equal rows at one instant each is judged.

    Two states follow each other: ``buckets`` of markets keep volumes and hand on the modal rows, an event walks through these alone. So
    an event's markets are spread over the tasks, and its walk takes a row for each snapshot however many markets it has. The number of
    buckets is fixed with the first run of a checkpoint.
    """
    use_rocksdb(df.sparkSession)
    kinds = dict(df.dtypes)
    nan = F.lit(float("nan"))  # the engine reads a frame's NaN as null
    names = [_as_text(event, kinds[event]).alias("event"), _as_text(market, kinds[market]).alias("market")]
    numbers = [F.col(c).cast("double").alias(n) for c, n in ((price, "price"), (volume, "volume"), (spread, "spread"))]
    flags = [(F.coalesce(F.col(modal), F.lit(False)) & F.col(price).isNotNull()).alias("modal"), F.col(volume).isNotNull().alias("known")]
    rows = df.where(F.col(ts).isNotNull() & F.col(event).isNotNull()).withWatermark(ts, late)
    rows = rows.select(*names, F.col(ts).alias("ts"), _millis(ts), F.unix_micros(ts).alias("us"), *numbers, *flags)
    rows = rows.select(F.pmod(F.xxhash64("event", "market"), F.lit(buckets)).cast("int").alias("bucket"), "*")
    based = rows.groupBy("bucket").transformWithStateInPandas(Baselines(), "event string, market string, ts timestamp, price double, volume double, spread double, known boolean, baseline double", "append", "eventTime", eventTimeColumnName="ts")
    based = based.select(_of_text("event", kinds[event]).alias("key"), "ts", _millis("ts"), _of_text("market", kinds[market]).alias("market"), F.coalesce("price", nan).alias("price"), F.when(F.col("known"), F.coalesce("volume", nan)).alias("volume"), "spread", "baseline")
    schema = f"key {kinds[event]}, at long, market {kinds[market]}, price double, prior_price double, delta double, drift double, vol_ratio double, illiquid boolean, classes array<string>, held string, sent boolean"
    out = based.groupBy("key").transformWithState(AlertWalk("key", kinds[market], t), schema, "append", "eventTime")
    return out.select(F.col("key").alias(event), F.timestamp_millis("at").alias(ts), F.col("market").alias(market), F.col("price").alias(price), "prior_price", "delta", "drift", "vol_ratio", "illiquid", "classes", "held", "sent")
