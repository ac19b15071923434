"""Prediction markets: derived metrics of events, movement alerts at a snapshot and their suppression."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.parse import is_illiquid
from tidemark.operators.joins import asof_lags
from tidemark.operators.series import DAY, keep_one, modal_child, rolling_median


BASELINE_DAYS = 7


@dataclass(frozen=True)
class Thresholds:
    """Default limits of the alert detector."""

    spike: float = 0.10
    drift: float = 0.25
    drift_hours: int = 6
    drift_volume: float = 10_000
    burst: float = 5.0
    illiquid_abs: float = 0.30
    illiquid_rel: float = 0.50
    override: float = 0.30
    cooldown_minutes: int = 30
    rearm: float = 0.05
    resolved_band: float = 0.03
    flip: float = 0.02


def event_metrics(df: DataFrame, event: list[str], price: str, volume: str) -> DataFrame:
    """For each event the markets, modal and runner-up price, sum of probabilities, concentration (HHI) and volume."""
    top = F.slice(F.sort_array(F.collect_list(F.col(price)), asc=False), 1, 2)  # the markets of one event at one time are few
    out = df.groupBy(*event).agg(F.count(F.lit(1)).alias("n_markets"), top.alias("__t"), F.sum(price).alias("prob_sum"), F.sum(F.col(price) * F.col(price)).alias("hhi"), F.sum(volume).alias("volume"))
    return out.withColumns({"modal_price": F.get("__t", F.lit(0)), "runner_up": F.get("__t", F.lit(1))}).drop("__t")


def theme_rollup(df: DataFrame, keys: list[str], event: str, ts: str, value: str, volume: str) -> DataFrame:
    """Events, volume, mean and median price and the sum of absolute moves, for each theme and snapshot."""
    move = F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(event).orderBy(ts)))
    return df.withColumn("__m", move).groupBy(*keys).agg(F.countDistinct(event).alias("n_events"), F.sum(volume).alias("volume"), F.avg(value).alias("mean_price"), F.expr(f"percentile({value}, 0.5)").alias("median_price"), F.coalesce(F.sum("__m"), F.lit(0.0)).alias("activity"))


def event_statistics(df: DataFrame, event: str, ts: str, value: str, least: int = 7) -> DataFrame:
    """For each event with enough points the population deviation of its moves and their lag-1 autocorrelation."""
    w = Window.partitionBy(event).orderBy(ts)
    moves = df.withColumn("d", F.col(value) - F.lag(value).over(w)).where("d is not null")
    moves = moves.withColumn("d", F.col("d") - F.avg("d").over(Window.partitionBy(event))).withColumn("d1", F.lag("d").over(w))
    stats = moves.groupBy(event).agg((F.count(F.lit(1)) + 1).alias("n_points"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("move_std"), (F.sum(F.col("d") * F.col("d1")) / F.nullif(F.sum(F.col("d") * F.col("d")), F.lit(0.0))).alias("autocorr_1"))
    return stats.where(F.col("n_points") >= least)


def burst_ratio(df: DataFrame, keys: list[str], ts: str, volume: str, days: int = 7) -> DataFrame:
    """The volume over the trailing median of the positive volumes of so many days."""
    positive = df.withColumn("__positive", F.when(F.col(volume) > 0, F.col(volume)))
    out = rolling_median(positive, keys, ts, "__positive", days * 86_400_000_000, "baseline", closed=True).drop("__positive")
    return out.withColumn("vol_ratio", F.col(volume) / F.nullif("baseline", F.lit(0.0)))


def alerts(markets: DataFrame, event: str, market: str, ts: str, price: str, volume: str, spread: str, t: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """L1: for each event and snapshot the alert classes of its modal market and why they are held back, before cooldown.

    MODAL_FLIP: the modal market changed and moved by the flip margin; SPIKE: a jump against the snapshot before; DRIFT: a
    move against the last snapshot that is at least the look-back old, however old, with volume; VOL_BURST: volume over
    the median of that market's positive volumes in the trailing week. The first snapshot of an event has a jump of zero.
    ILLIQUID holds back unless the jump or the move over the look-back reaches the override; else RESOLVED holds back
    what is pinned at this and the last snapshot.
    """
    based = rolling_median(markets.withColumn("__positive", F.when(F.col(volume) > 0, F.col(volume))), [event, market], ts, "__positive", BASELINE_DAYS * DAY, "baseline", closed=True)
    modal = modal_child(based, [event, ts], market, price).select(event, ts, market, price, volume, spread, (F.col(volume) / F.col("baseline")).alias("vol_ratio"))
    modal = modal.where(F.col(price).isNotNull())
    w = Window.partitionBy(event).orderBy(ts)
    modal = modal.withColumns({"prior_market": F.lag(market).over(w), "prior_price": F.lag(price).over(w)})
    modal = asof_lags(modal, [event], ts, price, [t.drift_hours], None)
    jump, drift = F.coalesce(F.col(price) - F.col("prior_price"), F.lit(0.0)), F.col(price) - F.col(f"{price}_{t.drift_hours}h")
    flip = F.col("prior_market").isNotNull() & (F.col("prior_market") != F.col(market)) & (F.abs(jump) >= t.flip)
    classes = F.array(
        F.when(flip, F.lit("MODAL_FLIP")),
        F.when(F.abs(jump) >= t.spike, F.lit("SPIKE")),
        F.when((F.abs(drift) >= t.drift) & (F.coalesce(volume, F.lit(0.0)) >= t.drift_volume), F.lit("DRIFT")),
        F.when(F.col("vol_ratio") >= t.burst, F.lit("VOL_BURST")),
    )
    pinned = lambda c: (c <= t.resolved_band) | (c >= 1 - t.resolved_band)
    move = F.greatest(F.abs(jump), F.coalesce(F.abs(drift), F.lit(0.0)))
    illiquid = F.coalesce(is_illiquid(F.col(spread), F.col(price), t.illiquid_abs, t.illiquid_rel), F.lit(False))
    held = F.when(illiquid & (move < t.override), "ILLIQUID").when(pinned(F.col(price)) & pinned(F.col("prior_price")), "RESOLVED")
    out = modal.withColumns({"classes": F.filter(classes, lambda c: c.isNotNull()), "delta": jump, "drift": drift, "illiquid": illiquid, "held": held})
    return out.where(F.size("classes") > 0)


def may_send(at: float, price: float, held: str | None, classes: list[str], last_at: float | None, last_price: float | None, t: Thresholds) -> str | None:
    """Why an alert is held back after all (None: it goes out), from the time in seconds and the price of the last one sent."""
    if held is None and last_at is not None and at - last_at < t.cooldown_minutes * 60 and abs(price - last_price) < t.rearm:
        return "COOLDOWN"
    return "DRIFT_ONLY" if held is None and list(classes) == ["DRIFT"] else held


def cool_down(found: DataFrame, event: str, ts: str, price: str, t: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """L1: the alerts with their final ``held`` and ``sent``: none within the cooldown of the event's last one, unless its price moved to re-arm.

    A held alert, or one that is a drift alone (DRIFT_ONLY), changes no state. The state depends on what was sent before, so each
    event's alerts (already few) are walked through in order.
    """

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts, kind="stable")
        last_at, last_price, final = None, None, []
        for at, p, held, classes in zip(pdf[ts], pdf[price], pdf["held"], pdf["classes"], strict=True):
            final.append(may_send(at.timestamp(), p, held, list(classes), last_at, last_price, t))
            if final[-1] is None:
                last_at, last_price = at.timestamp(), p
        return pdf.assign(held=final, sent=[h is None for h in final])

    schema = found.withColumn("sent", F.lit(True)).schema
    return found.groupBy(event).applyInPandas(walk, schema)


def alert_log(found: DataFrame) -> DataFrame:
    """L1, M3: a row for each alert and class, as the log keeps them."""
    return found.withColumn("alert_class", F.explode("classes")).drop("classes")


def snapshot_section(date: Column, today: Column, recent_days: int = 5) -> Column:
    """L2: "upcoming", "recent" or "dropped" by an event's date."""
    return F.when(date >= today, "upcoming").when(F.datediff(today, date) <= recent_days, "recent").otherwise("dropped")


def needs_backfill(df: DataFrame, event: str, ts: str, cutoff: Column) -> DataFrame:
    """L3: events whose earliest point is newer than a cutoff."""
    return df.groupBy(event).agg(F.min(ts).alias("earliest")).where(F.col("earliest") > cutoff)


def clamp_backfill(points: DataFrame, live: DataFrame, keys: list[str], ts: str, start: Column, end: Column) -> DataFrame:
    """L4: new points inside a window and strictly before the newest live instant that are not stored yet."""
    cap = live.agg(F.max(ts).alias("__cap"))
    inside = points.where(F.col(ts).between(start, end)).crossJoin(F.broadcast(cap)).where(F.col("__cap").isNull() | (F.col(ts) < F.col("__cap"))).drop("__cap")
    return inside.join(live.select(*keys, ts), [*keys, ts], "left_anti")


def purge(df: DataFrame, ts: str, now: Column, days: int = 7) -> DataFrame:
    """Rows younger than the retention."""
    return df.where(F.unix_micros(now) - F.unix_micros(ts) < days * 86_400_000_000)


def live_status(requested: DataFrame, markets: DataFrame, slug: str, open_flag: str) -> DataFrame:
    """LIVE with an open market, DEAD with closed ones only, MISSING without any."""
    got = markets.groupBy(slug).agg(F.max(F.col(open_flag).cast("int")).alias("__o"))
    return requested.join(got, slug, "left").select(slug, F.when(F.col("__o").isNull(), "MISSING").when(F.col("__o") == 1, "LIVE").otherwise("DEAD").alias("status"))


def tail_markets(df: DataFrame, event: list[str], market: str, price: str, least: float = 0.02, k: int = 5) -> DataFrame:
    """After the modal market the next ``k`` with at least a price."""
    w = Window.partitionBy(*event).orderBy(F.desc(price), market)
    return df.withColumn("place", F.row_number().over(w)).where((F.col("place") > 1) & (F.col("place") <= k + 1) & (F.col(price) >= least))


def discovered(df: DataFrame, slug: str, volume: str, n: int) -> DataFrame:
    """The ``n`` slugs of the highest volume, the best row of each."""
    return keep_one(df, [slug], F.desc(volume)).orderBy(F.desc(volume), slug).limit(n)
