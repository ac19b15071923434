"""Title twins and alerts by the rules that they stand for, case by case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents, prediction

VENDORS = ("DB", "Citi", "SCB")
TWINS = [
    ("[/] DB Rate Notes - August board recap: Quiet Room, Late-cut", "Rate Notes: August board recap: Quiet Room, Late-cut"),
    ("[/] DB Rate Notes - Whom the August 2025 dots moved", "Rate Notes: Whom the August 2025 dots moved"),
    ("[/] DB Nordic Macro Letter - Swap screen: Pay SEK 2Y3Y", "Nordic Macro Letter: Swap screen: Pay SEK 2Y3Y; receive ..."),
    ("[/] DB Norway Policy Watch - Board review: a first hawkish look", "Norway Policy Watch : Board review: a first hawkish look"),
    ("Latin America Price Tracker: Corn Over the Hill", "Corn Over the Hill"),
    ("Brazil Talks: More About Chips", "More About Chips"),
    ("Mexico Economics Remark: June PMI Primer", "June PMI Primer"),
    ("Andean Economics Review: Chile Export Rebound Has to Be Proven", "Chile Export Rebound Has to Be Proven"),
    ("World Yield Trader: Coping With Deflation", "Coping With Deflation"),
    ("Policy Compass", "Policy Compass"),
    ("SCB World Macro Letter - WML – Tight rope (with weekly podcast)", "Friday Macro Letter – WML – Tight rope"),
    ("Nils On : Euro G10 Spot Views #1490", "Nils On : Euro G10 Spot Views #1490"),
]
OTHERS = [
    ("[/] DB NOK Market AM Summary", "Norway Economic Notes: Preview of next two weeks"),
    ("[/] DB NOK Market AM Summary", "Corn Over the Hill"),
    ("[/] DB Europe Week Ahead : 8 - 12 May", "Chile / Peru Week Ahead: 22-28 May"),
    ("Citi Macro - Trading Ideas on EMEA Rates", "Rate Notes: August board recap: Quiet Room, Late-cut"),
    ("Global FX: Krone View", "Krone View"),
    ("SCB (Nordic Research) - Net trade balance widened in May", "SCB (Nordic Research) - Bank to drop weekly repo"),
    ("Nils On : Euro G10 Spot Views #1490", "Nils On : Euro G10 Spot Views #1489"),
    ("World gas market report: issue 6", "World gas market report: issue 5"),
    ("Citi Weekly Swap Run (Nominals + Linkers) - 9 Jul 2025", "2025年7月8日"),
]


def _matched(spark, pairs, gap=0, days=3):
    day = dt.date(2026, 6, 18)
    incoming = spark.createDataFrame([(k, k + 1, day, a) for k, (a, _) in enumerate(pairs)], "vendor int, id int, d date, title string")
    stored = spark.createDataFrame([(k, 1000 + k, day + dt.timedelta(days=gap), b) for k, (_, b) in enumerate(pairs)], "vendor int, id int, d date, title string")
    got = documents.title_matches(incoming, stored, ["vendor"], "id", "d", "title", days=days, vendors=VENDORS)
    return {(r.id - 1): r.twin - 1000 for r in got.collect()}


def test_twins_match_and_others_do_not(spark):
    assert _matched(spark, TWINS + OTHERS) == {k: k for k in range(len(TWINS))}


def test_twins_need_the_vendor_and_the_days(spark):
    assert len(_matched(spark, TWINS, gap=3)) == len(TWINS)
    assert _matched(spark, TWINS, gap=4) == {} and _matched(spark, TWINS, gap=1, days=0) == {}
    day = dt.date(2026, 6, 18)
    rows = [("a", 1, day, "June PMI Primer"), ("b", 2, day, "June PMI Primer"), ("a", 3, day, None), ("a", 4, None, "June PMI Primer"), ("a", 5, day, ""), ("a", 6, day, "June PMI Primer"), ("a", 7, day, "June PMI Primer")]
    df = spark.createDataFrame(rows, "vendor string, id int, d date, title string").withColumns({c: F.lit("x") for c in ("words", "core", "w", "f")})
    got = {(r.id, r.twin, r.score) for r in documents.title_matches(df, df, ["vendor"], "id", "d", "title").collect()}
    assert got == {(1, 6, 1.0), (6, 1, 1.0), (7, 1, 1.0)}
    assert documents.title_matches(df.limit(0), df, ["vendor"], "id", "d", "title").count() == 0


def test_editions_are_no_twins(spark):
    rows = [(1, "Euro G10 Spot Views #1490"), (2, "Euro G10 Spot Views #1489"), (3, "Euro G10 Spot Views #1490"), (4, "Euro G10 Spot Views")]
    df = spark.createDataFrame(rows, "id int, title string").withColumn("b", F.lit(1))
    pairs = {tuple(sorted((r[1], r[2]))) for r in documents.title_twins(df.withColumnRenamed("b", "blk"), ["blk"], "id", "title").collect()}
    assert pairs == {(1, 3), (1, 4), (2, 4)}


T0 = dt.datetime(2024, 1, 1)
MARKETS = "event string, market string, ts timestamp, price double, volume double, spread double"


def _alerts(spark, rows):
    df = spark.createDataFrame([(*r[:2], T0 + dt.timedelta(minutes=r[2]), *r[3:]) for r in rows], MARKETS)
    found = prediction.cool_down(prediction.alerts(df, "event", "market", "ts", "price", "volume", "spread"), "event", "ts", "price")
    return {(r.event, int((r.ts - T0).total_seconds() // 60)): (",".join(r.classes), r.held) for r in found.collect()}


def test_a_drift_overrides_a_wide_book(spark):
    rows = [("e", "m", k * 30, 0.30 + 0.025 * k, 20_000.0, 0.35) for k in range(14)]
    got = _alerts(spark, rows)
    assert got["e", 360] == ("DRIFT", "DRIFT_ONLY")  # 0.30 over six hours overrides the spread
    rows[-1] = ("e", "m", 390, 0.58, 20_000.0, 0.35)
    assert _alerts(spark, rows)["e", 390] == ("DRIFT", "ILLIQUID")


def test_reasons_in_order_and_first_snapshots(spark):
    rows = [("a", "m", 0, 0.5, 1000.0, 0.02), ("a", "m", 60, 0.5, 9000.0, 0.02), ("a", "m", 120, 0.5, 100_000.0, 0.4)]
    rows += [("b", "m", k * 60, 0.98, 1000.0, 0.02) for k in range(5)] + [("b", "m", 300, 0.98, 9000.0, 0.02), ("b", "m", 360, 0.98, 90_000.0, 0.4)]
    got = _alerts(spark, rows)
    assert got == {("a", 120): ("VOL_BURST", "ILLIQUID"), ("b", 300): ("VOL_BURST", "RESOLVED"), ("b", 360): ("VOL_BURST", "ILLIQUID")}


def test_the_anchor_may_be_of_any_age_and_the_baseline_is_the_market_s(spark):
    rows = [("e", "x", 0, 0.2, 1000.0, 0.01), ("e", "x", 60 * 24 * 9, 0.28, 20_000.0, 0.01), ("e", "y", 60 * 24 * 9, 0.1, 100.0, 0.01), ("e", "y", 60 * 24 * 9 + 30, 0.5, 20_000.0, 0.01)]
    got = _alerts(spark, rows)
    assert got["e", 60 * 24 * 9 + 30] == ("MODAL_FLIP,SPIKE,DRIFT", None)  # y's own median holds 100 and 20,000
    assert ("e", 60 * 24 * 9) not in got


def test_log_has_a_row_for_each_class(spark):
    rows = [("e", "x", 0, 0.2, 1.0, 0.01), ("e", "y", 30, 0.5, 1.0, 0.01)]
    df = spark.createDataFrame([(*r[:2], T0 + dt.timedelta(minutes=r[2]), *r[3:]) for r in rows], MARKETS)
    log = prediction.alert_log(prediction.cool_down(prediction.alerts(df, "event", "market", "ts", "price", "volume", "spread"), "event", "ts", "price"))
    assert {(r.alert_class, r.sent) for r in log.collect()} == {("MODAL_FLIP", True), ("SPIKE", True)}


@pytest.mark.parametrize("title, serial", [("Views #12", "12"), ("tracker: issue 5", "5"), ("Vol. 3 of it", "3"), ("9 Jun 2026", None), (None, None), ("no. 7", "7"), ("piano 7", None)])
def test_serials(spark, title, serial):
    assert spark.createDataFrame([(title,)], "t string").select(documents.title_serial(F.col("t"))).first()[0] == serial
