"""Trading calendars as tables: holidays by trust, trading days with numbers, and date arithmetic on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import dealt_by


def holiday_set(holidays: DataFrame, priority: list[str], trusted: DataFrame | None = None) -> DataFrame:
    """Each calendar's holidays from one vendor: the trusted one if it has rows, else the first of a priority list."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("vendor"))
    ranked = holidays.withColumn("__rank", F.when(rank > 0, rank).otherwise(len(priority) + 1))
    if trusted is not None:
        ranked = ranked.join(trusted.select("calendar", F.col("vendor").alias("__trusted")), "calendar", "left")
        ranked = ranked.withColumn("__rank", F.when(F.col("vendor") == F.col("__trusted"), 0).otherwise(F.col("__rank"))).drop("__trusted")
    best = ranked.groupBy("calendar").agg(F.min(F.struct("__rank", "vendor"))["vendor"].alias("vendor"))
    return holidays.join(best, ["calendar", "vendor"], "left_semi").select("calendar", "holiday_date", "vendor").distinct()


def trading_days(calendars: DataFrame, holidays: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every date of every calendar with weekend, holiday and trading flags and a running trading-day number.

    ``calendars`` has ``calendar`` and ``weekend`` ("5,6", Monday 0). The number of a day that is not a trading day is
    that of the last one before. Dates and holidays are dealt by calendar once, over tasks counted from the calendars' days.
    """
    spine = calendars.select("calendar", "weekend", F.explode(F.sequence(start, end)).alias("d"), F.lit(False).alias("__off"))
    off = holidays.where(F.col("calendar").isNotNull()).select("calendar", F.lit(None).cast("string").alias("weekend"), F.col("holiday_date").cast("date").alias("d"), F.lit(True).alias("__off"))
    n_days = calendars.agg(F.sum(F.abs(F.datediff(end, start)) + 1)).first()[0]  # one number
    both = dealt_by(spine.unionByName(off), ["calendar"], n_days or 0)
    days = both.withColumn("is_holiday", F.max("__off").over(Window.partitionBy("calendar", "d"))).where(~F.col("__off")).drop("__off")
    days = days.withColumn("is_weekend", F.array_contains(F.split("weekend", ","), F.weekday("d").cast("string"))).withColumn("is_trading", ~F.col("is_weekend") & ~F.col("is_holiday"))
    number = F.sum(F.col("is_trading").cast("int")).over(Window.partitionBy("calendar").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
    return days.drop("weekend").withColumn("trading_no", number)


def neighbours(days: DataFrame) -> DataFrame:
    """Every date with the last trading day before and the next one after it."""
    upto = lambda order: Window.partitionBy("calendar").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.when(F.col("is_trading"), F.col("d"))
    return days.withColumns({"last_trading": F.last(on, ignorenulls=True).over(upto(F.col("d"))), "next_trading": F.last(on, ignorenulls=True).over(upto(F.desc("d")))})


def trading_days_between(spans: DataFrame, days: DataFrame, start: str, end: str) -> DataFrame:
    """I4: trading days after ``start`` up to and including ``end``, from the difference of their numbers."""
    at = days.select("calendar", "d", "trading_no")
    out = spans.join(at.toDF("calendar", start, "__n0"), ["calendar", start]).join(at.toDF("calendar", end, "__n1"), ["calendar", end])
    return out.withColumn("n_trading", F.col("__n1") - F.col("__n0")).drop("__n0", "__n1")


def is_market_open(ts: Column, zone: Column | str, opens: Column, closes: Column, lunch_start: Column | None = None, lunch_end: Column | None = None) -> Column:
    """The local clock ("HH:mm") is within trading hours and not in the lunch break."""
    clock = F.date_format(F.from_utc_timestamp(ts, zone), "HH:mm")
    within = (clock >= opens) & (clock < closes)
    if lunch_start is None:
        return within
    return within & ~F.coalesce((clock >= lunch_start) & (clock < lunch_end), F.lit(False))


def weekdays_between(start: Column, end: Column) -> Column:
    """Weekdays after ``start`` up to and including ``end``, in closed form; negative if ``end`` is earlier."""
    day = lambda c: F.datediff(c, F.lit("1970-01-05").cast("date"))  # noqa: E731  days since a Monday
    upto = lambda c: F.floor(day(c) / 7) * 5 + F.least(F.pmod(day(c), F.lit(7)) + 1, F.lit(5))
    return (upto(end) - upto(start)).cast("int")


def business_days_behind(df: DataFrame, latest: str, reference: Column, holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays from ``latest`` to a reference date, less the weekday holidays in between if given (signed).

    Holidays are numbered in the order of their dates, so those in between are the difference of two numbers; the numbering walks
    through a row for each day that occurs.
    """
    out = df.withColumn("days_behind", weekdays_between(F.col(latest), reference))
    if holidays is None:
        return out
    off = holidays.where(F.weekday("holiday_date") < 5).select("holiday_date").distinct()
    dates = df.select(F.col(latest).alias("d"), F.lit(0).alias("n")).union(off.select("holiday_date", F.when(F.col("holiday_date") <= reference, 1).otherwise(0))).groupBy("d").agg(F.max("n").alias("n"))
    after = F.sum("n").over(Window.orderBy(F.desc_nulls_last("d")).rowsBetween(Window.unboundedPreceding, -1))
    hits = dates.select(F.col("d").alias(latest), F.coalesce(after, F.lit(0)).alias("__h"))
    return out.join(hits, latest, "left").withColumn("days_behind", F.col("days_behind") - F.coalesce("__h", F.lit(0)).cast("int")).drop("__h")


def holiday_hits(currencies: DataFrame, countries: DataFrame, holidays: DataFrame, ts: Column) -> DataFrame:
    """I8: currencies whose country has a holiday on the local date of an instant.

    ``countries`` has ``ccy``, ``calendar`` and ``zone``.
    """
    local = currencies.join(countries, "ccy").withColumn("holiday_date", F.from_utc_timestamp(ts, F.col("zone")).cast("date"))
    return local.join(holidays, ["calendar", "holiday_date"]).select("ccy", "calendar", "holiday_date")


def events_between(events: DataFrame, date: str, today: Column, days_back: int, days_ahead: int, *, confirmed_only: bool = False, category: str | None = None) -> DataFrame:
    """Events around a date, confirmed ones or one category only if asked."""
    out = events.where(F.col(date).between(F.date_sub(today, days_back), F.date_add(today, days_ahead)))
    if confirmed_only:
        out = out.where(~F.coalesce("is_estimated", F.lit(False)))
    return out if category is None else out.where(F.col("category") == category)


def audit_dates(df: DataFrame, date: str, ts: str, zone: str) -> DataFrame:
    """Stored dates against the local date of the instant: OK, MISDATED, or SKIP without an instant or zone."""
    right = F.from_utc_timestamp(ts, F.col(zone)).cast("date")
    status = F.when(F.col(ts).isNull() | F.col(zone).isNull(), "SKIP").when(F.col(date) == right, "OK").otherwise("MISDATED")
    return df.withColumn("date_status", status)


def collapse_events(df: DataFrame, keys: list[str], soft: str, stamp: str, source: str) -> DataFrame:
    """One row for each key: confirmed before soft, timed before untimed, then by source."""
    w = Window.partitionBy(*keys).orderBy(F.col(soft), F.col(stamp).isNull(), F.col(source))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def coherence(pairs: DataFrame, newest: DataFrame, limit: int) -> DataFrame:
    """Derived families whose newest date leads their input's by more than so many business days."""
    d, i = newest.select(F.col("family").alias("derived"), F.col("newest").alias("derived_newest")), newest.select(F.col("family").alias("input"), F.col("newest").alias("input_newest"))
    out = pairs.join(d, "derived").join(i, "input").withColumn("lead_days", weekdays_between(F.col("input_newest"), F.col("derived_newest")))
    return out.where(F.col("lead_days") > limit)


def session_scope(marks: DataFrame, key: str, date: str, ts: str, value: str, before: Column, after: Column, most_minutes: int = 90) -> DataFrame:
    """I16: last mark of each key on two dates, the change in basis points, and whether the marks' clock times are apart."""
    last = lambda day: F.max(F.when(F.col(date) == day, F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))))
    two = marks.where(F.col(date).isin(before, after)).groupBy(key).agg(last(before).alias("a"), last(after).alias("b"))
    minute = lambda c: F.hour(c) * 60 + F.minute(c)
    return two.select(key, ((F.col("b.v") - F.col("a.v")) * 100).alias("change_bp"), (F.abs(minute(F.col("b.t")) - minute(F.col("a.t"))) > most_minutes).alias("mark_mismatch"))


def relaxed(results: DataFrame, days: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """Check results with a failure on a day that is no trading day turned into RELAXED; unknown days stay strict."""
    known = days.select(*keys, F.col("is_trading").alias("__t"))
    soft = (F.col(status) == "FAIL") & ~F.coalesce("__t", F.lit(True))
    return results.join(known, keys, "left").withColumn(status, F.when(soft, "RELAXED").otherwise(F.col(status))).drop("__t")
