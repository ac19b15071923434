"""Data-quality predicates and the aggregates behind quality, coverage and staleness reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import bounded
from tidemark.operators.series import keep_one


def count_if(condition: Column) -> Column:
    """Rows for which a condition is true, as a long."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def bound_violations(df: DataFrame, bounds: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows outside their key's [lo, hi]; ``bounds`` has the keys, ``lo`` and ``hi``, and is small or joined by a shuffle."""
    return df.join(bounds, keys).where((F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi")))


def nonpositive(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which one of the columns is zero or less."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c) <= 0 for c in columns]))


#: The comparisons that an order rule may name, and what breaks each.
_BROKEN = {"<=": lambda a, b: a > b, "<": lambda a, b: a >= b, ">=": lambda a, b: a < b, ">": lambda a, b: a <= b, "=": lambda a, b: a != b}


def order_violations(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rows that break a rule (left, comparison, right), with the broken rules; nulls break nothing."""
    broken = F.array(*[F.when(_BROKEN[op](F.col(a), F.col(b)), F.lit(f"{a} {op} {b}")) for a, op, b in rules])
    return df.withColumn("broken", F.filter(broken, lambda r: r.isNotNull())).where(F.size("broken") > 0)


def ohlc_violations(df: DataFrame, o: str = "open_px", h: str = "high_px", l: str = "low_px", c: str = "close_px") -> DataFrame:  # noqa: E741
    """C4: bars whose open or close is not between low and high, or whose low is above high; bars with a null are exempt."""
    return df.where((F.col(l) > F.least(o, c)) | (F.col(h) < F.greatest(o, c)) | (F.col(l) > F.col(h))).where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in (o, h, l, c)]))


def bid_ask_inversions(df: DataFrame, bid: str = "bid", ask: str = "ask") -> DataFrame:
    """Rows whose bid is above their ask."""
    return df.where(F.col(bid) > F.col(ask))


def date_window(df: DataFrame, date: str, today: Column, months_back: int, months_forward: int = 0) -> DataFrame:
    """Rows from so many months back to so many ahead, both ends included."""
    return df.where(F.col(date).between(F.add_months(today, -months_back), F.add_months(today, months_forward)))


def guard_forward(df: DataFrame, date: str, stamp: str, now: Column, *columns: str) -> DataFrame:
    """Columns set to null on events that are not out yet (by instant, else by date)."""
    ahead = F.coalesce(F.col(stamp) > now, F.col(date) >= now.cast("date"))
    return df.withColumns({c: F.when(~ahead, F.col(c)) for c in columns})


def clear_collisions(df: DataFrame, keys: list[str], symbol: str, placeholder: str = "placeholder") -> DataFrame:
    """The symbol set to null where it is a placeholder or not alone in its group."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, symbol))
    return df.withColumn("__n", n).withColumn(symbol, F.when((F.col("__n") == 1) & ~F.lower(symbol).contains(placeholder), F.col(symbol))).drop("__n")


def unresolved(df: DataFrame, closed: str, end: str, price: str, now: Column, pin: float = 0.005) -> DataFrame:
    """Markets that are not closed, nor past their end with a price pinned to either side."""
    pinned = (F.col(end) < now) & ((F.col(price) <= pin) | (F.col(price) >= 1 - pin))
    return df.where(~F.coalesce(closed, F.lit(False)) & ~F.coalesce(pinned, F.lit(False)))


def curated(df: DataFrame, text: str, include: str, exclude: str, volume: str, floor: float) -> DataFrame:
    """Rows whose text matches one pattern and not another, above a volume floor."""
    return df.where(F.col(text).rlike(include) & ~F.col(text).rlike(exclude) & (F.col(volume) >= floor))


def with_reject_reason(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """C14: the name of the first condition that holds as ``reject_reason``; good rows have null."""
    return df.withColumn("reject_reason", F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()]))


def reject_counts(df: DataFrame) -> DataFrame:
    """C14: rows by reject reason, good ones as "ok"."""
    return df.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def weekdays_only(df: DataFrame, date: str) -> DataFrame:
    """Rows from Monday to Friday."""
    return df.where(F.weekday(date) < 5)


def drop_placeholders(df: DataFrame, estimated: str, source: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows that are estimated or without a source and have none of the fields)."""
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in fields])
    placeholder = F.coalesce((F.coalesce(estimated, F.lit(False)) | F.col(source).isNull()) & empty, F.lit(False))
    return df.where(~placeholder), df.where(placeholder)


def conditional_counts(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """For each key the rows and the rows that meet each condition, in one pass."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[count_if(c).alias(name) for name, c in conditions.items()])


def violation_summary(df: DataFrame, bounds: DataFrame, keys: list[str], value: str) -> DataFrame:
    """For each key with a violation their number and range."""
    return bound_violations(df, bounds, keys, value).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_violations"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def distribution(df: DataFrame, keys: list[str], value: str, percentiles: tuple[float, ...] = (0.01, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """Count, mean, sample deviation, range and exact interpolated percentiles of each key."""
    stats = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min_value"), F.max(value).alias("max_value")]
    quantiles = F.expr(f"percentile({value}, array({', '.join(f'{p}D' for p in percentiles)}))")
    return df.groupBy(*keys).agg(*stats, quantiles.alias("__q")).select(*keys, "n", "mean", "std", "min_value", "max_value", *[F.col("__q")[k].alias(f"p{round(p * 100)}") for k, p in enumerate(percentiles)])


def return_distribution(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Distribution of the relative change between neighbouring rows of a key."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(ts))
    returns = df.withColumn("ret", (F.col(value) - before) / F.nullif(before, F.lit(0.0))).where("ret is not null")
    return distribution(returns, keys, "ret", (0.05, 0.5, 0.95))


def sigma_outliers(df: DataFrame, keys: list[str], value: str, n_sigma: float = 3.0) -> DataFrame:
    """Rows more than so many sample deviations from their key's mean; keys without spread have none."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")).where("std > 0")
    return df.join(stats, keys).withColumn("z", (F.col(value) - F.col("mean")) / F.col("std")).where(F.abs("z") > n_sigma)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def table_facts(df: DataFrame, ts: str, value: str, now: Column) -> DataFrame:
    """Rows, nulls, range, newest instant and its age in hours, in one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), count_if(F.col(value).isNull()).alias("n_null"), F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.max(ts).alias("newest"), ((F.unix_micros(now) - F.unix_micros(F.max(ts))) / 3.6e9).alias("age_hours"))


def coverage(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Rows, distinct dates, first and last date of each key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.col(date).cast("date")).alias("n_dates"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def grid_on_latest(df: DataFrame, keys: list[str], date: str, axes: list[str]) -> DataFrame:
    """How many distinct values of each axis a key has on its latest date."""
    last = F.max(date).over(Window.partitionBy(*keys))
    return df.withColumn("__last", last).where(F.col(date) == F.col("__last")).groupBy(*keys).agg(F.max(date).alias("latest"), *[F.countDistinct(a).alias(f"n_{a}") for a in axes])


def hourly_coverage(df: DataFrame, keys: list[str], ts: str, is_open) -> DataFrame:
    """Share of a key's open market hours, from its first to its last, that hold a row.

    The expected hours come from a formula-free count over the spine of hours of the whole table, which grows with time
    but not with rows: each key takes the difference of the running count at its ends.
    """
    hour = F.date_trunc("hour", ts)
    seen = df.select(*keys, hour.alias("hour")).where(is_open(hour)).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("actual_hours"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
    ends = df.agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour"))
    run = spine.withColumn("is_open", is_open(F.col("hour")).cast("int"))
    month = F.trunc("hour", "MM")
    inside = Window.partitionBy(month).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    months = run.groupBy(month.alias("__m")).agg(F.sum("is_open").alias("n"))
    before = months.withColumn("__before", F.coalesce(F.sum("n").over(Window.orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counted = run.withColumn("__in", F.sum("is_open").over(inside)).withColumn("__m", month).join(before, "__m").select("hour", (F.col("__in") + F.col("__before")).alias("upto"))
    first, last = counted.select(F.col("hour").alias("first_hour"), F.col("upto").alias("u1")), counted.select(F.col("hour").alias("last_hour"), F.col("upto").alias("u2"))
    out = seen.join(first, "first_hour").join(last, "last_hour").withColumn("expected_hours", F.col("u2") - F.col("u1") + 1)
    return out.select(*keys, "first_hour", "last_hour", "actual_hours", "expected_hours", F.round(F.col("actual_hours") * 100.0 / F.greatest("expected_hours", F.lit(1)), 2).alias("coverage_pct"))


def staleness(df: DataFrame, key: str, dims: list[str], date: str, days_behind) -> DataFrame:
    """Newest date of each key in each dimension value and how far behind it is, as ``days_behind(date column)``."""
    return df.groupBy(key, *dims).agg(F.max(F.col(date).cast("date")).alias("latest")).withColumn("days_behind", days_behind(F.col("latest")))


def stale_rollup(stale: DataFrame, dims: list[str], limit: int) -> DataFrame:
    """For every value of each dimension by itself the keys, the stale ones and the worst delay (grouping sets)."""
    names = F.coalesce(*[F.when(F.col(d).isNotNull(), F.lit(d)) for d in dims])
    sets = stale.groupingSets([[d] for d in dims], *dims).agg(F.count(F.lit(1)).alias("n_keys"), count_if(F.col("days_behind") > limit).alias("n_stale"), F.max("days_behind").alias("worst"))
    return sets.select(names.alias("dim"), F.coalesce(*[F.col(d).cast("string") for d in dims]).alias("code"), "n_keys", "n_stale", "worst")


def captured_hours(df: DataFrame, keys: list[str], ts: str, expected: list[int]) -> DataFrame:
    """For each key and day the hours with rows and the expected hours without."""
    day = df.groupBy(*keys, F.col(ts).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_set(F.hour(ts))).alias("hours"))
    return day.withColumn("missing", F.array_except(F.array(*map(F.lit, expected)), "hours"))


def ohlc_bars(ticks: DataFrame, keys: list[str], ts: str, price: str, *, width: str = "1 hour", min_ticks: int = 1, bid: str | None = None, ask: str | None = None) -> DataFrame:
    """Bars from ticks: first, highest, lowest and last price, mean, exact median, tick count, last bid and ask.

    Of ticks at one instant the smaller price is first and the larger last. Null prices are no ticks.
    """
    by = lambda c: F.struct(F.col(ts), F.col(c))
    aggs = [F.min(by(price))[price].alias("open_px"), F.max(price).alias("high_px"), F.min(price).alias("low_px"), F.max(by(price))[price].alias("close_px"), F.avg(price).alias("mean_px"), F.expr(f"percentile({price}, 0.5)").alias("median_px"), F.count(F.lit(1)).alias("n_ticks")]
    aggs += [F.max(by(c))[c].alias(name) for c, name in ((bid, "last_bid"), (ask, "last_ask")) if c]
    bars = ticks.where(F.col(price).isNotNull()).groupBy(*keys, F.window(ts, width)).agg(*aggs).where(F.col("n_ticks") >= min_ticks)
    return bars.select(*keys, F.col("window.start").alias("bar_ts"), *[c for c in bars.columns if c not in (*keys, "window")])


def weekly_median(df: DataFrame, group: list[str], market: str, date: str, value: str, *, least_markets: int = 5, floor: float = 0.0, cap: float = float("inf")) -> DataFrame:
    """Weekly median over one value (the largest) for each market and day, inside a price band and with enough markets."""
    one = df.where(F.col(value).between(floor, cap)).groupBy(*group, market, F.col(date).cast("date").alias("day")).agg(F.max(value).alias("v"))
    week = one.groupBy(*group, F.date_trunc("week", "day").cast("date").alias("week")).agg(F.expr("percentile(v, 0.5)").alias("median_value"), F.countDistinct(market).alias("n_markets"))
    return week.where(F.col("n_markets") >= least_markets)


def month_on_month(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """Mean of each month and its change on the month before, in percent; null after a gap."""
    monthly = df.groupBy(*keys, F.trunc(date, "MM").alias("month")).agg(F.avg(value).alias("level"))
    w = Window.partitionBy(*keys).orderBy("month")
    before = F.when(F.lag("month").over(w) == F.add_months("month", -1), F.lag("level").over(w))
    return monthly.withColumn("mom_pct", (F.col("level") / F.nullif(before, F.lit(0.0)) - 1) * 100)


def weighted_composite(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean of the values that are there, weights taken anew over them."""
    there = F.col(value).isNotNull()
    return df.groupBy(*keys).agg((F.sum(F.when(there, F.col(value) * F.col(weight))) / F.nullif(F.sum(F.when(there, F.col(weight))), F.lit(0.0))).alias("composite"))


def modal_date_sum(df: DataFrame, key: list[str], date: str, a: str, b: str, floor: int = 1) -> DataFrame:
    """Each key's most frequent date (latest on ties) and the sums over rows on it that have both legs."""
    counts = df.groupBy(*key, F.col(date).alias("modal_date")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col(b).isNotNull(), F.col(a))).alias("sum_a"), F.sum(F.when(F.col(a).isNotNull(), F.col(b))).alias("sum_b"))
    return keep_one(counts, key, F.desc("n_rows"), F.desc("modal_date")).where(F.col("n_rows") >= floor).withColumn("departure_pct", (F.col("sum_a") / F.nullif("sum_b", F.lit(0)) - 1) * 100)


def monthly_sum(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """Sums by month."""
    return df.groupBy(*keys, F.trunc(date, "MM").alias("month")).agg(F.sum(value).alias("total"))


def error_digest(df: DataFrame, kind: str, message: str, tag: str, k: int = 3) -> DataFrame:
    """Rows by kind and message with the k smallest tags."""
    first = F.row_number().over(Window.partitionBy(kind, message).orderBy(tag))
    counts = df.groupBy(kind, message).agg(F.count(F.lit(1)).alias("n"))
    sample = df.select(kind, message, tag).distinct().withColumn("__n", first).where(F.col("__n") <= k).groupBy(kind, message).agg(F.sort_array(F.collect_list(tag)).alias("sample"))
    return counts.join(sample, [kind, message])


def rule_overlap(actions: DataFrame, rule: str, row_id: str) -> DataFrame:
    """For each rule the rows it flags, those only it flags, and the overlap."""
    rules = actions.select(rule, row_id).distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy(row_id))
    return rules.withColumn("__n", n).groupBy(rule).agg(F.count(F.lit(1)).alias("total"), count_if(F.col("__n") == 1).alias("unique_rows"), count_if(F.col("__n") > 1).alias("overlap"))


def lanes_report(df: DataFrame, expected: DataFrame, lane: str, published: str, now: Column, tolerance_days: int) -> DataFrame:
    """Rows, last publication and staleness of every expected lane; one without rows is reported missing."""
    got = df.groupBy(lane).agg(F.count(F.lit(1)).alias("n_rows"), F.max(published).alias("last_published"))
    status = F.when(F.col("last_published").isNull(), "MISSING").when(F.datediff(now, "last_published") > tolerance_days, "STALE").otherwise("OK")
    return expected.join(got, lane, "left").select(lane, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "last_published", status.alias("status"))


def verify_append(df: DataFrame, created: str, day: Column, expected: int) -> DataFrame:
    """Rows created on a day against an expected number."""
    there = df.where(F.col(created).cast("date") == day)
    return there.agg(F.count(F.lit(1)).alias("actual"), F.min(created).alias("first_created"), F.max(created).alias("last_created")).withColumn("missing", F.lit(expected) - F.col("actual"))


def region_of(df: DataFrame, key: str, tag: str, regions: list[str]) -> DataFrame:
    """A key's region: the one regional tag, "global" for two or more, "" for none."""
    found = df.groupBy(key).agg(F.collect_set(F.when(F.col(tag).isin(*regions), F.col(tag))).alias("r"))
    return found.select(key, F.when(F.size("r") == 0, "").when(F.size("r") == 1, F.get("r", F.lit(0))).otherwise("global").alias("region"))


def family_freshness(series: DataFrame, families: DataFrame, code: str, date: str, as_of: Column) -> DataFrame:
    """For each family (name, pattern, tolerance) the series that match, the newest date and whether it is late.

    Families are a small dimension; the pattern join reads each series once for each family.
    """
    per_series = series.groupBy(code).agg(F.max(date).alias("newest"))
    met = per_series.join(F.broadcast(bounded(families)), F.like(per_series[code], families["pattern"]))
    out = met.groupBy("name", "tolerance").agg(F.countDistinct(code).alias("n_series"), F.max("newest").alias("newest"))
    return out.withColumn("is_late", F.datediff(as_of, "newest") > F.col("tolerance"))


def run_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass over the table, a row for each check: name, failing rows, status."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[count_if(c).alias(f"c{k}") for k, c in enumerate(checks.values())])
    each = F.array(*[F.struct(F.lit(name).alias("check_name"), F.coalesce(f"c{k}", F.lit(0)).alias("n_failed")) for k, name in enumerate(checks)])
    rows = counts.select("__n", F.explode(each).alias("c")).select(F.col("c.check_name").alias("check_name"), F.col("__n").alias("n_rows"), F.col("c.n_failed").alias("n_failed"))
    return rows.withColumn("status", F.when(F.col("n_failed") > 0, "FAIL").otherwise("PASS"))


def audit_row(spark, pipeline: str, status: str, extracted: int, loaded: int, started: str, details: str = "") -> DataFrame:
    """One row for the table of pipeline runs."""
    return spark.createDataFrame([(pipeline, status, extracted, loaded, details)], "pipeline string, status string, rows_extracted long, rows_loaded long, details string").withColumns({"started_at": F.lit(started).cast("timestamp"), "finished_at": F.current_timestamp()})
