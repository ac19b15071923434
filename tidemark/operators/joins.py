"""Joins: as-of, windowed matching, anti and semi joins, grids and reconciliations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import carried


MOST_RULES = 10_000


def bounded(df: DataFrame, most: int = MOST_RULES) -> DataFrame:
    """The table itself if it has at most so many rows, for tables of rules that every task gets; a larger one raises."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows where a small table of rules is meant")
    return df


def lookup(fact: DataFrame, dim: DataFrame, on: list[str], *, required: bool = False) -> DataFrame:
    """Left join to a dimension with an ``unmapped`` flag; with ``required`` an unmapped row fails the job."""
    found = fact.join(dim.withColumn("__found", F.lit(True)), on, "left").withColumn("unmapped", F.col("__found").isNull()).drop("__found")
    if not required:
        return found
    return found.where(F.when(F.col("unmapped"), F.raise_error(F.lit(f"no match in the dimension on {on}"))).otherwise(F.lit(True)).cast("boolean")).drop("unmapped")


def latest_rows(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """D3: the rows of each key on its own latest date (ties all stay)."""
    return df.join(df.groupBy(*keys).agg(F.max(date).alias(date)), [*keys, date], "left_semi")


def series_basis(df: DataFrame, on: list[str], series: str, value: str, base: str, other: str) -> DataFrame:
    """Base and other series side by side on their common keys, with the difference."""
    left = df.where(F.col(series) == base).select(*on, F.col(value).alias("base_value"))
    right = df.where(F.col(series) == other).select(*on, F.col(value).alias("other_value"))
    return left.join(right, on).withColumn("basis", F.col("other_value") - F.col("base_value"))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], ts: str, value: str, lookback_seconds: int, *, strict: bool = True, name: str = "asof") -> DataFrame:
    """Each left row with the last ``value`` of its key before ``ts`` (at it too, unless strict) within a look-back.

    Adds ``<name>_ts`` and ``<name>_value``. Time is cut into stretches of the look-back and each right row is put into
    its own and the next, so a key's rows are spread over many tasks and one window sort answers every left row. Of
    right rows at one instant the largest value counts; rows with null keys, times or values match nothing.
    """
    stretch = F.floor(F.unix_micros(ts) / (lookback_seconds * 1_000_000))
    rights = right.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(*on, ts, F.explode(F.array(stretch, stretch + 1)).alias("__bucket"), F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")).alias("__right"))
    rights = rights.withColumn("__row", F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType))
    lefts = left.select(*on, ts, stretch.alias("__bucket"), F.lit(None).cast(rights.schema["__right"].dataType).alias("__right"), F.struct(*left.columns).alias("__row"))
    side = F.col("__row").isNotNull().cast("int") * (-1 if strict else 1)
    w = Window.partitionBy(*on, "__bucket").orderBy(F.col(ts), side, F.col("__right")).rowsBetween(Window.unboundedPreceding, 0)
    both = lefts.unionByName(rights).withColumn("__last", F.last("__right", ignorenulls=True).over(w)).where("__row is not null")
    fresh = (F.unix_micros(ts) - F.unix_micros("__last.ts") <= lookback_seconds * 1_000_000) & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    return both.select("__row.*", F.when(fresh, F.col("__last.ts")).alias(f"{name}_ts"), F.when(fresh, F.col("__last.value")).alias(f"{name}_value"))


def asof_lags(df: DataFrame, on: list[str], ts: str, value: str, lags_hours: list[int], lookback_seconds: int | None = 7 * 86_400, *, stretch_seconds: int = 7 * 86_400) -> DataFrame:
    """For each row the key's value as of so many hours earlier (at that instant included), a column for each lag.

    All lags take one pass: every value also stands at its instant plus each lag, marked with the lag, and a row takes the
    last of each mark. Without a ``lookback_seconds`` a value holds however old it is. Rows are spread over tasks by
    stretches of time; of values at one instant the largest counts; null values, keys and times match nothing.
    """
    hour = 3_600_000_000
    columns = df.columns
    row, point = df.select(F.struct(*columns)).schema[0].dataType, F.struct(F.unix_micros(ts).alias("at"), F.col(value).alias("value"))
    lefts = df.select(*on, ts, F.lit(None).cast("int").alias("__lag"), F.lit(None).cast(df.select(point).schema[0].dataType).alias("__point"), F.struct(*columns).alias("__row"))
    marks = F.explode(F.array(*[F.lit(h) for h in lags_hours]))
    rights = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(*on, ts, marks.alias("__lag"), point.alias("__point"), F.lit(None).cast(row).alias("__row"))
    rights = rights.withColumn(ts, F.timestamp_micros(F.unix_micros(ts) + F.col("__lag") * hour))
    last = {f"__l{h}": F.when(F.col("__lag") == h, F.col("__point")) for h in lags_hours}
    both = carried(lefts.unionByName(rights), on, ts, last, micros=stretch_seconds * 1_000_000, order=(F.col("__row").isNotNull(), F.col("__point"))).where("__row is not null")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])

    def fresh(h: int) -> Column:
        age = F.unix_micros(ts) - h * hour - F.col(f"__l{h}.at")
        return known if lookback_seconds is None else known & (age <= lookback_seconds * 1_000_000)

    return both.select("__row.*", *[F.when(fresh(h), F.col(f"__l{h}.value")).alias(f"{value}_{h}h") for h in lags_hours])


def previous_snapshot(df: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Distinct snapshots of each key with the one strictly before."""
    return df.select(*key, ts).distinct().withColumn(f"prior_{ts}", F.lag(ts).over(Window.partitionBy(*key).orderBy(ts)))


def children_with_prior(df: DataFrame, parent: str, child: str, ts: str, value: str) -> DataFrame:
    """Every child row with the same child's value at the parent's snapshot before; a child without one is new."""
    before = previous_snapshot(df, [parent], ts)
    prior = df.select(parent, child, F.col(ts).alias(f"prior_{ts}"), F.col(value).alias(f"prior_{value}"))
    found = df.join(before, [parent, ts]).join(prior, [parent, child, f"prior_{ts}"], "left")
    return found.withColumn("is_new", F.col(f"prior_{value}").isNull())


def match_within_days(left: DataFrame, right: DataFrame, on: list[str], date: str, days: int = 3) -> DataFrame:
    """Reconcile two event lists: MATCH on the day, DATE_MISMATCH within ``days``, LEFT_ONLY or RIGHT_ONLY.

    Of several right dates the same day wins, then the earliest difference from -days up. The range join runs on the key
    and a bucket of days, never on all pairs. Rows are (key..., left_date, right_date, status).
    """
    l = left.select(*on, F.col(date).alias("left_date")).distinct()  # noqa: E741
    r = right.select(*on, F.col(date).alias("right_date")).distinct()
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    lb = l.withColumn("__b", F.explode(F.sequence(F.floor((day("left_date") - days) / (2 * days + 1)), F.floor((day("left_date") + days) / (2 * days + 1)))))
    rb = r.withColumn("__b", F.floor(day("right_date") / (2 * days + 1)))
    near = lb.join(rb, [*on, "__b"]).withColumn("delta", F.datediff("right_date", "left_date")).where(F.abs("delta") <= days)
    rank = F.row_number().over(Window.partitionBy(*on, "left_date").orderBy(F.col("delta") != 0, "delta"))
    best = near.withColumn("__rank", rank).where("__rank = 1").select(*on, "left_date", "right_date", F.when(F.col("delta") == 0, "MATCH").otherwise("DATE_MISMATCH").alias("status"))
    alone = l.join(best.select(*on, "left_date"), [*on, "left_date"], "left_anti").select(*on, "left_date", F.lit(None).cast("date").alias("right_date"), F.lit("LEFT_ONLY").alias("status"))
    other = r.join(near.select(*on, "right_date").distinct(), [*on, "right_date"], "left_anti").select(*on, F.lit(None).cast("date").alias("left_date"), "right_date", F.lit("RIGHT_ONLY").alias("status"))
    return best.unionByName(alone).unionByName(other)


def match_by_words(left: DataFrame, right: DataFrame, on: list[str], date: str, words: str, days: int = 3, least_shared: int = 2, *, most_pairs: int = 50_000) -> DataFrame:
    """For each left row the right row of the key within ``days`` that shares at least so many words.

    Ties go to the nearest date, then more shared words, then the earlier date, then the smaller words. ``words`` is an array column; null dates match
    nothing, null words are none. Rows are dealt by the key and a stretch of days once, right rows also into the stretch that they reach into. Where a
    stretch has at most ``most_pairs`` pairs of a left and a right row, these are compared there and then. In larger stretches rows meet by their words: a
    left row is looked up by all its words but the ``least_shared - 1`` that most right rows of the stretch have, as who shares enough words shares one of the others.
    """
    day, width = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date")), max(28, 4 * (2 * days + 1))
    place = lambda c: F.floor(c / width)
    group = [*on, "__b"]
    sides = [df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*on, date, words)])).select(*on, F.col(date).alias("__d"), F.col(words).alias("__words")) for df in (left, right)]
    lefts = sides[0].withColumn("__b", place(day("__d"))).withColumn("__left", F.lit(True))
    rights = sides[1].withColumn("__b", F.explode(F.sequence(place(day("__d") - days), place(day("__d") + days)))).withColumn("__left", F.lit(False))
    dealt = lefts.unionByName(rights).repartition(*group).distinct()
    w = Window.partitionBy(*group)
    pairs = F.count_if("__left").over(w) * F.count_if(~F.col("__left")).over(w)
    dealt = dealt.withColumn("__pairs", pairs).where("__pairs > 0")
    listed = lambda is_left: F.collect_list(F.when(F.col("__left") == is_left, F.struct("__d", "__words")))
    few = dealt.where(F.col("__pairs") <= most_pairs).groupBy(*group).agg(listed(True).alias("__ls"), listed(False).alias("__rs"))  # bounded by most_pairs
    few = few.select(*group, F.explode("__ls").alias("__l"), "__rs").select(*group, "__l", F.explode("__rs").alias("__r"))
    few = few.select(*group, F.col("__l.__d").alias("left_date"), F.col("__l.__words").alias("left_words"), F.col("__r.__d").alias("right_date"), F.col("__r.__words").alias("right_words"))
    many = dealt.where(F.col("__pairs") > most_pairs)
    l = many.where("__left").select(*group, F.col("__d").alias("left_date"), F.col("__words").alias("left_words"))  # noqa: E741
    each = many.where("not __left").select(*group, F.col("__d").alias("right_date"), F.col("__words").alias("right_words"), F.explode(F.array_distinct("__words")).alias("__w"))
    counts = each.groupBy(*group, "__w").agg(F.count(F.lit(1)).alias("__c"))
    rare = l.withColumn("__w", F.explode(F.array_distinct("left_words"))).join(counts, [*group, "__w"]).groupBy(*group, "left_date", "left_words").agg(F.sort_array(F.collect_list(F.struct("__c", "__w"))).alias("__r"))  # the words of one row
    looked = rare.where(F.size("__r") >= least_shared).select(*group, "left_date", "left_words", F.explode(F.slice("__r", F.lit(1), F.size("__r") - (least_shared - 1))).alias("__x"))
    looked = looked.withColumn("__w", F.col("__x.__w")).drop("__x")
    near = F.abs(F.datediff("left_date", "right_date")) <= days
    met = looked.join(each, [*group, "__w"]).where(near).drop("__w").distinct()
    shared = F.size(F.array_intersect(F.array_compact("left_words"), F.array_compact("right_words"))).cast("long")
    order = Window.partitionBy(*group, "left_date", "left_words").orderBy(F.abs(F.datediff("left_date", "right_date")), F.desc("shared"), "right_date", "right_words")

    def best(pairs: DataFrame) -> DataFrame:  # a left row lies in one stretch
        found = pairs.where(near).withColumn("shared", shared).where(F.col("shared") >= least_shared)
        return found.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").select(*on, "left_date", "left_words", "right_date", "right_words", "shared")

    return best(few).unionByName(best(met))


def insert_missing(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows whose key is not there yet, one for each key (the smallest row)."""
    fresh = incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
    return fresh.groupBy(*keys).agg(F.min(F.struct(*[c for c in fresh.columns if c not in keys])).alias("__row")).select(*keys, "__row.*")


def keys_in(df: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in a batch."""
    return df.join(batch.select(*keys), keys, "left_semi")


def pairs_of(currencies: DataFrame, pairs: DataFrame, ccy: str, base: str, quote: str) -> DataFrame:
    """Pairs in which a currency is either leg, by exploding the legs into an equi join."""
    legs = pairs.withColumn(ccy, F.explode(F.array_distinct(F.array(base, quote))))
    return currencies.join(legs, ccy)


def expected_grid(*axes: DataFrame) -> DataFrame:
    """Every combination of small dimensions (the grid is the product of its axes by definition)."""
    return reduce(lambda a, b: a.crossJoin(b), axes)


def missing_from_grid(grid: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """Grid cells without a row."""
    return grid.join(df.select(*keys).distinct(), keys, "left_anti")


def resolve_joined_key(df: DataFrame, key: str, axes: list[DataFrame], codes: list[str]) -> DataFrame:
    """Split a concatenated key by the product of its axes' codes; a row without a match has nulls."""
    table = expected_grid(*axes).withColumn(key, F.concat(*codes))
    return df.join(table, key, "left")


def ratio(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Left value over right value on common keys; null over zero."""
    r = right.select(*on, F.col(value).alias("__r"))
    return left.select(*on, F.col(value).alias("__l")).join(r, on).select(*on, (F.col("__l") / F.nullif("__r", F.lit(0))).alias("ratio"))


def balance(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Both values on all keys, and left less right where both are there."""
    l = left.select(*on, F.col(value).alias("left_value"))  # noqa: E741
    r = right.select(*on, F.col(value).alias("right_value"))
    return l.join(r, on, "full").withColumn("balance", F.col("left_value") - F.col("right_value"))


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys equal null keys."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in on], *[c for c in right.columns if c not in on])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__{k}"]) for k in on])
    return left.join(r, condition, how).drop(*[f"__{k}" for k in on])


def other_lanes(df: DataFrame, key: list[str], lane: str, value: str) -> DataFrame:
    """For rows without a value, which other lanes have one for the same key: ONE-LANE names them, else UNCOVERED."""
    filled = df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.sort_array(F.collect_set(lane)).alias("lanes"))
    blank = df.where(F.col(value).isNull()).select(*key, lane).join(filled, key, "left")
    others = F.array_except(F.coalesce("lanes", F.array().cast("array<string>")), F.array(F.col(lane).cast("string")))
    return blank.withColumn("lanes", others).withColumn("verdict", F.when(F.size("lanes") > 0, "ONE-LANE").otherwise("UNCOVERED"))


def month_end_snapshots(df: DataFrame, keys: list[str], date: str, start: Column, end: Column, within_days: int = 5) -> DataFrame:
    """For each key and month end, the last date with data at most ``within_days`` before it (null, if none).

    A date is offered to every month end from its own month's to the last that ``within_days`` reach.
    """
    spine = df.select(*keys).distinct().withColumn("month_end", F.explode(F.transform(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")), lambda d: F.last_day(d))))
    reach = df.select(*keys, F.col(date).alias("snapshot")).distinct().withColumn("month_end", F.explode(F.transform(F.sequence(F.trunc("snapshot", "MM"), F.trunc(F.date_add("snapshot", within_days), "MM"), F.expr("interval 1 month")), lambda d: F.last_day(d))))
    near = reach.where(F.datediff("month_end", "snapshot").between(0, within_days)).groupBy(*keys, "month_end").agg(F.max("snapshot").alias("snapshot"))
    return spine.join(near, [*keys, "month_end"], "left")


def rebuild_hours(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Hours from ``start`` to ``end`` (not included) that hold no row."""
    spark = df.sparkSession
    spine = spark.range(1).select(F.explode(F.sequence(F.date_trunc("hour", start), F.timestamp_micros(F.unix_micros(end) - 1), F.expr("interval 1 hour"))).alias("hour"))
    return spine.join(df.select(F.date_trunc("hour", ts).alias("hour")).distinct(), "hour", "left_anti")
