"""Compositions that reports and pipelines call: selections, roll-ups, coverage, freshness and snapshot sections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.calendars import weekdays_between
from tidemark.operators.checks import count_if, coverage, duplicates, run_checks, staleness
from tidemark.operators.joins import asof_join, bounded, series_basis
from tidemark.operators.series import arrival_verdict, classify_moves, completion_pass, frozen_share, gaps, keep_one, last_mark_of_day, latest_belief, pct_change


def hygiene_band(df: DataFrame, value: str, low: float, high: float, names: DataFrame, key: str) -> DataFrame:
    """C11: rows inside a price band whose name is on a focus list."""
    return df.where(F.col(value).between(low, high)).join(names.select(key), key, "left_semi")


def cohort(curves: DataFrame, countries: DataFrame, region: str, late: list[str], on: str = "country_id", code: str = "curve") -> DataFrame:
    """Live curves of a region; those on the late list are marked for the later pass, ceased ones are left out."""
    out = curves.where(F.col("cessation_date").isNull()).join(countries.select(F.col("id").alias(on), "region"), on)
    return out.where(F.col("region") == region).withColumn("publishes_late", F.col(code).isin(*late))


def by_pattern(df: DataFrame, column: str, patterns: list[str], active: str | None = None) -> DataFrame:
    """Active rows whose column is LIKE one of the patterns."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col(column).like(p)
    out = df.where(hit)
    return out if active is None else out.where(F.col(active))


def drop_forecasts(df: DataFrame, starred: DataFrame, period: str, applies: Column) -> DataFrame:
    """C17: periods whose header is starred are forecasts and go, for the sources to which that applies."""
    flagged = starred.select(period).distinct().withColumn("__star", F.lit(True))
    return df.join(flagged, period, "left").where(~(F.coalesce("__star", F.lit(False)) & applies)).drop("__star")


def important_changes(df: DataFrame, relevance: str, least: float) -> DataFrame:
    """Changes of at least a relevance; a missing one is dropped."""
    return df.where(F.col(relevance) >= least)


def series_by_code(fact: DataFrame, dim: DataFrame, key: str, code: str, pattern: str) -> DataFrame:
    """C20: facts of the series whose code matches a pattern."""
    return fact.join(dim.where(F.col(code).rlike(pattern)).select(key), key, "left_semi")


def forwards_with_spot(forwards: DataFrame, spot: DataFrame, date: str) -> DataFrame:
    """Forwards with the day's spot; a day without spot is dropped."""
    return forwards.join(spot, date)


def with_latest(dim: DataFrame, fact: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Every series with its count, last date and last value; series without data stay."""
    facts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_obs"), F.max(F.struct(date, value)).alias("__l"))
    return dim.join(facts, key, "left").select(*dim.columns, F.coalesce("n_obs", F.lit(0)).alias("n_obs"), F.col(f"__l.{date}").alias("last_date"), F.col(f"__l.{value}").alias("last_value"))


def daily_closes(df: DataFrame, names: list[str], name: str, ts: str, value: str) -> DataFrame:
    """The last value of each day of several series side by side, on days that all have."""
    marks = last_mark_of_day(df.select(name, ts, value).where(F.col(name).isin(*names)), [name], ts)
    wide = marks.groupBy("mark_date").pivot(name, names).agg(F.max(value))
    return wide.dropna(subset=names)


def explain_missing(missing: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Why an expected item is missing: its market was closed, it is a holiday, or nothing explains it."""
    out = missing.join(status, key, "left")
    return out.withColumn("explanation", F.when(F.col("is_trading_day").isNull(), "unknown").when(~F.col("is_trading_day"), "holiday").when(~F.coalesce("is_open", F.lit(True)), "market closed").otherwise("unexplained"))


def breakdown_totals(reports: list[DataFrame]) -> DataFrame:
    """Stale roll-ups of several domains added up by dimension and code."""
    whole = reports[0]
    for other in reports[1:]:
        whole = whole.unionByName(other)
    return whole.groupBy("dim", "code").agg(F.sum("n_keys").alias("n_keys"), F.sum("n_stale").alias("n_stale"), F.max("worst").alias("worst"))


def daily_counts(df: DataFrame, key: str, ts: str, target: Column, days: int) -> DataFrame:
    """Keys and rows of each day of a look-back."""
    day = F.col(ts).cast("date")
    return df.where(day.between(F.date_sub(target, days), target)).groupBy(day.alias("day")).agg(F.countDistinct(key).alias("n_keys"), F.count(F.lit(1)).alias("n_rows"))


def arrival_histogram(df: DataFrame, keys: list[str], value_date: str, pass_no: Column) -> DataFrame:
    """Rows of each series and value date by load pass."""
    return df.groupBy(*keys, value_date, pass_no.alias("load_pass")).agg(F.count(F.lit(1)).alias("n_rows"))


def flow_and_stock(df: DataFrame, isin: str, version: str, issued: str, base: str, amount: str) -> tuple[DataFrame, DataFrame]:
    """(flow by issue date, stock by base date) over the newest row of each ISIN and base date.

    Of rows of one base date the highest version counts, then the largest amount, then the earliest issue date.
    """
    one = keep_one(df, [isin, base], F.desc(version), F.desc(amount))
    newest = keep_one(df, [isin], F.desc(base), F.desc(version), F.desc(amount), F.asc_nulls_last(issued))
    return newest.groupBy(issued).agg(F.sum(amount).alias("flow")), one.groupBy(base).agg(F.sum(amount).alias("stock"))


def converted_subtotals(df: DataFrame, is_subtotal: Column, keys: list[str], date: str, measures: list[str], rates: DataFrame, rate: str, order: str) -> DataFrame:
    """The sub-total rows' measures as rows (``measure, value, converted``), at one rate for each date.

    A date's rate is its first that is not null in the order of a column; a date without one has a null conversion.
    """
    one = rates.where(F.col(rate).isNotNull()).groupBy(date).agg(F.min_by(rate, order).alias("__rate"))
    sums = df.where(is_subtotal).groupBy(*keys).agg(*[F.sum(F.col(m).cast("double")).alias(m) for m in measures])
    return sums.unpivot(keys, measures, "measure", "value").join(one, date, "left").withColumn("converted", F.col("value") / F.nullif("__rate", F.lit(0.0))).drop("__rate")


def run_summary(pipeline: str, extracted: DataFrame, loaded: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row for the table of runs: rows extracted and loaded, rows that fail a check, the failing checks, a status.

    FAILED if nothing was loaded, WARN if rows were lost or a check fails, else OK.
    """
    failing = [count_if(c).alias(f"c{k}") for k, c in enumerate(checks.values())]
    counts = loaded.agg(F.count(F.lit(1)).alias("rows_loaded"), *failing).crossJoin(F.broadcast(extracted.agg(F.count(F.lit(1)).alias("rows_extracted"))))
    each = [F.coalesce(f"c{k}", F.lit(0)) for k in range(len(checks))]
    out = counts.withColumns({"n_failed": sum(each, F.lit(0)), "details": F.concat_ws(",", *[F.when(n > 0, F.concat(F.lit(f"{name}:"), n.cast("string"))) for name, n in zip(checks, each, strict=True)])})
    status = F.when(F.col("rows_loaded") == 0, "FAILED").when((F.col("rows_loaded") < F.col("rows_extracted")) | (F.col("n_failed") > 0), "WARN").otherwise("OK")
    return out.select(F.lit(pipeline).alias("pipeline"), "rows_extracted", "rows_loaded", "n_failed", "details", status.alias("status"))


def indicator_snapshot(indicators: DataFrame, facts: DataFrame, key: str, since: Column, now: Column, stale_days: dict[str, int]) -> DataFrame:
    """For each indicator its observations, first and last date, rows new since an instant, last value, staleness."""
    belief = latest_belief(facts.select(key, "obs_date", "vintage", "value"), [key, "obs_date"], "vintage")
    last = belief.where("value is not null").groupBy(key).agg(F.count(F.lit(1)).alias("n_obs"), F.min("obs_date").alias("first_obs"), F.max("obs_date").alias("last_obs"), F.max_by("value", "obs_date").alias("last_value"))
    new = facts.groupBy(key).agg(count_if(F.col("ingested_at") >= since).alias("n_new"))
    limit = F.create_map(*[F.lit(x) for pair in stale_days.items() for x in pair])[F.col("frequency")]
    out = indicators.join(last, key, "left").join(new, key, "left")
    return out.withColumns({"n_obs": F.coalesce("n_obs", F.lit(0)), "n_new": F.coalesce("n_new", F.lit(0)), "is_stale": F.coalesce(F.datediff(now, "last_obs") > limit, F.lit(True))})


def category_rollup(snapshot: DataFrame, category: str = "category") -> DataFrame:
    """Indicators, new rows, indicators with new rows and stale ones of each category."""
    return snapshot.groupBy(category).agg(F.count(F.lit(1)).alias("n_indicators"), F.sum("n_new").alias("n_new"), count_if(F.col("n_new") > 0).alias("n_with_new"), count_if(F.col("is_stale")).alias("n_stale"))


def ingest_snapshot(df: DataFrame, vendor: str, report: str, created: str, since: Column) -> DataFrame:
    """Distinct reports and chunks of each vendor since an instant."""
    return df.where(F.col(created) >= since).groupBy(vendor).agg(F.countDistinct(report).alias("n_reports"), F.count(F.lit(1)).alias("n_chunks"))


def checks_by_year(df: DataFrame, date: str, checks: dict[str, Column]) -> DataFrame:
    """The checks of every year in one pass."""
    counts = df.groupBy(F.year(date).alias("year")).agg(*[count_if(c).alias(name) for name, c in checks.items()])
    return counts.unpivot(["year"], list(checks), "check_name", "n_failed")


def behind_target(df: DataFrame, keys: list[str], date: str, target: Column, excused: DataFrame | None = None) -> DataFrame:
    """Keys whose newest date is before the target, without those excused by a holiday."""
    late = df.groupBy(*keys).agg(F.max(F.col(date).cast("date")).alias("latest")).where(F.col("latest") < target)
    return late if excused is None else late.join(excused.select(*keys).distinct(), keys, "left_anti")


def tenor_order(tenor: Column, order: list[str]) -> Column:
    """A tenor's place in a list, others last."""
    at = F.array_position(F.array(*map(F.lit, order)), tenor)
    return F.when(at > 0, at).otherwise(len(order) + 1)


def worst_first(stale: DataFrame, days: str = "days_behind", n: int | None = None) -> DataFrame:
    """The most delayed keys first (a report: ordered, cut only if asked)."""
    out = stale.orderBy(F.desc(days), *[c for c in stale.columns if c != days])
    return out if n is None else out.limit(n)


def last_business_day(days: DataFrame, now: Column, closes: str, zone: str) -> DataFrame:
    """Each calendar's last trading day whose session is complete: today's only after the local close ("HH:mm")."""
    local = F.from_utc_timestamp(now, F.col(zone))
    done = (F.col("d") < local.cast("date")) | ((F.col("d") == local.cast("date")) & (F.date_format(local, "HH:mm") >= F.col(closes)))
    return days.where(F.col("is_trading") & done).groupBy("calendar").agg(F.max("d").alias("last_business_day"))


def missing_actuals(events: DataFrame, key: list[str], now: Column, grace_hours: int = 24) -> DataFrame:
    """Events with a survey or forecast but no actual after a grace, with the number of other rows that have it."""
    due = F.unix_micros(now) - F.unix_micros("event_datetime") > grace_hours * 3_600_000_000
    filled = events.where("actual is not null").groupBy(*key).agg(F.count(F.lit(1)).alias("n_other"))
    late = events.where(F.col("actual").isNull() & F.col("survey").isNotNull() & due).join(filled, key, "left")
    return late.withColumn("verdict", F.when(F.coalesce("n_other", F.lit(0)) > 0, "ONE-LANE").otherwise("UNCOVERED")).drop("n_other")


def holiday_snapshot(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(holidays to insert, new and known ones of each calendar)."""
    keys = ["calendar", "holiday_date"]
    tagged = incoming.select(*keys).distinct().join(stored.select(*keys).distinct().withColumn("__k", F.lit(True)), keys, "left")
    counts = tagged.groupBy("calendar").agg(count_if(F.col("__k").isNull()).alias("n_new"), count_if(F.col("__k").isNotNull()).alias("n_known"))
    return tagged.where("__k is null").drop("__k"), counts


def pct_change_check(df: DataFrame, keys: list[str], ts: str, value: str, threshold: float, top: int = 50) -> DataFrame:
    """K6: the largest changes over a threshold (a report of the ``top`` rows)."""
    return pct_change(df, keys, ts, value, threshold=threshold).orderBy(F.desc(F.abs("pct_change")), *keys, ts).limit(top)


def coverage_and_gaps(df: DataFrame, keys: list[str], ts: str, least_hours: float) -> DataFrame:
    """K8: coverage of each key with the number and the longest of its gaps."""
    found = gaps(df, keys, ts, least_hours).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_gaps"), F.max("gap_hours").alias("longest_gap"))
    return coverage(df, keys, ts).join(found, keys, "left").withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0)))


def period_anomalies(df: DataFrame, keys: list[str], ts: str, values: list[str], before: Column, after: Column, threshold: float) -> DataFrame:
    """Values that moved by a threshold (percent) between two instants, a row for each key and column."""
    a = df.where(F.col(ts) == before).select(*keys, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(keys, values, "column_name", "before_value")
    b = df.where(F.col(ts) == after).select(*keys, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(keys, values, "column_name", "after_value")
    both = a.join(b, [*keys, "column_name"]).withColumn("pct", (F.col("after_value") / F.nullif("before_value", F.lit(0.0)) - 1) * 100)
    return both.where(F.abs("pct") >= threshold)


def synthetic_curve_verdict(df: DataFrame, keys: list[str], ts: str, value: str, *, frozen_bp: float = 0.05, frozen_pct: float = 90.0, suspect_pct: float = 60.0, least: int = 20) -> DataFrame:
    """SYNTHETIC or SUSPECT by the share of frozen sessions, TOO SHORT with few of them, else LIVE."""
    stats = frozen_share(df, keys, ts, value, frozen=frozen_bp)
    return stats.withColumn("verdict", F.when(F.col("sessions") <= least, "TOO SHORT").when(F.col("pct_frozen") >= frozen_pct, "SYNTHETIC").when(F.col("pct_frozen") >= suspect_pct, "SUSPECT").otherwise("LIVE"))


def feed_freshness(newest: DataFrame, as_of: Column, lag: str = "lag_days", grace: str = "grace") -> DataFrame:
    """Families whose newest date is more business days behind than their lag and grace allow."""
    behind = weekdays_between(F.col("newest"), as_of)
    return newest.withColumn("days_behind", behind).withColumn("is_late", F.col("days_behind") > F.col(lag) + F.col(grace))


def dashboard(domains: dict[str, DataFrame], keys: dict[str, list[str]], date: str, checks: dict[str, dict[str, Column]]) -> DataFrame:
    """For each domain the keys, rows, duplicate keys and failing checks, a row each."""
    out = None
    for name, df in domains.items():
        cover = coverage(df, keys[name], date).agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
        twice = duplicates(df, [*keys[name], date]).agg(F.count(F.lit(1)).alias("n_duplicates"))
        failed = run_checks(df, checks[name]).agg(count_if(F.col("status") == "FAIL").alias("n_failed_checks"))
        row = cover.crossJoin(twice).crossJoin(failed).withColumn("domain", F.lit(name))  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def macro_snapshot(modal: DataFrame, event: str, ts: str, price: str, lags: list[int], today: Column, date: str) -> DataFrame:
    """L2: the newest snapshot of each event with its changes over the lags and its section by date."""
    changes = {f"change_{h}h": F.col(price) - F.col(f"{price}_{h}h") for h in lags}
    newest = keep_one(modal, [event], F.desc(ts)).withColumns(changes)
    return newest.withColumn("section", F.when(F.col(date) >= today, "upcoming").when(F.datediff(today, F.col(date)) <= 5, "recent").otherwise("dropped"))


def move_counts(df: DataFrame, event: str, ts: str, price: str) -> DataFrame:
    """Moves of each event by class."""
    return classify_moves(df, [event], ts, price).groupBy(event, "move_class").agg(F.count(F.lit(1)).alias("n"))


def clean_price_rows(df: DataFrame, price: str, date: str, names: list[str]) -> DataFrame:
    """Landed market prices: names trimmed, blanks to null, prices and dates read; rows without either are dropped."""
    trimmed = {c: F.nullif(F.trim(c), F.lit("")) for c in names}
    out = df.withColumns(trimmed | {price: F.regexp_replace(price, ",", "").try_cast("double"), date: F.coalesce(F.try_to_date(date, "dd/MM/yyyy"), F.try_to_date(date, "yyyy-MM-dd"))})
    return out.where(F.col(price).isNotNull() & F.col(date).isNotNull())


def wide_skew_to_long(df: DataFrame, date: str, pattern: str, axes: list[str]) -> DataFrame:
    """A10: a sheet whose headers carry the axes as (date, axes..., value); headers that do not match are left out."""
    columns = [c for c in df.columns if c != date]
    long = df.select(date, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot([date], columns, "__header", "value")
    parts = [F.regexp_extract("__header", pattern, k + 1).alias(a) for k, a in enumerate(axes)]
    return long.where(F.col("__header").rlike(pattern) & F.col("value").isNotNull()).select(date, *parts, "value")


def snapshot_read(df: DataFrame, keys: DataFrame, key: str, date: str, since: Column, until: Column, vintage: str) -> DataFrame:
    """The latest belief of listed series between two dates."""
    wanted = df.join(keys.select(key), key, "left_semi").where(F.col(date).between(since, until))
    return latest_belief(wanted, [key, date], vintage)


def basket(df: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """Canonical name, subgroup and tier of raw names, matched without case; others have nulls."""
    return df.withColumn("__k", F.lower(F.trim(name))).join(dim.withColumn("__k", F.lower(F.trim("raw_name"))).drop("raw_name"), "__k", "left").drop("__k")


def classify_documents(df: DataFrame, rules: DataFrame, hub: str, title: str) -> DataFrame:
    """A document's class by the first rule (place, hub, pattern, class) that fits its hub and title, and its place.

    The rules are a small dimension (``bounded`` counts them): they travel as one row with a list, so no document is shuffled or joined twice.
    """
    listed = bounded(rules).agg(F.sort_array(F.collect_list(F.struct("rule_place", "rule_hub", "rule_pattern", "rule_class"))).alias("__rules"))
    fits = lambda r: (r["rule_hub"] == F.col(hub)) & F.regexp(F.col(title), r["rule_pattern"])
    met = df.crossJoin(F.broadcast(listed)).withColumn("__r", F.get(F.filter("__rules", fits), F.lit(0)))
    return met.select(*df.columns, F.coalesce(F.col("__r.rule_class"), F.lit("other")).alias("doc_class"), F.col("__r.rule_place").alias("rule_place"))


def index_series(tag: Column, products: dict[str, str]) -> Column:
    """The product of an index tag by the first pattern that it matches, as (product, rest); null for none."""
    return F.coalesce(*[F.when(tag.rlike(p), F.struct(F.lit(name).alias("product"), F.regexp_extract(tag, p, 1).alias("rest"))) for name, p in products.items()])


def ranked_lag(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Rows of each key with the first, the last and the largest step between neighbours."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return df.withColumn("__s", F.abs(F.col(value) - F.lag(value).over(w))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.max("__s").alias("largest_step"))


def basis_check(df: DataFrame, on: list[str], series: str, value: str, base: str, other: str, limit: float) -> DataFrame:
    """K7: keys at which two series are further apart than a limit, with both values."""
    return series_basis(df, on, series, value, base, other).where(F.abs("basis") > limit)


def prescreen(bars: DataFrame, history: DataFrame, keys: list[str], ts: str, value: str, threshold: float, lookback_seconds: int) -> DataFrame:
    """K9: bars that moved by a threshold (percent) from the last stored value within the look-back."""
    joined = asof_join(bars, history, keys, ts, value, lookback_seconds, name="last")
    return joined.withColumn("pct", (F.col(value) / F.nullif("last_value", F.lit(0.0)) - 1) * 100).where(F.abs("pct") >= threshold)


@dataclass(frozen=True)
class StalenessSpec:
    """One table to watch: its key, its date and how many days behind are too many."""

    name: str
    table: DataFrame
    key: str
    date: str
    limit: int


def staleness_monitor(specs: list[StalenessSpec], days_behind) -> DataFrame:
    """The keys of all watched tables that are too far behind, worst first, as ``spec, key, latest, days_behind``.

    ``days_behind(date column)`` counts; a key without any date is not reported.
    """
    out = None
    for spec in specs:
        newest = staleness(spec.table, spec.key, [], spec.date, days_behind).where(F.col("days_behind") > spec.limit)
        rows = newest.select(F.lit(spec.name).alias("spec"), F.col(spec.key).cast("string").alias("key"), "latest", "days_behind")
        out = rows if out is None else out.unionByName(rows)
    return out.orderBy(F.desc("days_behind"), "spec", "key")


def arrival_drift(df: DataFrame, keys: list[str], day: str, hour: str, rows: str, latest: Column, *, share: float = 0.9, min_days: int = 10, on_time: float = 0.9, max_late: int = 2) -> DataFrame:
    """Each series' usual completion pass, late days and verdict; BEHIND if its newest day is before ``latest``."""
    done = completion_pass(df, keys, day, hour, rows, share=share)
    verdict = arrival_verdict(done, keys, day, "completion_pass", min_days=min_days, on_time=on_time, max_late=max_late)
    newest = df.groupBy(*keys).agg(F.max(day).alias("newest"))
    return verdict.join(newest, keys).withColumn("verdict", F.when(F.col("newest") < latest, "BEHIND").otherwise(F.col("verdict")))


def hour_checks(df: DataFrame, ts: str, hour: Column, checks: dict[str, Column]) -> DataFrame:
    """The checks over the rows of one hour."""
    return run_checks(df.where(F.date_trunc("hour", ts) == hour), checks)
