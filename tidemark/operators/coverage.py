"""Coverage that grows by a day at a time, and counts that come from the job that writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG2_BINS = 12


def daily_sketches(df: DataFrame, keys: list[str], ts: str, items: list[str], *, log2_bins: int = LOG2_BINS) -> DataFrame:
    """For each key and day the rows, first and last instant, the hours seen (a bitmap) and a HyperLogLog sketch for each item.

    Such rows merge: a new day is sketched by itself and appended, and ``merged_coverage`` puts any days together without
    reading their data again. The standard error of a distinct count is 1.04 / sqrt(2 ** ``log2_bins``), at any number of days.
    """
    hours = F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts)))
    sketches = [F.hll_sketch_agg(F.col(i).cast("string"), log2_bins).alias(f"{i}_sketch") for i in items]
    return df.where(F.col(ts).isNotNull()).groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), hours.alias("hours"), *sketches)


def merged_coverage(days: DataFrame, keys: list[str], items: list[str]) -> DataFrame:
    """Coverage over the days that are there: rows, exact days, first and last instant, hours of the day seen, and estimated distinct items.

    A day that was sketched in several parts counts once.
    """
    counts = [F.hll_sketch_estimate(F.hll_union_agg(f"{i}_sketch")).alias(f"n_{i}") for i in items]
    return days.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.countDistinct("day").alias("n_days"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.bit_count(F.bit_or("hours")).cast("long").alias("n_hours"), *counts)


def relative_error(log2_bins: int = LOG2_BINS) -> float:
    """The standard error of a sketched distinct count."""
    return 1.04 / 2 ** (log2_bins / 2)


def _metrics(checks: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows_extracted"), *[F.count_if(failing).alias(f"failing_{name}") for name, failing in checks.items()]]


def observed_write(df: DataFrame, path: str, checks: dict[str, Column], *, keep: Column | None = None, mode: str = "errorifexists") -> dict[str, int]:
    """Write a table and return, from that one job, how many rows were read, failed each check and were written.

    ``keep`` drops rows after they were counted. The counts are taken while the rows pass by: nothing is read twice.
    """
    seen, written = Observation(), Observation()
    out = df.observe(seen, *_metrics(checks))
    out = out if keep is None else out.where(keep)
    out.observe(written, F.count(F.lit(1)).alias("rows_loaded")).write.mode(mode).parquet(path)
    return seen.get | written.get


def observed_stream(df: DataFrame, checks: dict[str, Column], name: str = "checks") -> DataFrame:
    """A stream that counts rows and failing rows of every micro-batch as they pass; ``batch_metrics`` reads them."""
    return df.observe(name, *_metrics(checks))


def batch_metrics(query: StreamingQuery, name: str = "checks") -> list[dict]:
    """The counts of each recent micro-batch that had rows, with its number."""
    found = []
    for progress in query.recentProgress:
        row = progress["observedMetrics"].get(name) if progress.get("observedMetrics") else None
        if row is not None:
            values = row.asDict() if hasattr(row, "asDict") else dict(row)
            if values["rows_extracted"]:
                found.append({"batch": progress["batchId"]} | values)
    return found
