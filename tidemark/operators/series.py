"""Series operators: changes, latest beliefs, gaps, rolling robust statistics, interpolation, reshaping."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path

MAD_SCALE = 1.4826


def _w(keys: list[str], *order: str | Column) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


ROWS_EACH = 1_000_000


def dealt_by(df: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """The rows by key over so many partitions that a task holds about ``ROWS_EACH``, however many there are in all.

    Without a number, windows take the session's shuffle partitions at most, and a task's part grows with the table.
    """
    return df if n_rows <= ROWS_EACH else df.repartition(-(-n_rows // ROWS_EACH), *keys)


def pct_change(df: DataFrame, keys: list[str], ts: str, value: str, *, threshold: float | None = None, near_zero: float = 1e-12) -> DataFrame:
    """percentage change from the row before; null at the start and after a value near zero; over a threshold only if given."""
    before = F.lag(value).over(_w(keys, ts))
    out = df.withColumn("prev_value", before)
    out = out.withColumn("pct_change", F.when(F.abs("prev_value") > near_zero, (F.col(value) - F.col("prev_value")) / F.abs("prev_value") * 100))
    return out if threshold is None else out.where(F.abs("pct_change") > threshold)


def keep_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """the first row of each key in a total order."""
    return df.withColumn("__n", F.row_number().over(_w(keys, *order))).where("__n = 1").drop("__n")


def with_group_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """every row with the number of rows of its group."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def top_by(df: DataFrame, score: Column, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows of the highest score (a report), ties by the given columns."""
    return df.orderBy(score.desc_nulls_last(), *ties).limit(n)


def last_mark_of_day(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """each key's last row of every day (of equal instants the largest row)."""
    rest = [c for c in df.columns if c not in keys]
    day = df.withColumn("mark_date", F.col(ts).cast("date"))
    return day.groupBy(*keys, "mark_date").agg(F.max(F.struct(ts, *[c for c in rest if c != ts])).alias("r")).select(*keys, "mark_date", "r.*")


def latest_belief(df: DataFrame, keys: list[str], vintage: str, *, release: str | None = None, asof: Column | None = None) -> DataFrame:
    """the row of the highest vintage of each key, among those released by ``asof`` if given."""
    known = df if asof is None else df.where(F.col(release) <= asof)
    rest = [c for c in df.columns if c not in keys and c != vintage]
    return known.groupBy(*keys).agg(F.max(F.struct(vintage, *rest)).alias("r")).select(*keys, "r.*")


def gaps(df: DataFrame, keys: list[str], ts: str, least_hours: float = 1.0) -> DataFrame:
    """neighbouring distinct instants of a key that are more than so many hours apart."""
    following = F.lead(ts).over(_w(keys, ts))
    out = df.select(*keys, ts).distinct().withColumn("next_ts", following)
    return out.withColumn("gap_hours", (F.unix_micros("next_ts") - F.unix_micros(ts)) / 3.6e9).where(F.col("gap_hours") > least_hours)


def market_gaps(df: DataFrame, keys: list[str], ts: str, is_open, least_open_hours: int = 1) -> DataFrame:
    """gaps with the number of open market hours strictly inside, for gaps with at least so many."""
    hours = F.sequence(F.date_trunc("hour", ts) + F.expr("interval 1 hour"), F.date_trunc("hour", "next_ts") - F.expr("interval 1 hour"), F.expr("interval 1 hour"))
    found = gaps(df, keys, ts, 1.0).withColumn("inside", F.when(F.col("gap_hours") >= 2, hours).otherwise(F.array().cast("array<timestamp>")))
    return found.withColumn("open_hours", F.size(F.filter("inside", is_open))).drop("inside").where(F.col("open_hours") >= least_open_hours)


DAY = 86_400_000_000
LARGE_GROUP = 5_000_000


def carried(df: DataFrame, keys: list[str], ts: str, values: dict[str, Column], *, backwards: bool = False, micros: int = DAY, order: tuple[Column, ...] = ()) -> DataFrame:
    """Every row with the last non-null of each value up to it in its key, however long ago (``backwards``: the next from it on).

    Time is cut into stretches of ``micros``: windows run inside a key's stretch, each stretch hands over one row with its
    last values, and only these rows are walked through for a whole key. So the history of one key is spread over many
    tasks. ``order`` settles rows at one instant; rows without an instant come before all others (``backwards``: after).
    """
    way = (lambda c: F.desc_nulls_last(c)) if backwards else (lambda c: F.asc_nulls_first(c))
    stretch = "__stretch"
    rows = df.withColumns({f"__c_{name}": value for name, value in values.items()} | {stretch: F.floor(F.unix_micros(ts) / micros)})
    inside = Window.partitionBy(*keys, stretch).orderBy(way(ts), *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(F.unix_micros(ts) * (-1 if backwards else 1), "__nth")
    numbered = rows.withColumn("__nth", F.row_number().over(inside)).withColumns({f"__i_{name}": F.last(f"__c_{name}", ignorenulls=True).over(upto) for name in values})
    ends = numbered.groupBy(*keys, stretch).agg(*[F.max_by(f"__i_{name}", place).alias(f"__e_{name}") for name in values])
    before = Window.partitionBy(*keys).orderBy(way(stretch)).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(stretch).alias("__s"), *[F.last(f"__e_{name}", ignorenulls=True).over(before).alias(f"__h_{name}") for name in values])
    met = [numbered[k].eqNullSafe(handed[f"__k{i}"]) for i, k in enumerate(keys)]
    out = numbered.join(handed, reduce(lambda x, y: x & y, met, numbered[stretch].eqNullSafe(handed["__s"])))
    return out.select(*df.columns, *[F.coalesce(f"__i_{name}", f"__h_{name}").alias(name) for name in values])


def interpolate(df: DataFrame, keys: list[str], ts: str, value: str, name: str = "filled", *, micros: int = DAY) -> DataFrame:
    """H1: nulls filled linearly by time between neighbours; leading nulls stay, trailing ones take the last value.

    Neighbours are carried over stretches of ``micros``, so a key may have any history; see ``carried``.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.unix_micros(ts).alias("t"), F.col(value).cast("double").alias("v")))
    out = carried(df, keys, ts, {"__b": known}, micros=micros, order=(F.col(value),))
    out = carried(out, keys, ts, {"__a": known}, backwards=True, micros=micros, order=(F.col(value),))
    line = F.col("__b.v") + (F.col("__a.v") - F.col("__b.v")) * (F.unix_micros(ts) - F.col("__b.t")) / F.nullif(F.col("__a.t") - F.col("__b.t"), F.lit(0))
    return out.withColumn(name, F.coalesce(F.col(value).cast("double"), line, F.when(F.col("__b").isNotNull(), F.col("__b.v")))).drop("__b", "__a")


def rolling_median(df: DataFrame, keys: list[str], ts: str, value: str, micros: int, name: str, *, closed: bool = False, seen: str | None = None) -> DataFrame:
    """Every row with the exact median of its key's values over the ``micros`` up to it, rows at its own instant included.

    The window is (t - micros, t], or [t - micros, t] if ``closed``; nulls do not count, and a window without values has a
    null median. ``seen`` names a column for how many values it held. Rows without an instant see each other only.

    A built-in percentile over a sliding frame sorts the whole frame anew for each row. Here time is cut into stretches of
    the window, each row also goes to the next stretch as a helper, and a task moves one ordered window over its sorted
    stretches: rows times the logarithm of the window. A long history of one key is spread over many tasks, many short
    ones share a batch, and a task holds one stretch of a key and one batch at most.
    """
    at, ids = F.unix_micros(ts), [f"__k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(i) for k, i in zip(keys, ids, strict=True)], at.alias("__t"), F.col(value).cast("double").alias("__v"), F.floor(at / micros).alias("__s"), F.struct(*df.columns).alias("__row"), F.lit(True).alias("__own"))
    helpers = rows.where("__v is not null and __t is not null").withColumns({"__s": F.col("__s") + 1, "__row": F.lit(None).cast(rows.schema["__row"].dataType), "__own": F.lit(False)})
    dealt = rows.unionByName(helpers).repartition(*ids, "__s").sortWithinPartitions(*ids, "__s", "__t")

    def rolled(table: pa.Table, change: np.ndarray) -> pa.RecordBatch:
        group = np.cumsum(change)
        inside = table["__t"].fill_null(0).to_numpy() - table["__s"].fill_null(0).to_numpy() * micros
        t = group * (4 * micros) + inside  # windows end inside their group
        v = pd.Series(table["__v"].to_numpy())
        first, last = np.searchsorted(t, t - micros, "left" if closed else "right"), np.searchsorted(t, t, "right")
        medians = v.rolling(_Spans(first, last), min_periods=1).median().to_numpy()
        upto = np.concatenate([[0], np.cumsum(v.notna())])
        own = table["__own"].to_numpy()
        columns = [table["__row"].filter(pa.array(own)), pa.array(medians[own], pa.float64(), from_pandas=True), pa.array((upto[last] - upto[first])[own], pa.int64())]
        return pa.table(columns, ["__row", "__median", "__seen"]).combine_chunks()

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            edge = pa.Table.from_batches(held[-2:])
            if not _changes(edge, [*ids, "__s"])[1:].any():
                continue  # still the same stretch
            table = pa.Table.from_batches(held)
            change = _changes(table, [*ids, "__s"])
            end = int(np.flatnonzero(change)[-1])
            yield from rolled(table.slice(0, end), change[:end]).to_batches()
            held = table.slice(end).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from rolled(table, _changes(table, [*ids, "__s"])).to_batches()

    schema = rows.select("__row", F.lit(0.0).alias("__median"), F.lit(0).cast("long").alias("__seen")).schema
    out = dealt.mapInArrow(moved, StructType([StructField(f.name, f.dataType) for f in schema]))
    return out.select("__row.*", F.col("__median").alias(name), *([F.col("__seen").alias(seen)] if seen else []))


def _changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Which rows differ from the one before in any of the columns; the first does."""
    changed = np.zeros(table.num_rows, bool)
    for name in columns:
        codes = table[name].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    changed[:1] = True
    return changed


class _Spans(pd.api.indexers.BaseIndexer):
    """Window bounds that were worked out before."""

    def __init__(self, first: np.ndarray, last: np.ndarray):
        super().__init__()
        self.first, self.last = first.astype(np.int64), last.astype(np.int64)

    def get_window_bounds(self, num_values: int = 0, min_periods: int | None = None, center: bool | None = None, closed: str | None = None, step: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        return self.first, self.last


def rolling_robust_outliers(df: DataFrame, keys: list[str], ts: str, value: str, *, days: int, n_mad: float, min_obs: int) -> DataFrame:
    """values far from their trailing median, in rolling median absolute deviations.

    The statistics use interpolated values over (t - days, t]; the flag uses the original value. The MAD is the rolling
    median of each row's distance to its own median. Groups with fewer than ``min_obs`` rows, nulls included, are skipped,
    and so are rows with fewer in their window.
    """
    enough = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_obs).drop("__n")
    span = days * DAY
    filled = interpolate(df.join(enough, keys, "left_semi"), keys, ts, value, micros=span)
    stats = rolling_median(filled, keys, ts, "filled", span, "rolling_median", seen="__seen")
    stats = stats.withColumn("__dev", F.abs(F.col("filled") - F.col("rolling_median")))
    stats = rolling_median(stats, keys, ts, "__dev", span, "rolling_mad")
    z = (F.col(value) - F.col("rolling_median")) / F.nullif(F.col("rolling_mad") * MAD_SCALE, F.lit(0.0))
    out = stats.withColumn("robust_z", F.when(F.col("__seen") >= min_obs, z))
    return out.where(F.abs("robust_z") > n_mad).drop("__seen", "__dev", "filled")


def group_quantile(df: DataFrame, keys: list[str], value: str, p: float, name: str, *, bins: int = 256) -> DataFrame:
    """Exact interpolated quantile of each key for groups of any size: ``keys, name, n``.

    The built-in ``percentile`` holds a group's distinct values in one task. Here two approximate quantiles, ``1 / bins`` below and above,
    cut each group into three stretches, counts tell the stretches that hold the two ranks needed, and only their values are ranked. Nulls do
    not count. The cuts differ between two runs of the same sketch, so they, the stretches and the result are written once and read
    back; their size is then known, and a join with few groups moves no rows.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    cuts = ", ".join(f"{min(max(cut, 0.0), 1.0)}D" for cut in (p - 1 / bins, p + 1 / bins))
    edges = _written(rows.groupBy(*keys).agg(F.expr(f"percentile_approx(__v, array({cuts}), {bins * 20})").alias("__e")), "edges")
    place = sum((F.col("__v") > F.get("__e", F.lit(k))).cast("int") for k in range(2))
    binned = rows.join(edges, keys).select(*keys, "__v", place.alias("__bin"))
    counts = binned.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(_w(keys, "__bin").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("__c").over(Window.partitionBy(*keys))
    placed = counts.withColumns({"__first": upto - F.col("__c"), "n": total}).withColumn("__at", (F.col("n") - 1) * p)
    needed = placed.where((F.col("__first") <= F.ceil("__at")) & (F.col("__first") + F.col("__c") > F.floor("__at"))).drop("__c")
    values = binned.join(_written(needed, "needed"), [*keys, "__bin"]).groupBy(*keys, "__bin", "__v", "__first", "n", "__at").agg(F.count(F.lit(1)).alias("__c"))
    end = F.col("__first") + F.sum("__c").over(_w([*keys, "__bin"], "__v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = values.withColumn("__end", end)
    at = lambda rank: F.max(F.when((rank >= F.col("__end") - F.col("__c")) & (rank < F.col("__end")), F.col("__v")))
    low, high = at(F.floor("__at")), at(F.ceil("__at"))
    share = F.first("__at") - F.floor(F.first("__at"))
    return _written(ranked.groupBy(*keys).agg(F.when(low == high, low).otherwise(low + (high - low) * share).alias(name), F.first("n").alias("n")), "quantiles")


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of the shared folder, made once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def robust_outliers(df: DataFrame, keys: list[str], ts: str, value: str, *, months: int = 3, n_mad: float = 6.0, min_obs: int = 100, scale: float = MAD_SCALE, anchor: Column | None = None, baseline: Column | None = None, run: Column | None = None, large_groups: bool | None = None) -> DataFrame:
    """Rows far from their group's median over the trailing months, in scaled median absolute deviations.

    The baseline ends at the last instant of the run window (or at ``anchor``) and is not narrowed by the window itself.
    Groups with fewer than ``min_obs`` baseline values or without spread have no outliers. ``baseline`` limits which rows
    count for it, ``run`` which rows are judged. With ``large_groups`` the medians come from ``group_quantile``, for
    groups whose values do not fit into one task; unless it is said, the largest group is counted first, and more than ``LARGE_GROUP``
    values are such a group. Both ways give the same medians.
    """
    judged = df if run is None else df.where(run)
    # one row, so the broadcast is bounded
    end = judged.agg(F.max(ts).alias("__end")) if anchor is None else df.sparkSession.range(1).select(anchor.alias("__end"))
    pool = df if baseline is None else df.where(baseline)
    pool = pool.crossJoin(F.broadcast(end)).where((F.col(ts) <= F.col("__end")) & (F.col(ts) >= F.add_months(F.col("__end").cast("date"), -months)) & F.col(value).isNotNull())
    if large_groups is None:
        largest = pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
        large_groups = (largest or 0) > LARGE_GROUP
    if large_groups:
        medians = group_quantile(pool, keys, value, 0.5, "med").withColumnRenamed("n", "n_obs").where(F.col("n_obs") >= min_obs)
        apart = pool.join(medians, keys).withColumn("__d", F.abs(F.col(value) - F.col("med")))
        mads = group_quantile(apart, keys, "__d", 0.5, "mad").select(*keys, "mad").where("mad > 0")
        return judged.join(medians.join(mads, keys), keys).withColumn("robust_z", (F.col(value) - F.col("med")) / (F.col("mad") * scale)).where(F.abs("robust_z") > n_mad)
    medians = pool.groupBy(*keys).agg(F.expr(f"percentile({value}, 0.5)").alias("med"), F.count(value).alias("n_obs")).where(F.col("n_obs") >= min_obs)
    spread = pool.join(medians, keys).groupBy(*keys).agg(F.expr(f"percentile(abs({value} - med), 0.5)").alias("mad"), F.first("med").alias("med"), F.first("n_obs").alias("n_obs")).where("mad > 0")
    return judged.join(spread, keys).withColumn("robust_z", (F.col(value) - F.col("med")) / (F.col("mad") * scale)).where(F.abs("robust_z") > n_mad)


def compress_steps(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """the first row of a series and every row whose value differs from the one before, with the rows that it stands for."""
    w = _w(keys, ts)
    first = F.row_number().over(w) == 1
    run = df.withColumn("__new", (first | ~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"))
    run = run.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    dwell = run.withColumn("dwell", F.count(F.lit(1)).over(Window.partitionBy(*keys, "__run")))
    return dwell.where("__new = 1").drop("__new", "__run")


def classify_moves(df: DataFrame, keys: list[str], ts: str, value: str, *, big: float = 0.10, mid: float = 0.05, small: float = 0.01) -> DataFrame:
    """F8: each row's move against the row before: NEW at the start, BIG, MID, SMALL or FLAT by its absolute size."""
    move = F.col(value) - F.lag(value).over(_w(keys, ts))
    size = F.abs("move")
    label = F.when(F.col("move").isNull(), "NEW").when(size >= big, "BIG").when(size >= mid, "MID").when(size >= small, "SMALL").otherwise("FLAT")
    return df.withColumn("move", move).withColumn("move_class", label)


def frozen_share(df: DataFrame, keys: list[str], ts: str, value: str, *, frozen: float) -> DataFrame:
    """for each key the sessions, the share of changes no larger than ``frozen`` and the mean absolute change."""
    change = df.withColumn("__c", F.abs(F.col(value) - F.lag(value).over(_w(keys, ts)))).where("__c is not null")
    return change.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"), (F.avg((F.col("__c") <= frozen).cast("double")) * 100).alias("pct_frozen"), F.avg("__c").alias("mean_abs_change"))


def completion_pass(df: DataFrame, keys: list[str], day: str, hour: str, rows: str, *, share: float = 0.9) -> DataFrame:
    """the first pass of each key and day at which the running rows reach a share of the day's total."""
    w = _w([*keys, day], hour).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(rows).over(Window.partitionBy(*keys, day))
    run = df.withColumns({"__cum": F.sum(rows).over(w), "__total": total})
    return run.where(F.col("__cum") >= F.col("__total") * share).groupBy(*keys, day).agg(F.min(hour).alias("completion_pass"), F.first("__total").alias("day_total"))


def arrival_verdict(df: DataFrame, keys: list[str], day: str, pass_col: str, *, min_days: int = 10, on_time: float = 0.9, max_late: int = 2) -> DataFrame:
    """the usual completion pass of each key (the mode, earlier on ties), its share of on-time days and a verdict."""
    counts = df.groupBy(*keys, pass_col).agg(F.count(F.lit(1)).alias("n"))
    usual = keep_one(counts, keys, F.desc("n"), F.col(pass_col)).select(*keys, F.col(pass_col).alias("usual_pass"))
    out = df.join(usual, keys).groupBy(*keys, "usual_pass").agg(F.count(F.lit(1)).alias("days"), F.sum((F.col(pass_col) > F.col("usual_pass")).cast("int")).alias("late_days"))
    share = 1 - F.col("late_days") / F.col("days")
    return out.withColumn("verdict", F.when(F.col("days") < min_days, "SPARSE").when((share >= on_time) & (F.col("late_days") <= max_late), "OK").when(share >= on_time, "INTERMITTENT").otherwise("LATE"))


def overnight_rate(df: DataFrame, keys: list[str], date: str, index: str, basis: int = 365) -> DataFrame:
    """the simple rate between neighbouring values of a compounded index, in percent a year."""
    w = _w(keys, date)
    gap = F.datediff(date, F.lag(date).over(w))
    return df.withColumn("overnight_rate", (F.col(index) / F.nullif(F.lag(index).over(w), F.lit(0)) - 1) * basis / F.nullif(gap, F.lit(0)) * 100).where("overnight_rate is not null")


def active_flags(df: DataFrame, issuer: str, instrument: str, date: str) -> DataFrame:
    """whether each instrument is on its own issuer's latest snapshot.

    Each instrument keeps its own latest date, in the task that holds its issuer.
    """
    rows = df.select(issuer, instrument, date)
    own = dealt_by(rows, [issuer], rows.count()).groupBy(issuer, instrument).agg(F.max(date).alias("__own"))
    last = F.max("__own").over(Window.partitionBy(issuer))
    return own.select(issuer, instrument, (F.col("__own") == last).alias("is_active"))


def modal_child(df: DataFrame, parent: list[str], child: str, price: str, *, question_date: str | None = None, target: Column | None = None) -> DataFrame:
    """F16: the child with the highest price, or nearest to a target date and then the highest price; ties to the smaller id."""
    order = [F.desc(price), F.col(child)]
    if question_date is not None:
        order = [F.abs(F.datediff(question_date, target)).asc_nulls_last(), *order]
    return keep_one(df, parent, *order)


def month_value(df: DataFrame, keys: list[str], reported: str, release: str, value: str) -> DataFrame:
    """one value for each month from competing prints: the latest reported date, then the latest release."""
    return df.withColumn("month", F.trunc(reported, "MM")).groupBy(*keys, "month").agg(F.max_by(value, F.struct(reported, release, value)).alias(value))


def curve_at(nodes: DataFrame, keys: list[str], tenor: str, value: str, targets: list[float]) -> DataFrame:
    """H2: a curve at fixed horizons: flat before the first node, linear between nodes, null beyond the last, four places. All horizons take one aggregation."""
    point = F.struct(F.col(tenor).alias("t"), F.col(value).alias("v"))
    sides = nodes.groupBy(*keys).agg(*[side for k, t in enumerate(targets) for side in (F.max(F.when(F.col(tenor) <= t, point)).alias(f"b{k}"), F.min(F.when(F.col(tenor) >= t, point)).alias(f"a{k}"))])

    def at(k: int, t: float) -> Column:
        b, a = F.col(f"b{k}"), F.col(f"a{k}")
        line = b["v"] + (a["v"] - b["v"]) * (t - b["t"]) / F.nullif(a["t"] - b["t"], F.lit(0.0))
        return F.when(a.isNull(), None).when(b.isNull(), a["v"]).when(a["t"] == b["t"], a["v"]).otherwise(line)

    levels = F.array(*[F.struct(F.lit(float(t)).alias("horizon"), F.round(at(k, t), 4).alias("level")) for k, t in enumerate(targets)])
    return sides.select(*keys, F.explode(levels).alias("p")).select(*keys, "p.horizon", "p.level")


def compare_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """H4: every key with "matched", "left_only" or "right_only"."""
    l, r = left.select(key).distinct().withColumn("__l", F.lit(1)), right.select(key).distinct().withColumn("__r", F.lit(1))  # noqa: E741
    status = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("matched")
    return l.join(r, key, "full").select(key, status.alias("status"))


def disagreements(df: DataFrame, key: list[str], voter: str) -> DataFrame:
    """H6: keys that some but not all voters name, with who did and who did not."""
    everyone = df.agg(F.sort_array(F.collect_set(voter)).alias("everyone"))  # voters are a small dimension
    said = df.groupBy(*key).agg(F.sort_array(F.collect_set(voter)).alias("said"))
    return said.crossJoin(F.broadcast(everyone)).withColumn("silent", F.array_except("everyone", "said")).where(F.size("silent") > 0).drop("everyone")


def watchlist_diff(current: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """H8: the union of both lists with "kept", "added" or "removed"."""
    return compare_sets(current, active, key).select(key, F.when(F.col("status") == "matched", "kept").when(F.col("status") == "right_only", "added").otherwise("removed").alias("state"))


def split_releases(df: DataFrame, key: list[str], date: str) -> DataFrame:
    """H9: keys with more than one stored date."""
    return df.groupBy(*key).agg(F.countDistinct(date).alias("n_dates"), F.min(date).alias("first_date"), F.max(date).alias("last_date")).where("n_dates > 1")


def wide_to_long(df: DataFrame, ids: list[str], values: list[str], name: str = "series", value: str = "value") -> DataFrame:
    """One row for each measure, nulls dropped."""
    return df.unpivot(ids, values, name, value).where(F.col(value).isNotNull())


def long_to_wide(df: DataFrame, ids: list[str], name: str, value: str, columns: list[str]) -> DataFrame:
    """A column for each listed name, null where it is missing; of repeated cells the largest."""
    return df.groupBy(*ids).pivot(name, columns).agg(F.max(value))


def date_spine(spark, start: str, end: str, weekend: str = "5,6") -> DataFrame:
    """Every date with its weekday (Monday 0) and whether it is in a "5,6" list of weekend days."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return days.withColumns({"weekday": F.weekday("d"), "is_weekend": F.array_contains(F.split(F.lit(weekend), ","), F.weekday("d").cast("string"))})
