"""Table changes without a transactional format: keyed upsert, vintages, surrogate keys, cleaning."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


@dataclass(frozen=True)
class MergeSpec:
    """Keys and how columns behave: ``null_safe`` keys match null to null, ``insert_only`` columns are never updated."""

    keys: list[str]
    values: list[str]
    null_safe: list[str] = field(default_factory=list)
    insert_only: list[str] = field(default_factory=list)
    updated_at: str | None = None
    created_at: str | None = None


def merge_upsert(target: DataFrame, source: DataFrame, spec: MergeSpec, now: Column | None = None) -> DataFrame:
    """The whole target after the merge, with ``_action`` (kept, updated, inserted).

    Matched rows take the source's values, but null never overwrites a value; unmatched source rows are inserted; a key
    part that is null matches nothing unless it is null-safe. A source with two rows for one key fails the job (J2).
    """
    now = F.current_timestamp() if now is None else now
    repeated = F.count(F.lit(1)).over(Window.partitionBy(*spec.keys))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.keys if k not in spec.null_safe], F.lit(True))
    source = source.withColumn("__n", repeated).where(F.when((F.col("__n") > 1) & whole, F.raise_error(F.lit("duplicate source key"))).otherwise(F.lit(True)).cast("boolean"))
    columns = [*spec.values, *spec.insert_only]
    s = source.select(*[F.col(k).alias(f"__{k}") for k in spec.keys], *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__source"))
    t = target.withColumn("__target", F.lit(True))
    match = reduce(lambda a, b: a & b, [t[k].eqNullSafe(s[f"__{k}"]) if k in spec.null_safe else t[k] == s[f"__{k}"] for k in spec.keys])
    both = t.join(s, match, "full")
    fresh = F.col("__target").isNull()
    changed = ~fresh & F.col("__source").isNotNull() & reduce(lambda a, b: a | b, [F.col(f"__{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in spec.values], F.lit(False))
    out = {k: F.when(fresh, F.col(f"__{k}")).otherwise(F.col(k)) for k in spec.keys}
    out |= {c: F.when(fresh, F.col(f"__{c}")).otherwise(F.coalesce(f"__{c}", c)) for c in spec.values}
    out |= {c: F.when(fresh, F.col(f"__{c}")).otherwise(F.col(c)) for c in spec.insert_only}
    if spec.updated_at:
        out[spec.updated_at] = F.when(changed | fresh, now).otherwise(F.col(spec.updated_at))
    if spec.created_at:
        out[spec.created_at] = F.when(fresh, now).otherwise(F.col(spec.created_at))
    action = F.when(fresh, "inserted").when(changed, "updated").otherwise("kept")
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in target.columns], action.alias("_action"))


def vintage_load(existing: DataFrame, incoming: DataFrame, keys: list[str], value: str, release: str, vintage: str = "vintage") -> DataFrame:
    """The incoming rows as vintages to append, with ``_action`` (new, revision, skip).

    Of several incoming rows of one key the latest release counts, non-null values first, then the larger value. A key
    without a stored vintage starts at 0; a changed value becomes the next vintage; an equal or null value is skipped.
    Compare decimals, not doubles: cast ``value`` before.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(release), F.col(value).isNull(), F.desc(value))
    batch = incoming.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", vintage)
    stored = existing.join(batch.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max(F.struct(vintage, value)).alias("__now"))
    joined = batch.join(stored, keys, "left")
    action = F.when(F.col("__now").isNull() & F.col(value).isNotNull(), "new").when(F.col(value).isNull() | F.col(value).eqNullSafe(F.col(f"__now.{value}")), "skip").otherwise("revision")
    return joined.withColumn("_action", action).withColumn(vintage, F.when(F.col("_action") == "new", 0).when(F.col("_action") == "revision", F.col(f"__now.{vintage}") + 1)).drop("__now")


def action_counts(df: DataFrame) -> DataFrame:
    """Rows by action."""
    return df.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n"))


def seed_dimension(existing: DataFrame, incoming: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Ids of all keys: stored ones keep theirs, new ones get the next numbers in key order.

    New keys are sorted by range, numbered inside each partition and moved up by the rows of the partitions before, so
    only one row for each partition meets in a single task. The order is written down first, as an exchange may deal it
    otherwise when it is run again.
    """
    spark = incoming.sparkSession
    fresh = incoming.select(key).where(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.monotonically_increasing_id()
    path = scratch_path(spark, "keys")
    fresh.repartitionByRange(parts, key).sortWithinPartitions(key).withColumns({"__part": F.shiftright(at, 33), "__nth": at.bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))  # a row for each partition
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__top"))
    numbered = placed.join(F.broadcast(starts), "__part").crossJoin(F.broadcast(top))
    numbered = numbered.select(key, (F.col("__top") + F.col("__before") + F.col("__nth") + 1).cast("long").alias(id_col), F.lit(True).alias("is_new"))
    return existing.select(key, F.col(id_col).cast("long").alias(id_col), F.lit(False).alias("is_new")).unionByName(numbered)


def assign_codes(existing: DataFrame, incoming: DataFrame, key: str, base: str, code: str = "code") -> DataFrame:
    """Stored codes stay; a new key takes its base code, or the base with .2, .3 and so on where it is taken."""
    used = existing.groupBy(F.regexp_replace(code, r"\.\d+$", "").alias(base)).agg(F.max(F.coalesce(F.regexp_extract(code, r"\.(\d+)$", 1).try_cast("int"), F.lit(1))).alias("__used"))
    fresh = incoming.select(key, base).distinct().join(existing.select(key), key, "left_anti").join(used, base, "left")
    n = F.coalesce("__used", F.lit(0)) + F.row_number().over(Window.partitionBy(base).orderBy(key))
    minted = fresh.withColumn("__k", n).select(key, F.when(F.col("__k") == 1, F.col(base)).otherwise(F.concat_ws(".", base, F.col("__k").cast("string"))).alias(code))
    return existing.select(key, code).unionByName(minted)


def without_range(df: DataFrame, date: str, start: Column, end: Column) -> DataFrame:
    """The table without the rows of a range, to be written again."""
    return df.where(~F.col(date).between(start, end) | F.col(date).isNull())


@dataclass(frozen=True)
class CleaningRule:
    """A named rule: ``detect(snapshot)`` gives the flagged rows (with their id); ``action`` is null, swap or delete."""

    name: str
    action: str
    detect: object


def clean(df: DataFrame, id_col: str, rules: list[CleaningRule], null_columns: list[str], swap: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned table, action log). All rules look at the same snapshot; then every row takes its strongest action.

    "delete" beats "null" beats "swap". The log has a row for each rule and flagged row.
    """
    logs = [r.detect(df).select(F.col(id_col).alias("row_id"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action")) for r in rules]
    log = reduce(lambda a, b: a.unionByName(b), logs).distinct()
    strength = F.max(F.when(F.col("action") == "delete", 3).when(F.col("action") == "null", 2).otherwise(1)).alias("__do")
    flagged = df.join(log.groupBy(F.col("row_id").alias(id_col)).agg(strength), id_col, "left").where(F.coalesce("__do", F.lit(0)) < 3)
    do = F.coalesce("__do", F.lit(0))
    changes = {c: F.when(do != 2, F.col(c)) for c in null_columns}
    if swap:
        a, b = swap
        base_a, base_b = changes.get(a, F.col(a)), changes.get(b, F.col(b))
        changes |= {a: F.when(do == 1, F.col(b)).otherwise(base_a), b: F.when(do == 1, F.col(a)).otherwise(base_b)}
    return flagged.select(*[changes.get(c, F.col(c)).alias(c) for c in df.columns]), log


def tiered_change(df: DataFrame, keys: list[str], ts: str, value: str, tiers: list[tuple[DataFrame, list[str], str]], fallback: float, least_prev: float = 0.0) -> DataFrame:
    """Changes over the first threshold that applies. Each tier is (thresholds, key columns, "abs" or "pct").

    A tier's table has its keys and ``threshold`` and is small. Values whose predecessor is below ``least_prev`` have no
    percentage; the fallback is a percentage.
    """
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(ts))
    out = df.withColumn("prev_value", before)
    change = F.abs(F.col(value) - F.col("prev_value"))
    pct = F.when(F.abs("prev_value") > least_prev, change / F.abs("prev_value") * 100)
    over, known = F.lit(None).cast("boolean"), []
    for n, (table, on, kind) in enumerate(tiers):
        out = out.join(table.withColumnRenamed("threshold", f"__t{n}"), on, "left")
        known.append(F.when(F.col(f"__t{n}").isNotNull(), (change if kind == "abs" else pct) > F.col(f"__t{n}")))
    over = F.coalesce(*known, pct > fallback)
    return out.where(over).drop(*[f"__t{n}" for n in range(len(tiers))])


def cascade_delete(children: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent is not deleted."""
    return children.join(gone.select(key).distinct(), key, "left_anti")


def still_empty(cache: DataFrame, today: Column, days: dict[str, int], protected: list[str]) -> DataFrame:
    """Known-empty combinations that need no new request: checked lately enough for their status, not protected."""
    limit = F.create_map(*[F.lit(x) for pair in days.items() for x in pair])[F.col("status")]
    return cache.where(~F.col("quote").isin(*protected) & (F.datediff(today, "last_checked") < F.coalesce(limit, F.lit(0))))


def quota_used(log: DataFrame, ts: str, amount: str, limit: int, keys: list[str]) -> DataFrame:
    """The usage of the 24 hours up to each row and what remains.

    A built-in sum over a sliding frame adds the whole frame anew for each row. Here time is cut into days: a row's usage is the running sum
    of its own day and that of the day before from 24 hours back on, whose rows stand in the next day too, 24 hours later. So the
    work grows with the rows, nothing is subtracted, and one key's history is spread over many tasks.
    """
    day, at = 86_400_000_000, F.unix_micros(ts)
    row = log.select(F.struct(*log.columns)).schema[0].dataType
    own = log.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], at.alias("__at"), F.floor(at / day).alias("__s"), F.col(amount).alias("__own"), F.lit(None).cast(log.schema[amount].dataType).alias("__before"), F.struct(*log.columns).alias("__row"))
    before = own.where("__at is not null").withColumns({"__at": F.col("__at") + day, "__s": F.col("__s") + 1, "__before": F.col("__own"), "__own": F.col("__before"), "__row": F.lit(None).cast(row)})
    stretch = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))], "__s")
    upto = stretch.orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    later = stretch.orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, -1)
    sums = own.unionByName(before).withColumns({"__x": F.sum("__own").over(upto), "__y": F.sum("__before").over(later)}).where("__row is not null")
    used = F.coalesce(F.col("__x") + F.col("__y"), "__x", "__y")
    return sums.select("__row.*", used.alias("used_24h")).withColumn("remaining", F.lit(limit) - F.col("used_24h"))


def forecast_rows(df: DataFrame, snapshot: Column) -> DataFrame:
    """RELATIVE horizons keep the vendor's date as ``as_of``; ABSOLUTE ones take the snapshot date and a target date."""
    relative = F.col("horizon_type") == "RELATIVE"
    return df.withColumns({"as_of": F.when(relative, F.col("ts").cast("date")).otherwise(snapshot), "target_date": F.when(~relative, F.col("ts").cast("date"))})


def unseen(items: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Items whose key was not seen before, one for each key."""
    return items.join(seen.select(key), key, "left_anti").dropDuplicates([key])


def upsert_events(stored: DataFrame, incoming: DataFrame, keys: list[str], now: Column, order: list[Column], *, ticker: str = "ticker", name: str = "name", date: str = "event_date", stamp: str | None = None, values: tuple[str, ...] = ("survey", "actual"), released: tuple[str, ...] = ("actual",)) -> tuple[DataFrame, DataFrame]:
    """(the event table after the upsert with ``_action``, the changes of actuals as ``old_actual, new_actual``).

    An event is known by ``keys`` and its ticker or, without one, its name; the two never match each other. Of several
    incoming rows of one event the first in ``order`` counts. What is not out by ``now`` brings no ``released`` values, and
    null never overwrites. A change is an actual that came, or came out otherwise than stored.
    """
    keyed = lambda df: df.withColumns({"__kind": F.when(F.col(ticker).isNotNull(), "ticker").otherwise("name"), "__event": F.coalesce(ticker, name)})
    own = [*keys, "__kind", "__event"]
    ahead = F.coalesce(F.col(stamp) > now, F.lit(False)) if stamp else F.col(date) >= now.cast("date")
    batch = keyed(incoming).withColumn("__n", F.row_number().over(Window.partitionBy(*own).orderBy(*order))).where("__n = 1").drop("__n")
    batch = batch.withColumns({c: F.when(~ahead, F.col(c)) for c in released})
    first = [c for c in stored.columns if c not in (*keys, *values)]
    spec = MergeSpec(own, list(values), insert_only=first)
    merged = merge_upsert(keyed(stored).withColumn("old_actual", F.col("actual")), batch, spec, now)
    changed = F.col("_action").isin("inserted", "updated") & F.col("actual").isNotNull() & ~F.col("actual").eqNullSafe(F.col("old_actual"))
    changes = merged.where(changed).select(*keys, ticker, name, "old_actual", F.col("actual").alias("new_actual"))
    return merged.select(*stored.columns, "_action"), changes


def hash_ids(existing: DataFrame, incoming: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Ids of all keys without a race: a new key's id is a number made from its SHA-256, so two writers give it the same.

    Stored ids stay; nothing is numbered in order, so nothing waits for anything.
    """
    number = F.conv(F.substring(F.sha2(F.col(key), 256), 1, 15), 16, 10).cast("long")
    fresh = incoming.select(key).where(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti")
    return existing.select(key, F.col(id_col).cast("long").alias(id_col), F.lit(False).alias("is_new")).unionByName(fresh.select(key, number.alias(id_col), F.lit(True).alias("is_new")))
