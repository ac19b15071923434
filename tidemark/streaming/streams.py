"""Streaming twins: bars that late ticks correct, replay-safe appends, baselines, silent feeds. State by key is in ``stateful``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.prediction import clamp_backfill
from tidemark.sources.scans import exploded_markets


def stream_bars(ticks: DataFrame, keys: list[str], ts: str, price: str, *, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """M2: tumbling bars with a watermark; a tick later than that is dropped."""
    by = F.struct(F.col(ts), F.col(price))
    bars = ticks.where(F.col(price).isNotNull()).withWatermark(ts, late).groupBy(*keys, F.window(ts, width))
    out = bars.agg(F.min(by)[price].alias("open_px"), F.max(price).alias("high_px"), F.min(price).alias("low_px"), F.max(by)[price].alias("close_px"), F.avg(price).alias("mean_px"), F.count(F.lit(1)).alias("n_ticks"))
    return out.select(*keys, F.col("window.start").alias("bar_ts"), *[c for c in out.columns if c not in (*keys, "window")])


def stream_once(df: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """M6: each key once within the watermark, so that a replay appends nothing."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def stream_baseline(df: DataFrame, keys: list[str], ts: str, volume: str, *, width: str = "7 days", slide: str = "1 day", late: str = "1 hour") -> DataFrame:
    """M9: mean positive volume over sliding windows."""
    windows = df.where(F.col(volume) > 0).withWatermark(ts, late).groupBy(*keys, F.window(ts, width, slide))
    return windows.agg(F.avg(volume).alias("baseline"), F.count(F.lit(1)).alias("n")).select(*keys, F.col("window.end").alias("window_end"), "baseline", "n")


def feed_sessions(df: DataFrame, keys: list[str], ts: str, *, gap: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Stretches of a feed without a silence of ``gap``: start, end and rows (works on batches and streams)."""
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    sessions = rows.groupBy(*keys, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"))
    return sessions.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def upsert_sink(table_path: str, keys: list[str], partition_by: list[str], order: list[str] | None = None):
    """M8: a ``foreachBatch`` function that upserts each micro-batch into a partitioned archive; a replay changes nothing.

    The last arrival of a key wins: a later micro-batch over an earlier one, inside one the row of the largest ``order`` columns.
    """
    from tidemark.sources.scans import write_partitioned

    def write(batch: DataFrame, _: int) -> None:
        write_partitioned(batch, table_path, partition_by, keys, [*keys, *partition_by], order)

    return write


#: What a bar needs of its ticks, in a form that merges.
_PARTIAL = {"opened": F.min, "closed": F.max, "high_px": F.max, "low_px": F.min, "total": F.sum, "n_ticks": F.sum, "n_late": F.sum}


def bars_sink(path: str, keys: list[str], ts: str, price: str, *, width: str = "1 hour", late_minutes: int = 10):
    """M2, M8: a ``foreachBatch`` function that keeps bars that late ticks can still correct.

    Each micro-batch leaves its ticks' part of every bar under ``path/bars`` (``merged_bars`` puts the parts together), so a late
    tick corrects its bar without reading the bar's hour again. Ticks older than the newest tick of the batches before by more
    than ``late_minutes``, which a watermark would refuse, are kept one by one under ``path/late``. Every folder is named by the batch
    and written anew when it is replayed, so a replay changes nothing. Ticks without a price or an instant do not count.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ticks = batch.where(F.col(price).isNotNull() & F.col(ts).isNotNull())
        marks = spark.read.schema("newest timestamp, batch long").parquet(f"{path}/marks") if number else spark.createDataFrame([], "newest timestamp, batch long")
        newest = marks.where(F.col("batch") < number).agg(F.max("newest").alias("m")).first()["m"]  # a row for each batch
        is_late = F.lit(False) if newest is None else F.col(ts) < F.lit(newest) - F.expr(f"interval {int(late_minutes)} minutes")
        point = F.struct(F.col(ts).alias("at"), F.col(price).cast("double").alias("px"))
        known = ticks.withColumn("__late", is_late)
        bars = known.groupBy(*keys, F.window(ts, width).alias("w")).agg(F.min(point).alias("opened"), F.max(point).alias("closed"), F.max(price).cast("double").alias("high_px"), F.min(price).cast("double").alias("low_px"), F.sum(F.col(price).cast("double")).alias("total"), F.count(F.lit(1)).alias("n_ticks"), F.count_if("__late").alias("n_late"))
        bars.select(*keys, F.col("w.start").alias("bar_ts"), *_PARTIAL).write.mode("overwrite").parquet(f"{path}/bars/batch={number}")
        known.where("__late").drop("__late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        ticks.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return write


def merged_bars(parts: DataFrame, keys: list[str]) -> DataFrame:
    """M8: the bars of ``bars_sink`` as they stand now: open, high, low, close, mean, ticks and how many of these came late."""
    by = [*keys, "bar_ts"]
    one = parts.groupBy(*by).agg(*[f(name).alias(name) for name, f in _PARTIAL.items()])
    return one.select(*by, F.col("opened.px").alias("open_px"), "high_px", "low_px", F.col("closed.px").alias("close_px"), (F.col("total") / F.col("n_ticks")).alias("mean_px"), "n_ticks", "n_late")


def compact_bars(spark: SparkSession, path: str, keys: list[str], upto: int) -> None:
    """M8: fold the parts of the batches up to ``upto`` into that one's folder, for streams that have run long.

    The folded parts are written beside the table first. Run it while the stream is stopped; batches up to ``upto`` cannot be replayed after it.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bars")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = spark.read.parquet(f"{path}/bars").where(F.col("batch") <= upto)
    by = [*keys, "bar_ts"]
    folded = f"{path}/folded-{upto}"
    parts.groupBy(*by).agg(*[f(name).alias(name) for name, f in _PARTIAL.items()]).write.mode("overwrite").parquet(folded)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch=") and int(name[6:]) <= upto:
            fs.delete(status.getPath(), True)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(folded), spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bars/batch={upto}"))


def poll_events(df: DataFrame, keys: list[str], markets: str, prices: str, out: str, log: str):
    """M1: a ``foreachBatch`` function for polls of nested events: one observation for each open market is appended to
    ``out``, and one row for the poll to ``log`` with its markets, the closed ones and the events that have no open one left.

    Both folders are partitioned by the batch number and a batch replaces its own, so a replay adds nothing. ``df`` only
    lends its schema: a market's struct has ``closed`` and the JSON list of prices.
    """
    fields = [f.name for f in df.schema[markets].dataType.elementType if f.name not in (prices, "closed")]

    def write(batch: DataFrame, number: int) -> None:
        rows = exploded_markets(batch, keys, markets, prices)
        is_open = ~F.coalesce("closed", F.lit(False))
        rows.where(is_open).select(*keys, *fields, "yes", "no").write.mode("overwrite").parquet(f"{out}/batch={number}")
        alive = rows.groupBy(*keys).agg(F.max(is_open.cast("int")).alias("alive"), F.count(F.lit(1)).alias("n"), F.sum((~is_open).cast("int")).alias("closed"))
        counts = alive.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_markets"), F.coalesce(F.sum("closed"), F.lit(0)).alias("n_closed"), F.coalesce(F.sum(1 - F.col("alive")), F.lit(0)).alias("n_dead_events"))
        counts.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return write


def backfill_sink(path: str, live: DataFrame, keys: list[str], ts: str, start, end):
    """M7: a ``foreachBatch`` function that appends late points: inside a window, strictly before the newest live instant, and
    not stored yet. A batch replaces its own folder, so a replay adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        clamp_backfill(batch.dropDuplicates([*keys, ts]), live, keys, ts, start, end).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def drain(stream: DataFrame, spark_path: str, *, mode: str = "append", batch=None) -> DataFrame | None:
    """Run a stream over what is there now to its end, into Parquet files under ``spark_path`` (read back) or a batch function."""
    writer = stream.writeStream.option("checkpointLocation", f"{spark_path}/checkpoint").trigger(availableNow=True).outputMode(mode)
    run = writer.foreachBatch(batch).start() if batch else writer.format("parquet").start(f"{spark_path}/rows")
    run.awaitTermination()
    return None if batch else stream.sparkSession.read.schema(stream.schema).parquet(f"{spark_path}/rows")
