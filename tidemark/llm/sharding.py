"""Two-pass external shuffle into balanced shards.

Pass one scatters records uniformly into buckets that fit in memory, by a seeded hash. Pass two puts each bucket
into a fixed order, applies a Fisher-Yates shuffle seeded by (seed, bucket) and writes it. Concatenating the buckets
gives one uniformly random order of the whole corpus; dealing that order round-robin over the shards makes row
counts differ by at most one (law ``rows``).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.durable import durable

BUCKET_BYTES = 64 << 20
BUCKET_ROWS = 400_000


def bucket_count(df: DataFrame, text_col: str, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets needed so that each holds about ``bucket_bytes`` of text and ``bucket_rows`` rows at most."""
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col).cast("long")).alias("b")).first()
    return max(1, -(-(got["b"] or 0) // bucket_bytes), -(-got["n"] // bucket_rows))


def external_shuffle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = 20, buckets: int | None = None) -> DataFrame:
    """All records as ``id, text, bucket, position``: position is the place in the bucket after its shuffle.

    The scatter hashes the id with the record's number in the scan, so equal ids or repeated rows spread over all
    buckets like any others. Nulls stay nulls. Other columns of ``df`` are not carried. An empty table gives no rows.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n = buckets or bucket_count(rows, "text")
    scattered = rows.withColumn("place", F.xxhash64(F.lit(seed), F.col("id"), F.monotonically_increasing_id()))
    scattered = scattered.withColumn("bucket", F.pmod("place", F.lit(n)).cast("int"))

    def shuffled(table: pa.Table) -> pa.Table:
        # a fixed order first: the result must not depend on the order in which shuffle blocks arrive
        table = table.sort_by([("place", "ascending"), ("id", "ascending")])
        bucket = table["bucket"][0].as_py()
        order = np.random.Generator(np.random.PCG64([seed, bucket])).permutation(table.num_rows)  # Fisher-Yates
        table = table.take(pa.array(order))
        position = pa.array(np.arange(table.num_rows, dtype=np.int64))
        return table.drop_columns(["place"]).append_column("position", position)

    schema = f"id {dict(rows.dtypes)['id']}, text string, bucket int, position long"
    # as many partitions as buckets: with the session's number one task would read many of them on a large corpus
    return scattered.repartition(n, "bucket").groupBy("bucket").applyInArrow(shuffled, schema)


def digest(df: DataFrame) -> DataFrame:
    """``id, size, text_crc32, bucket, position`` of shuffled records: UTF-8 bytes plus one, and the text's CRC-32."""
    text = F.coalesce("text", F.lit(""))
    return df.select("id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), "bucket", "position")


def deal(shuffled: DataFrame, shards: int = 8) -> DataFrame:
    """Add ``shard`` and ``slot`` to a durable shuffled table: record g of the whole order goes to shard g mod shards.

    Bucket sizes are summed first, so only one row for each bucket meets in the window that adds them up.
    """
    sizes = shuffled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("start"))
    at = F.col("start") + F.col("position")
    placed = shuffled.join(starts, "bucket")
    return placed.withColumns({"shard": F.pmod(at, F.lit(shards)).cast("int"), "slot": F.floor(at / shards).cast("long")}).drop("start")


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8, seed: int = 20) -> DataFrame:
    """One row per record: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` under the law ``rows``.

    A null text has size 1 and the CRC-32 of no bytes; a null id stays null and is dealt like any other record.
    """
    dealt = deal(durable(digest(external_shuffle(df, id_col, text_col, seed=seed))), shards)
    return dealt.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8, seed: int = 20) -> None:
    """Write the shuffled records under ``path``, partitioned by shard, each file in slot order."""
    dealt = deal(durable(external_shuffle(df, id_col, text_col, seed=seed)), shards)
    dealt.repartition("shard", F.floor(F.col("slot") / BUCKET_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def crc32(text: str | None) -> int:
    """What ``text_crc32`` holds, for tests."""
    return zlib.crc32((text or "").encode())
