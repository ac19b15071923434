"""Importance resampling towards a target's distribution of hashed word and word-pair features.

A feature's bucket is the CRC-32 of its bytes modulo the number of buckets. The distinct features of a slice of texts are
grouped by length into two-dimensional byte matrices; all CRCs of a matrix advance together, a column at a time, and are
scattered back to the features' places. Each document keeps its buckets in a table; corpus and target are counted from
such tables, a bucket's gain is the logarithm of its share in the target over that in the corpus, a document's weight is
the mean gain, and seeded Gumbel noise makes the highest scores a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.durable import durable
from tidemark.llm.slices import slices

BUCKETS = 10_000
MATRIX_CELLS = 1 << 20
SPACE = 0x20
#: A-Z become lower case; of ASCII only digits and letters are in words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else SPACE for b in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (letters A-Z only) in UTF-8; none of a null text."""
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


def matrix_crcs(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a byte matrix, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return ~crc


def joined_crcs(pool: np.ndarray, firsts: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """CRC-32 of features that are one or two slices of ``pool``, two joined by a space; grouped by length.

    ``firsts`` and ``sizes`` hold where each part starts in the pool and how long it is.
    """
    length = sizes[0] + sizes[1] + 1 if len(sizes) == 2 else sizes[0]
    out = np.zeros(len(length), np.uint32)
    order = np.argsort(length, kind="stable")
    ends = np.flatnonzero(np.diff(length[order], append=-1)) + 1
    for low, high in zip([0, *ends[:-1].tolist()], ends.tolist()):
        width = int(length[order[low]])
        step = max(1, MATRIX_CELLS // max(1, width))
        column = np.arange(width)
        for at in range(low, high, step):
            rows = order[at : min(high, at + step)]
            cells = firsts[0][rows][:, None] + column
            if len(sizes) == 2:
                head = sizes[0][rows][:, None]
                matrix = np.where(column == head, SPACE, pool[np.where(column < head, cells, np.maximum(firsts[1][rows][:, None] + column - head - 1, 0))])
            else:
                matrix = pool[cells]
            out[rows] = matrix_crcs(matrix.astype(np.uint8))
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def text_buckets(texts: list[str | None], buckets: int = BUCKETS) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words of each text, then the buckets of all words of all texts and of all pairs of neighbouring words of all texts."""
    split = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    known = _Numbers()
    number = known.__getitem__
    words = np.fromiter((number(w) for text in split for w in text), np.int64, int(sizes.sum()))
    lengths = np.fromiter(map(len, known), np.int64, len(known))
    pool = np.frombuffer(b"".join(known), np.uint8)
    firsts = np.cumsum(lengths) - lengths
    singles = (joined_crcs(pool, [firsts], [lengths]) % np.uint32(buckets)).astype(np.int64)[words]
    same = np.ones(max(0, len(words) - 1), bool)
    starts = np.cumsum(sizes)[:-1]
    same[starts[(starts > 0) & (starts < len(words))] - 1] = False  # the last word of a text has no neighbour in the next
    left, right = words[:-1][same], words[1:][same]
    pairs, place = np.unique(left * max(1, len(known)) + right, return_inverse=True)
    a, b = np.divmod(pairs, max(1, len(known)))
    doubles = (joined_crcs(pool, [firsts[a], firsts[b]], [lengths[a], lengths[b]]) % np.uint32(buckets)).astype(np.int64)[place]
    return sizes.tolist(), singles, doubles


def featured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, buckets``: the bucket of every feature of every whole text, repeats kept, words first.

    Null and empty texts have none. Repeated rows are kept; other columns are not carried; no row is moved.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, singles, doubles = text_buckets(batch["text"].to_pylist(), buckets)
            n = np.array(sizes, np.int64)
            paired = np.maximum(n - 1, 0)
            ends = np.cumsum(n + paired)
            flat = np.empty(len(singles) + len(doubles), np.int16 if buckets <= 1 << 15 else np.int32)
            first = np.repeat(ends - n - paired, n) + np.arange(len(singles)) - np.repeat(np.cumsum(n) - n, n)
            flat[first] = singles
            second = np.ones(len(flat), bool)
            second[first] = False
            flat[second] = doubles
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n), lists], ["doc_id", "n_words", "buckets"])

    kind = "smallint" if buckets <= 1 << 15 else "int"
    return rows.mapInArrow(found, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, buckets array<{kind}>")


def bucket_counts(features: DataFrame) -> DataFrame:
    """``bucket, n`` over all rows; counted in each task before the shuffle, so it moves at most a row for each bucket and task."""
    return features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Every bucket's gain in thousandths of a natural logarithm, one added to each count; as many values as buckets."""
    counted = []
    for features in (corpus, target):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(features).collect():  # a row for each bucket at most
            n[row["bucket"]] = row["n"]
        counted.append(n.tolist())
    s, t = counted
    whole_s, whole_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((y + 1) * whole_s / ((x + 1) * whole_t))) for x, y in zip(s, t, strict=True)], np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of a document's features, 0 without any."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["buckets"]
            offsets = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[lists.values.to_numpy()[offsets[0] : offsets[-1]]])])[offsets - offsets[0]]
            n = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_words"], pa.array(n), pa.array(np.diff(sums) // np.maximum(n, 1))], ["doc_id", "n_words", "n_features", "weight"])

    kinds = dict(features.dtypes)
    return features.mapInArrow(mean, f"doc_id {kinds['doc_id']}, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int = 7) -> DataFrame:
    """Adds ``score``: the weight and Gumbel noise in thousandths from the hash of seed and id (a null id counts as empty)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + noise.cast("long"))


def ranked(scores: DataFrame, percent: int = 25, least_words: int = 20) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: ranks of the drawn documents, null for all others.

    Drawn are ``floor(percent * N / 100)`` of the N documents with ``least_words`` words or more, highest scores first, ties
    to the smaller id (null ids first, repeated rows in any order). The rows are dealt by ranges of that order, numbered
    in their range and moved up by the sizes of the ranges before; a last column spreads the rows of a frequent id.
    """
    spark = scores.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.monotonically_increasing_id()
    order = [F.desc("able"), F.desc("score"), F.asc("doc_id"), F.asc("spread")]
    able = durable(scores.withColumns({"able": F.col("n_words") >= least_words, "spread": F.xxhash64(at)}))
    placed = durable(able.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({"part": F.shiftright(at, 33), "nth": at.bitwiseAND((1 << 33) - 1)}))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("able").alias("n_able"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("before"))  # a row for each partition
    drawn = sizes.agg(F.floor(F.coalesce(F.sum("n_able"), F.lit(0)) * percent / 100).alias("drawn"))
    rank = F.col("before") + F.col("nth") + 1
    numbered = placed.join(F.broadcast(starts), "part").crossJoin(F.broadcast(drawn))  # one row
    return numbered.select("doc_id", "n_features", "weight", "score", F.when(F.col("able") & (rank <= F.col("drawn")), rank).cast("long").alias("rank"))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, target_text: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """Every document with its weight towards ``target``, its score and, if drawn, its rank; see ``ranked``.

    Texts are read once: their buckets are written down and counted and weighed from there. Null and empty texts have
    weight 0 and are never drawn; an empty target or corpus gives every bucket its smoothed share.
    """
    corpus = durable(featured(df, id_col, text_col, buckets))
    wanted = durable(featured(target.withColumn("__id", F.lit(0)), "__id", target_text, buckets))
    return ranked(scored(weighted(corpus, gains(corpus, wanted, buckets)), seed), percent, least_words)
