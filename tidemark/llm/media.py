"""Chroma audio fingerprints in media columns, and the alignment of recordings by them.

A media column is a struct of ``rate`` (samples a second) and ``pcm`` (little-endian 16-bit mono). Frames of a recording are
folded into twelve pitch classes; rectangle filters, read off an integral image of that pitch-time picture, are
quantised to two bits each, and sixteen of them make a 32-bit code for each frame. Frames in silence keep their place but
have no code. Recordings meet in a join on codes, never as all pairs: every agreement votes for an offset, two recordings
align at the peak of their offset histogram, and the share of differing bits over the overlap there tells how alike they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.durable import durable

FRAME, HOP, CLASSES = 1024, 512, 12
SPAN = 8
FILTERS = 16
FRAMES_AT_ONCE = 4096
SALTS = 8
MOST_ERRORS = 0.3
LEAST_OVERLAP = 8
RECORDINGS_AT_ONCE = 64
BATCH_BYTES = 8 << 20
MEDIA_TYPE = "struct<rate:int,pcm:binary>"


def chroma(pcm: np.ndarray, rate: int) -> np.ndarray:
    """Pitch-class energies of every frame, each frame scaled to one; silent frames are zero."""
    if len(pcm) < FRAME or rate <= 0:
        return np.zeros((0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(pcm, FRAME)[::HOP]
    frequency = np.fft.rfftfreq(FRAME, 1 / rate)
    heard = (frequency >= 80) & (frequency <= min(3500, rate / 2))
    pitch = np.eye(CLASSES)[np.round(12 * np.log2(frequency[heard] / 440)).astype(int) % CLASSES]
    window = np.hanning(FRAME).astype(np.float32)
    folded = [(np.abs(np.fft.rfft(frames[k : k + FRAMES_AT_ONCE].astype(np.float32) * window, axis=1)) ** 2)[:, heard] @ pitch for k in range(0, len(frames), FRAMES_AT_ONCE)]
    picture = np.concatenate(folded)
    return picture / np.maximum(picture.sum(axis=1, keepdims=True), 1e-3)


@lru_cache(maxsize=1)
def _filters() -> list[tuple[int, int, int, int, int]]:
    """(kind, first pitch class, classes, first frame, frames) drawn from a seed; kinds split in time, in pitch or in both;
    two stretches of frames fit into the span."""
    rng = np.random.default_rng(12)
    wide = [int(w) for w in rng.integers(1, SPAN // 2 + 1, FILTERS)]
    return [(k % 3, int(rng.integers(0, 9)), int(rng.integers(1, 3)) * 2, int(rng.integers(0, SPAN - 2 * w + 1)), w) for k, w in enumerate(wide)]


def _responses(picture: np.ndarray) -> np.ndarray:
    n = len(picture) - SPAN + 1
    if n <= 0:
        return np.zeros((0, FILTERS))
    image = np.zeros((len(picture) + 1, CLASSES + 1))
    image[1:, 1:] = picture.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(y: int, h: int, x: int, w: int) -> np.ndarray:
        return image[at + x + w, y + h] - image[at + x, y + h] - image[at + x + w, y] + image[at + x, y]

    out = np.empty((n, FILTERS))
    for k, (kind, y, h, x, w) in enumerate(_filters()):
        if kind == 0:
            one, two = area(y, h, x, w), area(y, h, x + w, w)
        elif kind == 1:
            one, two = area(y, h // 2, x, w), area(y + h // 2, h // 2, x, w)
        else:
            one = area(y, h // 2, x, w) + area(y + h // 2, h // 2, x + w, w)
            two = area(y + h // 2, h // 2, x, w) + area(y, h // 2, x + w, w)
        out[:, k] = np.log((0.05 + one) / (0.05 + two))
    return out


@lru_cache(maxsize=1)
def _thresholds() -> np.ndarray:
    """Quartiles of every filter over seeded noise, so that codes are spread out."""
    rng = np.random.default_rng(13)
    noise = rng.gamma(0.3, size=(4000, CLASSES))
    return np.quantile(_responses(noise / noise.sum(axis=1, keepdims=True)), [0.25, 0.5, 0.75], axis=0)


def codes(pcm: bytes | None, rate: int | None) -> tuple[np.ndarray, np.ndarray]:
    """A recording's 32-bit codes, one for each frame, and which of them sound; none for nulls or fewer than ``SPAN`` frames.

    A code looks at ``SPAN`` frames; where all of them are silent it does not sound.
    """
    samples = np.frombuffer((pcm or b"")[: len(pcm or b"") // 2 * 2], "<i2")
    picture = chroma(samples / np.float32(32768), rate or 0)
    response = _responses(picture)
    low, mid, high = _thresholds()
    level = (response > low).astype(np.uint32) + (response > mid) + (response > high)
    gray = (level ^ (level >> 1)).astype(np.uint32)
    packed = (gray << (2 * np.arange(FILTERS, dtype=np.uint32))).sum(axis=1).astype(np.uint32)
    heard = np.concatenate([[0], np.cumsum(picture.sum(axis=1) > 0)])
    return packed, heard[SPAN : SPAN + len(packed)] > heard[: len(packed)]


def fingerprints(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """``id, codes`` for every row with an id: a 32-bit integer for each frame, null in silence; null media have no codes.

    Run it inside ``few_recordings`` on tables of long recordings, so that no batch of them outgrows a task.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(f"{media_col}.rate").alias("rate"), F.col(f"{media_col}.pcm").alias("pcm")).where("id is not null")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codes(p.as_py(), r.as_py()) for p, r in zip(batch["pcm"], batch["rate"], strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(c) for c, _ in found])]).astype(np.int32)
            flat, sounds = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, kind) for k, kind in ((0, np.uint32), (1, bool)))
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int32), mask=~sounds))
            yield pa.RecordBatch.from_arrays([batch["id"], lists], ["id", "codes"])

    return rows.mapInArrow(coded, "id long, codes array<int>")


def _postings(df: DataFrame, name: str) -> DataFrame:
    """``name, code, at``: every frame that sounds."""
    return df.select(name, F.posexplode("codes").alias("at", "code")).where("code is not null")


def search(asked: DataFrame, there: DataFrame, *, k: int = 5, most_errors: float = MOST_ERRORS, least_overlap: int = LEAST_OVERLAP) -> DataFrame:
    """``query_id, rank, id, offset, votes, overlap, bit_errors``: for every fingerprint of ``asked`` the ``k`` recordings of
    ``there`` that align with the fewest bit errors, ties to the smaller id.

    Two fingerprints are compared if a code of one occurs in the other, at the offset (of the recording's frames to the query's) at which most codes agree, ties
    to the smallest. Frames count where both sound. Alignments over fewer than ``least_overlap`` frames or with more than
    ``most_errors`` of the bits differing do not count.

    Equal fingerprints are compared once: the ``k`` smallest ids stand for each, which loses no answer; a repeated id
    counts once, with its smallest codes. Recordings without a frame that sounds, and an empty table, find and are
    nothing. Postings meet by code; a code's recordings are dealt over ``SALTS`` tasks, as one code may be in many.
    """
    one = lambda df: df.groupBy("id").agg(F.min("codes").alias("codes")).where(F.exists("codes", lambda c: c.isNotNull()))
    each = durable(one(there))
    first = F.row_number().over(Window.partitionBy("codes").orderBy("id"))
    ids = durable(each.withColumn("place", first).where(F.col("place") <= k).withColumn("node", F.min("id").over(Window.partitionBy("codes"))))
    nodes = ids.where("id = node").select("node", "codes")
    queries = durable(one(asked)).withColumnRenamed("id", "query_id")
    left = _postings(queries, "query_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    right = _postings(nodes, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).withColumnRenamed("at", "there")
    votes = left.join(right, ["code", "salt"]).groupBy("query_id", "node", (F.col("there") - F.col("at")).alias("offset")).agg(F.count(F.lit(1)).alias("votes"))
    peaks = durable(votes.groupBy("query_id", "node").agg(F.max(F.struct("votes", (-F.col("offset")).alias("back"))).alias("p")).select("query_id", "node", (-F.col("p.back")).cast("long").alias("offset"), "p.votes"))
    met = peaks.join(queries.withColumnRenamed("codes", "asked"), "query_id").join(nodes.withColumnRenamed("codes", "found"), "node")
    start = lambda shift: F.greatest(shift, F.lit(0)).cast("int")
    rest = lambda c, shift: F.slice(c, start(shift) + 1, F.greatest(F.size(c) - start(shift), F.lit(0)))
    differing = F.filter(F.zip_with(rest("asked", -F.col("offset")), rest("found", F.col("offset")), lambda x, y: F.bit_count(x.bitwiseXOR(y).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), lambda d: d.isNotNull())
    met = met.withColumn("differing", differing).withColumn("overlap", F.size("differing").cast("long"))
    met = met.withColumn("bit_errors", F.aggregate("differing", F.lit(0), lambda x, y: x + y) / (32 * F.col("overlap")))
    met = met.where((F.col("bit_errors") <= most_errors) & (F.col("overlap") >= least_overlap)).select("query_id", "node", "offset", "votes", "overlap", "bit_errors")
    best = lambda by: F.row_number().over(Window.partitionBy("query_id").orderBy("bit_errors", by))
    met = met.withColumn("place", best("node")).where(F.col("place") <= k).drop("place")
    full = met.join(ids.select("node", "id"), "node")
    return full.withColumn("rank", best("id")).where(F.col("rank") <= k).select("query_id", "rank", "id", "offset", "votes", "overlap", "bit_errors")


def play(vec: list | None, rate: int = 4000, note: int = 512, first: int = 0, last: int | None = None) -> bytes | None:
    """A vector as 16-bit PCM: a note for each component, from sample ``first`` to ``last``; null components are rests."""
    if vec is None:
        return None
    v = np.array([np.nan if x is None else x for x in vec], float)
    step = np.clip(np.round(np.nan_to_num(v, posinf=1, neginf=-1) * 48) + 18, 0, 36)
    wave = np.sin(2 * np.pi * (110 * 2 ** (step / 12))[:, None] * np.arange(note) / rate) * np.isfinite(v)[:, None]
    return (wave.ravel()[first:last] * 20000).astype("<i2").tobytes()


def tones(df: DataFrame, id_col: str, vec_col: str, *, rate: int = 4000, first: int = 0, last: int | None = None) -> DataFrame:
    """``id, media``: each vector played as a melody, a stand-in for recordings where a table has none; null vectors have null media."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def played(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, RECORDINGS_AT_ONCE):
                batch = whole.slice(at, RECORDINGS_AT_ONCE)
                pcm = [play(v, rate, first=first, last=last) for v in batch["vec"].to_pylist()]
                rates = pa.array([rate] * len(pcm), pa.int32())
                media = pa.StructArray.from_arrays([rates, pa.array(pcm, pa.binary())], ["rate", "pcm"], mask=pa.array([p is None for p in pcm]))
                yield pa.RecordBatch.from_arrays([batch["id"], media], ["id", "media"])

    return rows.mapInArrow(played, f"id long, media {MEDIA_TYPE}")


@contextmanager
def few_recordings(spark: SparkSession) -> Iterator[None]:
    """Recordings go to Python a few at a time while a table of them is read: a batch is bounded in bytes and in rows."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(RECORDINGS_AT_ONCE), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {name: spark.conf.get(name) for name in bounds}
    try:
        for name, value in bounds.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def align_melodies(df: DataFrame, id_col: str, vec_col: str, asks: Column, **options) -> DataFrame:
    """Clips from the middle of the rows that ``asks`` picks, cut off the beat, aligned against all rows' melodies.

    The media column is made and fingerprinted in one pass; only the codes are written. Rows without an id take no part;
    null and empty vectors, and those without a finite component, are silent; ties and repeated ids as in ``search``.
    """
    with few_recordings(df.sparkSession):
        clips = durable(fingerprints(tones(df.where(asks), id_col, vec_col, first=8192 + 37, last=24576), "id", "media"))
        whole = durable(fingerprints(tones(df, id_col, vec_col), "id", "media"))
    return search(clips, whole, **options)
