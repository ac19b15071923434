"""Approximate nearest neighbours by shifted Hilbert curves.

Every vector is projected onto a few random directions, several times over; each projection, shifted by a random
amount, is put on a Hilbert curve. Spark range-partitions the vectors by curve and key, which gives each its rank on each
curve. A query is compared with the vectors whose rank is within a window of its own on any curve; the windows' best
are merged and reranked by the exact cosine.

Windows are a share of the rows, not a number of them: on vectors without structure a curve keeps so little of their
nearness that a fixed number would lose recall as the table grows. The README has measured recall and cost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.durable import durable

CURVES, AXES, BITS = 8, 4, 15
WINDOW_SHARE = 0.1
#: A window holds at least so many rows for each neighbour asked for.
ROWS_EACH = 8
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
FIT_ROWS = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative cells below ``2 ** bits``.

    The cells' bits are Gray-decoded level by level while the axes are reflected and swapped, from the top bit down.
    """
    axes = [column.copy() for column in cells.astype(np.int64).T]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k, axis in enumerate(axes):
            high = (axis >> level) & 1 == 1
            swap = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if k:
                axes[k] = axis ^ swap
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip = np.where((axes[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (double) without null ids and without vectors that are null, empty, zero or not all finite numbers.

    An id that comes several times keeps its smallest vector. If lengths differ, the most frequent one counts (of
    equals the largest): other vectors have no cosine with it and take no part.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id is not null and size(vec) > 0")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)).groupBy("id").agg(F.min("vec").alias("vec"))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vec") == (size[0]["d"] if size else 0))


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, is_query: Column | None = None, k: int = 5, curves: int = CURVES, axes: int = AXES, window_share: float = WINDOW_SHARE, seed: int = 1) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest others by cosine, ties to the smaller id.

    ``is_query`` is a condition on ``id`` (all rows, if none). Equal vectors are one node on the curves, so any number of
    copies costs one place in a window of ``window_share`` of all nodes on either side; the k + 1 smallest ids of a node stand for it, which loses no answer. Fewer than
    ``k`` others give fewer rows. The projection is fitted on the ``FIT_ROWS`` nodes with the smallest id hashes.
    """
    rows = usable_vectors(df, id_col, vec_col).withColumn("asks", is_query if is_query is not None else F.lit(True))
    nodes = durable(rows.groupBy("vec").agg(F.min("id").alias("node"), F.max("asks").alias("asks")))
    members = durable(rows.join(nodes.select("vec", "node"), "vec").select("id", "node", "asks"))
    n, asking = nodes.count(), nodes.where("asks").count()
    first = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    answers = members.select("id", "node", first.alias("place")).where(F.col("place") <= k + 1).select(F.col("node").alias("near"), F.col("id").alias("vec_id"))

    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).select("vec").toPandas()["vec"]
    sample = np.stack(sample.to_numpy()) if len(sample) else np.ones((1, 1))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    wide = min(axes, sample.shape[1])
    directions = [np.linalg.qr(rng.normal(size=(sample.shape[1], wide)))[0] for _ in range(curves)]
    centres = [(sample @ d).mean(axis=0) for d in directions]
    spreads = [(sample @ d).std(axis=0) * 8 + 1e-9 for d in directions]
    shifts = rng.uniform(-0.03, 0.03, (curves, wide))

    def keyed(batches):
        for pdf in batches:
            vectors = np.stack(pdf["vec"].to_numpy())
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            packed = [v.tobytes() for v in vectors]
            for c in range(curves):
                at = (unit @ directions[c] - centres[c]) / spreads[c] + 0.5 + shifts[c]
                cells = np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pd.DataFrame({"curve": np.int32(c), "key": hilbert_keys(cells, BITS), "node": pdf["node"], "asks": pdf["asks"], "vec": packed})

    curved = nodes.select("node", "asks", "vec").mapInPandas(keyed, "curve int, key long, node long, asks boolean, vec binary")
    dealt = max(curves, -(-n * curves // BLOCK_ROWS))
    ordered = curved.repartitionByRange(dealt, "curve", "key", "node").sortWithinPartitions("curve", "key", "node")
    at = F.monotonically_increasing_id()
    ordered = durable(ordered.withColumns({"part": F.shiftright(at, 33), "pos": at.bitwiseAND((1 << 33) - 1)}))
    parts = ordered.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("low"))
    before = F.sum("rows").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("curve", "part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("start"))  # a row for each partition
    ranked = ordered.join(F.broadcast(starts), ["curve", "part"]).withColumn("at", F.col("pos") + F.col("start"))

    window = max(ROWS_EACH * k, int(np.ceil(window_share * n)))
    chunks = max(1, -(-min(asking, int(asking * (2 * window + BLOCK_ROWS) / max(1, n)) + 1) // BLOCK_QUERIES))
    last = F.lit(max(0, n - 1))
    block = lambda x: F.floor(x / BLOCK_ROWS).cast("long")
    right = ranked.select("curve", block(F.col("at")).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "node", "vec")
    met = F.sequence(block(F.greatest(F.col("at") - window, F.lit(0))), block(F.least(F.col("at") + window, last)))
    left = ranked.where("asks").select("curve", F.explode(met).alias("block"), F.pmod(F.xxhash64("node"), F.lit(chunks)).cast("int").alias("chunk"), "node", "vec")

    def nearest(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(there):
            return pd.DataFrame({"node": [], "near": [], "score": []}).astype({"node": "int64", "near": "int64"})
        q, v = (np.frombuffer(b"".join(x["vec"]), np.float64).reshape(len(x), -1) for x in (asked, there))
        nq, nv = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
        near = there["node"].to_numpy()
        found = []
        for lo in range(0, len(q), 256):
            rough = (q[lo : lo + 256] @ v.T) / nq[lo : lo + 256, None] / nv
            least = np.partition(rough, -min(k + 1, len(v)), axis=1)[:, -min(k + 1, len(v))] - 1e-9
            a, b = np.nonzero(rough >= least[:, None])
            # the scores that count come from one pair at a time, so they do not depend on the blocks
            score = np.array([np.dot(q[lo + i], v[j]) / (nq[lo + i] * nv[j]) for i, j in zip(a, b, strict=True)])
            order = np.lexsort((near[b], -score, a))
            a, b, score = a[order], b[order], score[order]
            starts_at = np.searchsorted(a, np.arange(a.max() + 1))
            kept = np.arange(len(a)) - starts_at[a] < k + 1
            found.append(pd.DataFrame({"node": asked["node"].to_numpy()[lo + a[kept]], "near": near[b[kept]], "score": score[kept]}))
        return pd.concat(found)

    keys = ["curve", "block", "chunk"]
    right = right.toDF(*keys, "node", "vec")  # columns of their own, as both sides come from one table
    partial = left.toDF(*keys, "node", "vec").groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(nearest, "node long, near long, score double")
    merged = partial.groupBy("node", "near").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "near"))
    merged = merged.withColumn("place", best).where(F.col("place") <= k + 1).select("node", "near", "score")
    asked = members.where("asks").select(F.col("id").alias("query_id"), "node")
    pairs = merged.join(answers, "near").join(asked, "node").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
