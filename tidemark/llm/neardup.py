"""Near-duplicate classes by MinHash banding, odd sketches and exact confirmation.

Signatures: a document's word shingles are hashed to 64 bits, ``PERMUTATIONS`` MinHash samples are drawn from them, and
the samples are folded into band keys (candidates) and into an odd sketch: a bitmap in which every (sample, place)
flips one bit. The XOR of two sketches counts the samples that differ, which tells high similarities apart well.

1. Equal texts form a class under their smallest id; only class representatives go on.
2. Star round: in every band bucket each member is paired with the bucket's smallest id. Pairs whose sketches rule out
   the threshold go; the rest is confirmed on the full shingle sets. The links give components.
3. Residual round: a bucket whose members already share one component is done. In any other bucket all pairs from
   different components are compared by sketch. In a small bucket what passes is confirmed as pairs, each in the first
   bucket that it shares only. A large bucket is laid out in blocks that bring their shingle sets: pairs are confirmed
   inside the block, and only links that join components leave it. The components are then joined up.

So a group of any size costs rows in proportion to its members, yet no link between candidates is lost: a candidate
pair is either in one component by confirmed links or has been compared itself. A pair at the threshold is missed with
the probability ``(1 - t**rows) ** bands``, below ``MISS``; the sketch cut-off is six standard deviations wide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.durable import durable
from tidemark.llm.slices import give_back

PERMUTATIONS = 252
SKETCH_BITS = 1024
MISS = 5e-6
BLOCK = 512
SMALL_BUCKET = 16
COLUMNS_AT_ONCE = 8192
WORDS_KEPT = 150_000
ROWS_AT_ONCE = 500


class _WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E6C63D0676A9A99)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, words_each: int) -> tuple[np.ndarray, bytes]:
    """Sorted distinct 64-bit hashes of the text's shingles, and 16 bytes that stand for its word sequence.

    A to Z are lower-cased and words end at ASCII white space. Fewer words than ``words_each`` are one shingle; no
    words give none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    key = xxhash.xxh128_digest(b" ".join(words))
    if not words:
        return np.zeros(0, np.uint64), key
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - words_each + 1)
    total = np.full(n, min(len(words), words_each), np.uint64)
    for k in range(min(len(words), words_each)):
        total = _mix(total + h[k : k + n])
    return np.unique(total), key


class Signer:
    """MinHash samples, band keys and odd sketches with constants drawn from a seed."""

    def __init__(self, rows_each: int, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.rows, self.bands = rows_each, PERMUTATIONS // rows_each
        self.a = (rng.integers(0, 1 << 31, (PERMUTATIONS, 1), dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (PERMUTATIONS, 1), dtype=np.uint32)
        self.place = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
        self.salt = rng.integers(0, 1 << 63, self.bands, dtype=np.uint64)

    def sign(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and the sketch's words, both as signed 64-bit integers."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
        for k in range(0, len(x), 2048):
            low = np.minimum(low, (self.a * x[k : k + 2048] + self.b).min(axis=1))
        keyed = _mix(low + self.place)
        bits = np.bincount((keyed >> np.uint64(64 - 10)).astype(np.int64), minlength=SKETCH_BITS) & 1
        sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
        bands = self.salt.copy()
        for row in keyed[: self.bands * self.rows].reshape(self.bands, self.rows).T:
            bands = _mix(bands + row)
        return bands.view(np.int64), sketch


def band_rows(threshold: float) -> int:
    """The most rows a band may have so that a pair at the threshold is missed less often than ``MISS``."""
    fit = [r for r in range(1, 11) if (1 - threshold**r) ** (PERMUTATIONS // r) < MISS]
    return max(fit, default=1)


def sketch_cutoff(threshold: float) -> int:
    """The largest XOR count that a pair at the threshold can show, six standard deviations out."""
    differ = PERMUTATIONS * (1 - threshold)
    differ = min(PERMUTATIONS, differ + 6 * math.sqrt(differ * threshold))
    odd = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * differ))
    return math.ceil(odd + 3 * math.sqrt(odd * (1 - odd / SKETCH_BITS)) / 2)


def signatures(docs: DataFrame, words_each: int, rows_each: int) -> DataFrame:
    """``id, n, key, bands, sketch`` for rows of ``id, text``."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(rows_each)
        none = np.zeros(signer.bands, np.int64), np.zeros(SKETCH_BITS // 64, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                sets = [shingle_hashes(t, words_each) for t in batch["text"].to_pylist()]
                got = [signer.sign(s) if len(s) else none for s, _ in sets]
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([len(s) for s, _ in sets], pa.int64()), pa.array([k for _, k in sets], pa.binary()), _lists([b for b, _ in got]), _lists([s for _, s in got])], ["id", "n", "key", "bands", "sketch"])
        _WORDS.clear()
        give_back()

    return docs.mapInArrow(signed, "id long, n long, key binary, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, words_each: int) -> DataFrame:
    """``id, key, shingles`` for rows of ``id, text``."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                sets = [shingle_hashes(t, words_each) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([k for _, k in sets], pa.binary()), _lists([s.view(np.int64) for s, _ in sets])], ["id", "key", "shingles"])
        _WORDS.clear()
        give_back()

    return docs.mapInArrow(listed, "id long, key binary, shingles array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links`` (a, b): the smallest id that it reaches, by hooking and pointer jumping.

    Every round is a written table. Only a count of changes reaches the driver.
    """
    edges = durable(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("low"))
        roots = labels.select(F.col("id").alias("low"), F.col("label").alias("root"))
        new = durable(hooked.join(roots, "low").select("id", F.least("low", "root").alias("label"), (F.least("low", "root") < F.col("label")).alias("moved")))
        labels = new.select("id", "label")
        if not new.where("moved").limit(1).count():
            return labels


def _verified(pairs: DataFrame, docs: DataFrame, words_each: int, percent: int) -> DataFrame:
    """The pairs (a, ka, b, kb) whose full shingle sets reach the similarity, as links (a, b)."""
    wanted = pairs.select(F.col("a").alias("id"), F.col("ka").alias("key")).union(pairs.select("b", "kb")).distinct()
    texts = docs.join(wanted.select("id").distinct(), "id", "left_semi")
    sets = durable(shingle_sets(texts, words_each).join(wanted, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]))
    left = sets.select(F.col("id").alias("a"), F.col("key").alias("ka"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("key").alias("kb"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, ["a", "ka"]).join(right, ["b", "kb"]).where(both * 100 >= (F.size("sa") + F.size("sb") - both) * percent).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_each: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: its class of near copies and whether it stands for it.

    Documents are linked if 100 * intersection >= ``percent`` * union of their distinct shingles. Null and empty texts
    have no shingles and are linked with nothing. Rows with a null id are classes of their own with a null
    ``component_id`` and ``kept``. Rows that share an id are one document, whose texts all count. Other columns are
    not carried; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    threshold = percent / 100
    signed = durable(signatures(docs, words_each, band_rows(threshold)))
    real = signed.where("id is not null and n > 0")
    first = real.groupBy("key").agg(F.min(F.struct("id", "n", "bands", "sketch")).alias("s"))
    nodes = durable(first.select("s.*", "key"))

    bands = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = durable(bands.join(shared, "bucket").select("bucket", "id", "lead"))

    facts = nodes.select("id", "n", "key", "sketch")
    cutoff = sketch_cutoff(threshold)
    star = buckets.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    star = star.join(facts.toDF("a", "na", "ka", "va"), "a").join(facts.toDF("b", "nb", "kb", "vb"), "b")
    odd = F.aggregate(F.zip_with("va", "vb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    alike = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    tested = durable(star.where(alike & (odd <= cutoff)).select("a", "ka", "b", "kb"))
    labels = components(_verified(tested, docs, words_each, percent).union(_links_of_ids(real, nodes)))

    members = durable(_mixed_members(buckets, labels))
    few = members.where(F.col("n_all") <= SMALL_BUCKET).join(nodes, "id")
    untested = durable(_small_bucket_pairs(few, cutoff, percent).join(tested, ["a", "ka", "b", "kb"], "left_anti"))
    many = members.where(F.col("n_all") > SMALL_BUCKET)
    more = durable(_verified(untested, docs, words_each, percent).union(_large_bucket_links(many, facts, docs, words_each, cutoff, percent)))
    if more.limit(1).count():
        label = lambda side: labels.select(F.col("id").alias(side), F.col("label").alias(f"l{side}"))
        joined = more.join(label("a"), "a", "left").join(label("b"), "b", "left")
        upper = components(joined.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        upper = upper.select(F.col("id").alias("lower"), F.col("label").alias("upper"))
        every = labels.select("id", "label").union(upper.select("lower", "lower")).distinct()
        labels = durable(every.join(upper, every["label"] == upper["lower"], "left").select("id", F.coalesce("upper", "label").alias("label")))

    classes = nodes.select("key", F.col("id").alias("rep")).join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left")
    classes = classes.select("key", F.coalesce("label", "rep").alias("component"))
    linked = real.select("id", "n", "key").join(classes, "key").select("id", "n", "component")
    alone = signed.where("id is null or n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.union(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _links_of_ids(real: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between an id with several texts and the representatives of these texts; none where ids are unique."""
    several = real.groupBy("id").agg(F.min("key").alias("one"), F.max("key").alias("other")).where("one != other").select("id")
    texts = real.join(several, "id", "left_semi").select("id", "key").distinct()
    return texts.join(nodes.select("key", F.col("id").alias("rep")), "key").where("rep != id").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct()


def _mixed_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, id, comp, core, n_core, n_all`` of the buckets that hold several components; ``core`` is the largest."""
    placed = buckets.select("bucket", "id").join(labels, "id", "left").select("bucket", "id", F.coalesce("label", "id").alias("comp"))
    sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("core"), F.max("n").alias("n_core"), F.sum("n").alias("n_all")).where("n_all > n_core")
    return placed.join(mixed, "bucket")


def _small_bucket_pairs(members: DataFrame, cutoff: int, percent: int) -> DataFrame:
    """Pairs (a, ka, b, kb) of one small bucket but different components whose sketches allow the threshold.

    Buckets lie sorted in a partition, so members at every distance up to the bucket size are compared at once.
    """
    rows = members.select("bucket", "id", "comp", "n", "key", "sketch", "bands").repartition("bucket").sortWithinPartitions("bucket", "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            bucket = table["bucket"].to_numpy()
            cut = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1 if bucket[0] != bucket[-1] else 0
            kept = table.slice(cut)  # the last bucket may go on
            if cut:
                yield _near_rows(table.slice(0, cut), cutoff, percent)
        if kept is not None:
            yield _near_rows(kept, cutoff, percent)

    return rows.mapInArrow(compared, "a long, ka binary, b long, kb binary").distinct()


def _near_rows(table: pa.Table, cutoff: int, percent: int) -> pa.RecordBatch:
    table = table.combine_chunks()
    column = lambda name: table[name].to_numpy()
    matrix = lambda name: table[name].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    bucket, comp, n, ids = column("bucket"), column("comp"), column("n"), column("id")
    sketch, bands = matrix("sketch").view(np.uint64), matrix("bands")
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, min(SMALL_BUCKET, len(ids))):
        i = np.flatnonzero((bucket[d:] == bucket[:-d]) & (comp[d:] != comp[:-d]))
        i = i[np.minimum(n[i], n[i + d]) * 100 >= np.maximum(n[i], n[i + d]) * percent]
        i = i[np.bitwise_count(sketch[i] ^ sketch[i + d]).sum(axis=1) <= cutoff]
        same = bands[i] == bands[i + d]
        i = i[bands[i, same.argmax(axis=1)] == bucket[i]] if len(i) else i
        first.append(i)
        second.append(i + d)
    i, j = np.concatenate(first), np.concatenate(second)
    i, j = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
    key = table["key"]
    return pa.RecordBatch.from_arrays([pa.array(ids[i]), _flat(key.take(pa.array(i))), pa.array(ids[j]), _flat(key.take(pa.array(j)))], ["a", "ka", "b", "kb"])


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _large_bucket_links(members: DataFrame, facts: DataFrame, docs: DataFrame, words_each: int, cutoff: int, percent: int) -> DataFrame:
    """Links (a, b) that join components of one large bucket, confirmed on the full sets.

    A bucket's largest component is never compared with itself, so only its members against the others, and the others
    among themselves, are laid out in cells of at most about ``BLOCK`` by ``BLOCK`` members.
    """
    wanted = members.select("id").distinct().join(facts.select("id", "key"), "id")
    texts = docs.join(wanted.select("id"), "id", "left_semi")
    sets = durable(shingle_sets(texts, words_each).join(wanted, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]))
    ceil = lambda x: F.ceil(x / BLOCK).cast("int")
    laid = members.withColumns({"is_core": F.col("comp") == F.col("core"), "cores": ceil(F.col("n_core")), "others": ceil(F.col("n_all") - F.col("n_core"))})
    laid = laid.withColumn("mine", F.pmod(F.xxhash64("id"), F.when(F.col("is_core"), F.col("cores")).otherwise(F.col("others"))).cast("int"))
    span = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    with_others = F.transform(span(F.col("others")), lambda o: cell("core", F.col("mine"), o))
    with_cores = F.transform(span(F.col("cores")), lambda g: cell("core", g, F.col("mine")))
    among = F.transform(span(F.col("others")), lambda o: cell("other", F.least(o, F.col("mine")), F.greatest(o, F.col("mine"))))
    cells = F.when(F.col("is_core"), with_others).otherwise(F.concat(with_cores, among))
    rows = laid.select("bucket", "id", "comp", "is_core", F.explode(cells).alias("cell")).join(facts, "id").join(sets, ["id", "key"])
    rows = rows.select("bucket", "cell.kind", "cell.i", "cell.j", "id", "comp", "is_core", "n", "sketch", "shingles")

    def confirmed(pdf: pd.DataFrame) -> pd.DataFrame:
        sketch = np.stack(pdf["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        comp, n, ids = pdf["comp"].to_numpy(), pdf["n"].to_numpy(), pdf["id"].to_numpy()
        first = np.flatnonzero(pdf["is_core"]) if pdf["kind"].iloc[0] == "core" else np.arange(len(pdf))
        second = np.flatnonzero(~pdf["is_core"])
        pairs = []
        for at in range(0, len(first), 64):
            i = first[at : at + 64]
            odd = np.bitwise_count(sketch[i][:, None] ^ sketch[second]).sum(axis=2)
            fit = np.minimum(n[i][:, None], n[second]) * 100 >= np.maximum(n[i][:, None], n[second]) * percent
            p, q = np.nonzero((odd <= cutoff) & fit & (comp[i][:, None] != comp[second]))
            pairs.append(np.stack([i[p], second[q]]))
        i, j = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        links = []
        if len(used):
            common = _intersections([np.asarray(s) for s in pdf["shingles"].to_numpy()[used]])
            both = common[at[: len(i)], at[len(i) :]]
            sure = both * 100 >= (n[i] + n[j] - both) * percent
            root = {c: c for c in comp}

            def top(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            for x, y in zip(i[sure], j[sure], strict=True):
                a, b = top(comp[x]), top(comp[y])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return rows.groupBy("bucket", "kind", "i", "j").applyInPandas(confirmed, "a long, b long")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from a 0-1 matrix of members and shared shingles, some columns at a time."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    of, column = of[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [low, low + COLUMNS_AT_ONCE])
        dense = np.zeros((len(sets), COLUMNS_AT_ONCE), np.float32)
        dense[of[a:b], column[a:b] - low] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


ORACLE_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM words, generate_series(1, greatest(len(w) - 2, 1)) t(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), lowest AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM lowest LEFT JOIN sizes USING (doc_id)
"""
