"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One vector of weights over hashed words and a few measures of shape gives every document a score; ordered thresholds
cut the score into grades: P(grade >= k) = sigmoid(score - threshold_k). The grades here are 0 (low quality), 1
(readable but toxic) and 2 (readable and clean). A document is kept if the probability of the top grade reaches
``KEEP``. The model is fitted on at most ``MAX_LABELLED`` labelled rows, chosen by a hash of the id; scoring reads every
whole text.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.durable import durable
from tidemark.llm.slices import give_back

HASH_BITS = 21
BINS = 12
SHAPES = 9 * BINS
GRADES = 3
KEEP = 0.7
DENSE = 125
MAX_LABELLED = 16_000
MAX_TRAIN_SLOTS = 24_000_000
SLOTS_AT_ONCE = 2_000_000
WORDS_KEPT = 150_000
ROWS_AT_ONCE = 500
LEAST_ROWS = 8


_UPPER, _DIGITS, _SPACE = string.ascii_uppercase.encode(), string.digits.encode(), b" \t\r\n"
_ODD = bytes(b for b in range(128) if not chr(b).isalnum() and b not in _SPACE)


class _Slots(dict):
    """Hash slots of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = slot = SHAPES + (xxhash.xxh32_intdigest(word) >> (32 - HASH_BITS))
        return slot


_SLOTS = _Slots()


def features(text: str | None) -> np.ndarray:
    """The slots that the text has: nine measures of shape, each in one of ``BINS`` bins, then the slots of the lower-cased
    words' first six and first four bytes, so that one stem's forms share evidence, and once more of the stems that make
    up a ``DENSE``-th of the words (and come twice at least): a word that many texts hold once tells less than its density.

    A null text is an empty one.
    """
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().split()
    n, m = max(1, len(raw)), max(1, len(words))
    counts = Counter(words)
    stems: dict[bytes, int] = {}
    for word, times in counts.items():
        stem = word.strip(b".,;:!?\"'()")[:6]
        stems[stem] = stems.get(stem, 0) + times
    for stem, times in list(stems.items()):
        short = stem[:4] + b"*"
        stems[short] = stems.get(short, 0) + times
    least = max(2, -(-m // DENSE))
    dense = [stem + b"#" for stem, times in stems.items() if times >= least]
    lines = raw.split(b"\n")
    upper, digits, space, odd = ((len(raw) - len(raw.translate(None, kind))) / n for kind in (_UPPER, _DIGITS, _SPACE, _ODD))
    shape = np.array([np.log1p(m) / 10, len(counts) / m, upper, odd, digits, space * 2, len(set(lines)) / len(lines), n / m / 24, np.log1p(len(lines)) / 8])
    bins = np.arange(len(shape)) * BINS + np.clip(shape * BINS, 0, BINS - 1).astype(np.int64)
    slots = np.unique(np.fromiter(map(_SLOTS.__getitem__, chain(stems, dense)), np.int64, len(stems) + len(dense)))
    return np.concatenate([bins, slots])


@dataclass
class Ordinal:
    """Fitted weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1 on, a column each."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))

    def least_kept(self, keep: float) -> float:
        """The probability of the top grade from which a document stays; a model that knows nothing rejects nothing."""
        return keep if self.weights.any() else 0.0


class Rows:
    """Rows of slots in one array: iterates over the rows, and can be emptied when they have been read for the last time."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.ends, self.starts = flat, np.cumsum(lengths), np.cumsum(lengths) - lengths
        self.order = np.arange(len(lengths))

    def sort(self, order: np.ndarray) -> None:
        """Iterate in another order; nothing is moved."""
        self.order = order

    def __len__(self) -> int:
        return len(self.ends)

    def __iter__(self) -> Iterator[np.ndarray]:
        for k in self.order.tolist():
            yield self.flat[self.starts[k] : self.ends[k]]

    def clear(self) -> None:
        self.flat = self.flat[:0].copy()


def fit(rows: Rows | list[np.ndarray], grades: np.ndarray, *, epochs: int = 300, rate: float = 0.2, lasso: float = 6e-4) -> Ordinal:
    """Maximum likelihood of the cumulative-link model by Adam over the whole batch, rows weighted by the root of the inverse grade count.

    Grades that the sample lacks cost nothing; without any row the model is zero: every probability is one half and
    nothing is rejected. The slots are held by row and by slot as 32-bit numbers, and sums run over their stretches;
    ``rows`` is emptied once its slots have been taken over.
    """
    size = SHAPES + (1 << HASH_BITS)
    w, base, gaps = np.zeros(size), 0.0, np.zeros(GRADES - 2)
    if not len(rows):
        return Ordinal(w, np.zeros(GRADES - 1))
    counts = np.bincount(grades, minlength=GRADES)
    weight = np.sqrt(len(grades) / (np.count_nonzero(counts) * np.maximum(counts, 1)))[grades]
    seen = np.zeros(size, np.int32)
    for r in rows:
        seen[r] += 1  # a row has a slot once
    used = np.flatnonzero(seen >= LEAST_ROWS)  # words of a few rows only learn those rows by heart
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    lengths = np.fromiter((np.count_nonzero(place[r] >= 0) for r in rows), np.int64, len(rows))
    slots, at = np.empty(lengths.sum(), np.int32), 0
    for r in rows:
        p = place[r]
        p = p[p >= 0]
        slots[at : at + len(p)] = p
        at += len(p)
    rows.clear()
    of = _rows_by_slot(slots, lengths, len(used))
    by_row, by_slot = _Stretches(lengths), _Stretches(seen[used])
    del place, seen
    give_back()
    v = np.zeros(len(used))
    moment, second = np.zeros(len(used) + GRADES - 1), np.zeros(len(used) + GRADES - 1)
    for t in range(1, epochs + 1):
        thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = by_row.sums(v.astype(np.float32), slots)
        cum = np.concatenate([np.ones((len(score), 1)), 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -40, 40))), np.zeros((len(score), 1))], axis=1)
        at = np.arange(len(score))
        upper, lower = cum[at, grades], cum[at, grades + 1]
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        d_score = -weight * (du - dl) / len(score)
        d_threshold = np.zeros(GRADES + 1)
        np.add.at(d_threshold, grades, weight * du / len(score))
        np.add.at(d_threshold, grades + 1, -weight * dl / len(score))
        d_threshold = d_threshold[1:GRADES]
        grad = np.concatenate([by_slot.sums(d_score.astype(np.float32), of), [d_threshold.sum()], np.cumsum(d_threshold[::-1])[::-1][1:] * np.exp(gaps)])
        moment, second = 0.9 * moment + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        scale = rate / (np.sqrt(second / (1 - 0.99**t)) + 1e-4)
        step = scale * moment / (1 - 0.9**t)
        v -= step[: len(used)]
        soft = np.where(used < SHAPES, 0.0, lasso * scale[: len(used)])
        v = np.sign(v) * np.maximum(np.abs(v) - soft, 0.0)  # most words say nothing: their weights stay exactly zero
        base -= step[len(used)]
        gaps -= step[len(used) + 1 :]
    w[used] = v
    return Ordinal(w, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _rows_by_slot(slots: np.ndarray, lengths: np.ndarray, size: int, parts: int = 16) -> np.ndarray:
    """The row of every entry, in the order of the slots; some slots at a time, so that no sort of all entries is held."""
    ends = np.cumsum(lengths)
    out, at = np.empty(len(slots), np.int32), 0
    for part in range(parts):
        low, high = size * part // parts, size * (part + 1) // parts
        here = np.flatnonzero((slots >= low) & (slots < high))
        here = here[np.argsort(slots[here], kind="stable")]
        out[at : at + len(here)] = np.searchsorted(ends, here, side="right")
        at += len(here)
    return out


class _Stretches:
    """Sums over neighbouring stretches of an array; an empty stretch has zero."""

    def __init__(self, lengths: np.ndarray):
        self.full = np.flatnonzero(lengths)
        self.starts = (np.cumsum(lengths) - lengths)[self.full]
        self.ends = np.cumsum(lengths)[self.full]
        self.n = len(lengths)

    def sums(self, values: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Of ``values[index]``, of which some millions are there at a time."""
        out, low = np.zeros(self.n), 0
        while low < len(self.full):
            first = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, first + SLOTS_AT_ONCE, side="right")))
            out[self.full[low:high]] = np.add.reduceat(values[index[first : self.ends[high - 1]]], self.starts[low:high] - first)
            low = high
        return out


def grade_column() -> F.Column:
    """The grade of a label row: 0 low quality, 1 readable but toxic, 2 readable and clean; null where a label is null."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_labelled: int = MAX_LABELLED) -> Ordinal:
    """Fit on the ``max_labelled`` labelled documents with the smallest id hashes.

    ``labels`` has the id, ``quality`` and ``toxic``; rows with a null there are left out, of repeated labels the
    lowest grade counts, of rows that share an id the text with the fewest slots (of equals the smallest). Only the sample's features reach the driver: whole rows in the order of the id hashes, as many
    as ``MAX_TRAIN_SLOTS`` slots hold.
    """
    graded = labels.select(F.col(id_col).alias("id"), grade_column().alias("grade")).where("id is not null and grade is not null")
    graded = graded.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(graded), "id").select("id", "text", "grade")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t).astype(np.int32) for t in batch["text"].to_pylist()]
            columns = [batch["id"], batch["grade"], pa.array([len(x) for x in got], pa.int64()), pa.array([x.tobytes() for x in got], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "grade", "size", "slots"])

    kind = dict(sample.dtypes)["id"]
    found = sample.mapInArrow(featured, f"id {kind}, grade int, size long, slots binary")
    found = found.groupBy("id").agg(F.min(F.struct("size", "grade", "slots")).alias("row")).select("id", "row.*")
    found = durable(found.withColumn("at", F.xxhash64("id")))
    sizes = found.groupBy("at").agg(F.sum("size").alias("size")).orderBy("at").toPandas()
    upto = sizes["size"].cumsum().to_numpy()
    at, whole = sizes["at"].to_numpy(), int(np.searchsorted(upto, MAX_TRAIN_SLOTS, side="right"))
    ids, grades, lengths, flat = [], [], [], np.empty(upto[whole - 1] if whole else 0, np.int32)
    filled = low = 0
    while low < whole:  # some millions of slots at a time, so that neither side of the driver holds them twice
        high = max(low + 1, int(np.searchsorted(upto[:whole], (upto[low - 1] if low else 0) + SLOTS_AT_ONCE, side="right")))
        table = found.where(F.col("at").between(int(at[low]), int(at[high - 1]))).select("id", "grade", "slots").toArrow()
        ids.append(table["id"].to_numpy())
        grades.append(table["grade"].to_numpy())
        for chunk in table["slots"].chunks:
            for row in chunk:
                slots = np.frombuffer(row.as_buffer(), np.int32)
                flat[filled : filled + len(slots)] = slots
                lengths.append(len(slots))
                filled += len(slots)
        del table
        low = high
    rows, known = Rows(flat, np.array(lengths, np.int64)), np.concatenate([*grades, np.zeros(0, np.int64)]).astype(np.int64)
    del flat
    rows.sort(np.argsort(np.concatenate([*ids, np.zeros(0, np.int64)]), kind="stable"))
    give_back()
    return fit(rows, known[rows.order])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``ROWS_AT_ONCE`` rows, so that few texts are Python strings at a time; the word table goes at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
    _SLOTS.clear()
    give_back()


def keep_rows(docs: DataFrame, model: Ordinal, text_col: str = "text", *, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose probability of the top grade reaches ``keep``.

    Every row is judged by its own text in the task that reads it: nothing is joined or shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Ordinal(*shared.value)
        least = fitted.least_kept(keep)
        for batch in _slices(batches):
            total = np.array([fitted.weights[features(t)].sum() for t in batch[text_col].to_pylist()])
            yield batch.filter(pa.array(fitted.tails(total)[:, -1] >= least))

    return docs.mapInArrow(kept, docs.schema)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", *, keep: float = KEEP) -> DataFrame:
    """``doc_id, expected_grade, p_top, kept`` of every row; the weights go to the tasks as one bounded broadcast."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Ordinal(*shared.value)
        least = fitted.least_kept(keep)
        for batch in _slices(batches):
            tails = fitted.tails(np.array([fitted.weights[features(t)].sum() for t in batch["text"].to_pylist()]))
            expected, top = tails.sum(axis=1), tails[:, -1]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(expected), pa.array(top), pa.array(top >= least)], ["doc_id", "expected_grade", "p_top", "kept"])

    return rows.mapInArrow(scored, f"doc_id {dict(rows.dtypes)['doc_id']}, expected_grade double, p_top double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Train on ``labels`` and score every document; see ``train`` and ``score``.

    Null and empty texts are scored by their shape. Repeated rows get equal scores. Without labels every document
    scores one half and stays.
    """
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col, **options)
