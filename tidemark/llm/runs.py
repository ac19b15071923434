"""Periodic runs of words, found on a Re-Pair grammar of each text.

A *run* is a stretch of consecutive words with smallest period q and at least ``max(least, exponent * q)`` words that no
neighbouring word extends. In a run every pair of neighbouring words stands three times or more (``exponent`` is 4 at
least), so texts are cut at all other pairs first, again and again with numpy, and no run is cut. What remains goes through
Re-Pair: the most frequent pair of symbols becomes a new symbol until no pair repeats, and a balanced tree stands over
the symbols that are left. Every run lies across the boundary of exactly one lowest node. Runs across a symbol's boundary
are computed once, on its first occurrence, then moved to all its places in the derivation; a run that a symbol shows in
part is shown whole by a node above it, so intervals of one period that overlap by a period merge to the maximal ones.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.slices import slices

LEAST = 6
EXPONENT = 4
Run = tuple[int, int, int]  # start, length, period


def re_pair(words: list[int], fresh: int) -> tuple[list[int], list[tuple[int, int]]]:
    """The last string of symbols and the pair behind each new symbol, numbered from ``fresh``.

    Always replaces the pair with most non-overlapping places, of equal ones the smallest; stops where none has two.
    """
    n = len(words)
    symbol, after, before = [*words, -1], list(range(1, n + 2)), list(range(-1, n))
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, pair in enumerate(zip(words, words[1:])):
        places[pair].append(i)
    heap = [(-len(found), pair) for pair, found in places.items() if len(found) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        a, b = pair
        found, taken = [], -1
        for i in places.pop(pair):
            if symbol[i] == a and symbol[after[i]] == b and i != taken:
                found.append(i)
                taken = after[i]
        if len(found) < 2:
            continue
        if len(found) < -count:  # some places have gone since: wait for the turn of the true count
            places[pair] = found
            heapq.heappush(heap, (-len(found), pair))
            continue
        new = fresh + len(rules)
        rules.append(pair)
        touched = set()
        for i in found:
            j = after[i]
            k, p = after[j], before[i]
            symbol[i], symbol[j], after[i] = new, -2, k
            if k <= n:
                before[k] = i
            if k < n:
                places[new, symbol[k]].append(i)
                touched.add((new, symbol[k]))
            if p >= 0:
                places[symbol[p], new].append(p)
                touched.add((symbol[p], new))
        for near in touched:
            if len(places[near]) > 1:
                heapq.heappush(heap, (-len(places[near]), near))
    out, i = [], 0
    while i < n:
        out.append(symbol[i])
        i = after[i]
    return out, rules


def _shared(text: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of the text and its rest from there (the Z function)."""
    n = len(text)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _periods(z: list[int], exponent: int) -> Iterator[tuple[int, int]]:
    """Smallest periods q that hold for a prefix of half a run at least, and for how many symbols each holds."""
    covered = 0
    for q in range(1, len(z) // 2 + 1):
        held = q + z[q] if z[q] else 0
        if 2 * held >= exponent * q and 2 * q > covered:
            yield q, held
            covered = held


def across(text: list[int], start: int, middle: int, end: int, least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """Runs of ``text[start:end]`` that hold the words on both sides of ``middle``; one half of each lies on one side."""
    if end - start < least:
        return []
    left, right = text[start:middle], text[middle:end]
    backwards = left[::-1]
    found = set()
    for near, far in ((backwards, right), (right, backwards)):
        if len(near) < 2 or near[0] not in near[1:]:
            continue
        for q, held in _periods(_shared(near), exponent):
            more = 0
            while more < len(far) and far[more] == (near[q - 1 - more] if more < q else far[more - q]):
                more += 1
            if more and held + more >= max(least, exponent * q):
                found.add((middle - held if near is backwards else middle - more, held + more, q))
    return list(found)


def grammar_runs(words: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """All runs of a list of word numbers, by start, then period. ``exponent`` is at least 4."""
    fresh = max(words, default=0) + 1
    last, rules = re_pair(words, fresh)
    sizes = [1] * fresh + [0] * len(rules)
    for k, (a, b) in enumerate(rules):
        sizes[fresh + k] = sizes[a] + sizes[b]
    places: dict[int, list[int]] = defaultdict(list)
    bounds = [0]
    for symbol in last:
        if symbol >= fresh:
            places[symbol].append(bounds[-1])
        bounds.append(bounds[-1] + sizes[symbol])
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for symbol in range(fresh + len(rules) - 1, fresh - 1, -1):
        a, b = rules[symbol - fresh]
        at, size = places.pop(symbol), sizes[a]
        if a >= fresh:
            places[a] += at
        if b >= fresh:
            places[b] += [p + size for p in at]
        first = at[0]
        for start, length, q in across(words, first, first + size, first + sizes[symbol], least, exponent):
            found[q] += [(p + start - first, length) for p in at]
    tree = [(0, len(last))]
    while tree:
        low, high = tree.pop()
        if high - low > 1:
            middle = (low + high) // 2
            tree += [(low, middle), (middle, high)]
            for start, length, q in across(words, bounds[low], bounds[middle], bounds[high], least, exponent):
                found[q].append((start, length))
    out = []
    for q, intervals in found.items():
        start, end = -1, -1
        for at, length in sorted(intervals):
            if start >= 0 and at + q <= end:
                end = max(end, at + length)
            else:
                if start >= 0:
                    out.append((start, end - start, q))
                start, end = at, at + length
        out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, starts: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch that can hold a run, in texts that begin at ``starts`` (the last entry ends the last).

    A pair of words with fewer than ``exponent - 1`` places in its stretch lies in no run: the stretch is cut between them.
    """
    at, ends = starts[:-1], starts[1:]
    number = int(words.max(initial=0)) + 1
    while True:
        long = ends - at >= least
        at, ends = at[long], ends[long]
        sizes = ends - at - 1  # pairs
        total = int(sizes.sum())
        if not total:
            return at, ends
        which = np.repeat(np.arange(len(at)), sizes)
        place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + at[which]
        pairs = words[place] * number + words[place + 1]
        if number * number * len(at) < 1 << 62:
            keys = which * (number * number) + pairs
        else:
            keys = which * total + np.unique(pairs, return_inverse=True)[1]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        kept = counts[inverse] >= exponent - 1
        if kept.all():
            return at, ends
        edge = np.flatnonzero(kept & np.concatenate([[True], ~kept[:-1] | (which[1:] != which[:-1])]))
        stop = np.flatnonzero(kept & np.concatenate([~kept[1:] | (which[1:] != which[:-1]), [True]]))
        at, ends = place[edge], place[stop] + 2


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def text_runs(texts: list[list[bytes]], least: int = LEAST, exponent: int = EXPONENT) -> list[list[Run]]:
    """Runs of each list of words, by start, then period."""
    number = _Numbers().__getitem__
    sizes = list(map(len, texts))
    words = np.fromiter((number(w) for text in texts for w in text), np.int64, sum(sizes))
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out: list[list[Run]] = [[] for _ in texts]
    low, high = stretches(words, starts, least, exponent)
    owner = np.searchsorted(starts, low, side="right") - 1
    for text, a, b in zip(owner.tolist(), low.tolist(), high.tolist(), strict=True):
        own = _Numbers()
        base = a - int(starts[text])
        out[text] += [(base + s, length, q) for s, length, q in grammar_runs([own[w] for w in words[a:b].tolist()], least, exponent)]
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def split_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` in UTF-8; none of a null text."""
    return (text or "").encode("utf-8", "replace").split()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the query's rule puts into every tenth document, by its id alone."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return (words[:a] + period * (-(-(n - a) // p)))[:n]


def _summary(runs: list[Run]) -> tuple:
    if not runs:
        return None, None, None, None
    start, length, period = runs[0]
    for s, n, q in runs[1:]:  # by start, then period, so ties stay with the first
        if n * period > length * q:
            start, length, period = s, n, q
    return start, length, period, 1000 * length // period


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST, exponent: int = EXPONENT, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, runs, collapsed`` of every whole text: runs as structs of start, length and period, and what stays.

    Null and empty texts have no runs and an empty ``collapsed``. Repeated rows are treated each; null ids stay null; other
    columns are not carried; no row is moved. ``rewrite(id, words)`` may change the words first.
    """
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    return _mapped(df, id_col, text_col, least, exponent, rewrite, "runs array<struct<start: long, length: long, period: long>>, collapsed string", [pa.list_(run), pa.string()], _plain)


def _plain(words: list[bytes], runs: list[Run]) -> tuple:
    return [{"start": s, "length": n, "period": q} for s, n, q in runs], collapsed(words, runs).decode()


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST, exponent: int = EXPONENT, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_runs``, the run of the greatest exponent, and digests of all runs and of the kept words; rows as in ``find_runs``."""
    schema = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _mapped(df, id_col, text_col, least, exponent, rewrite, schema, [pa.int64()] * 5 + [pa.string()] * 2, _digested)


def _digested(words: list[bytes], runs: list[Run]) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return len(runs), *_summary(runs), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()


def _mapped(df: DataFrame, id_col: str, text_col: str, least: int, exponent: int, rewrite: Callable | None, schema: str, types: list[pa.DataType], row: Callable) -> DataFrame:
    if exponent < 4:
        raise ValueError("runs of fewer than four periods are not looked for")
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [split_words(t) for t in batch["text"].to_pylist()]
            if rewrite is not None:
                texts = [rewrite(i, t) for i, t in zip(batch["doc_id"].to_pylist(), texts, strict=True)]
            rows_out = [row(t, r) for t, r in zip(texts, text_runs(texts, least, exponent), strict=True)]
            columns = [pa.array(values, kind) for values, kind in zip(map(list, zip(*rows_out, strict=True)), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], [str(k) for k in range(len(types) + 1)])

    return rows.mapInArrow(found, f"doc_id {dict(rows.dtypes)['doc_id']}, {schema}")
