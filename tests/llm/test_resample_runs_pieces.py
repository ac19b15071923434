"""Resampling, periodic runs and SentencePiece pieces against brute force and the library, and on edge rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm import piece_bpe, queries, resample, runs

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "ab cd " * 30_000
EDGES = [(1, "a b c d e f"), (2, None), (3, ""), (None, "a b c d e f"), (5, "x y " * 30), (5, "x y " * 30), (6, LONG), (7, " \n\t "), (8, "\x01 é 漢字 ▁ \x00 Ünï"), (9, "a" * 50_000), (10, "  two  spaces \n\n end ")]
CLASHING = ("id", "part", "nth", "able", "spread", "rank", "score", "n", "n_words", "buckets", "runs", "start", "ids", "before", "drawn")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def _features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def _resampled(docs, target, percent=25):
    features = {k: _features(t) for k, (_, t) in enumerate(docs)}
    s, t = [0] * 10000, [0] * 10000
    for counts, found in ((s, features.values()), (t, map(_features, target))):
        for _, buckets in found:
            for b in buckets:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t)]
    rows = []
    for k, (doc, _) in enumerate(docs):
        n, buckets = features[k]
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def test_resample_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_crc_resample"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(str(tuple(r)) for r in got.collect()) == _resampled(docs, target)


def test_resample_edges(spark, edges, empty):
    target = spark.createDataFrame([("a b c",), (None,), ("",)], "text string").withColumn("doc_id", F.lit("x"))
    got = [tuple(r) for r in resample.resample(edges, target, percent=90).collect()]
    assert sorted(map(str, got)) == _resampled(EDGES, ["a b c", None, ""], 90)
    assert sorted(r[4] for r in got if r[4]) == [1, 2]  # of the three documents with 20 words
    assert len(resample.resample(edges, empty).collect()) == len(EDGES)
    assert resample.resample(empty, target).collect() == []


def test_ranks_of_one_frequent_id(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit(30).alias("n_words"), F.lit(3).alias("n_features"), F.lit(0).alias("weight"), F.lit(5).alias("score"))
    got = resample.ranked(rows)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 5001))


def test_matrix_crcs_and_small_bucket_counts():
    words = [b"", b"a", b"abc", "é漢".encode(), bytes(range(256))]
    for w in words:
        assert resample.matrix_crcs(np.frombuffer(w * 3, np.uint8).reshape(3, len(w))).tolist() == [zlib.crc32(w)] * 3
    sizes, singles, doubles = resample.text_buckets(["", None, "A b", "", "c"], 7)
    assert sizes == [0, 0, 2, 0, 1] and singles.tolist() == [zlib.crc32(w) % 7 for w in (b"a", b"b", b"c")] and doubles.tolist() == [zlib.crc32(b"a b") % 7]


def _runs(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                run = w[i : j + q]
                if len(run) >= max(least, exponent * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                    out.append((i, len(run), q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _random_words(rng):
    n, kind = rng.randint(0, 90), rng.random()
    if kind < 0.3:
        return [rng.randrange(rng.choice([2, 3])) for _ in range(n)]
    if kind > 0.9:
        word = [[0], [0, 1]]
        while len(word[-1]) < n:
            word.append(word[-1] + word[-2])
        return word[-1][:n]
    out = []
    while len(out) < n:
        part = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randint(1, 9))] * rng.randint(1, 9)
        out += part[: rng.randint(1, len(part))]
    return out + [7, 8] + out if kind < 0.6 else out


@pytest.mark.parametrize("least, exponent", [(6, 4), (1, 4), (12, 5)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(12)
    for _ in range(700):
        words = _random_words(rng)
        want = _runs(words, least, exponent)
        assert runs.grammar_runs(words, least, exponent) == want
        assert runs.text_runs([[b"x"], [b"%d" % w for w in words], []], least, exponent) == [[], want, []]


def test_grammar_spells_the_words_and_repeats_no_pair():
    rng = random.Random(3)
    for _ in range(200):
        words = _random_words(rng)
        last, rules = runs.re_pair(words, 100)
        pairs = {}
        for i, pair in enumerate(zip(last, last[1:])):
            assert pairs.setdefault(pair, i) >= i - 1  # equal pairs overlap at most
        out = last
        while any(s >= 100 for s in out):
            out = [x for s in out for x in (rules[s - 100] if s >= 100 else (s,))]
        assert out == words


def _runs_row(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = _runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-(r[1] / r[2]), r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_runs_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op12_grammar_runs"](spark, SF).collect()}
    for doc, text in docs:
        assert got[doc] == _runs_row(doc, text)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_edges(spark, edges, empty):
    got = runs.find_runs(edges)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    rows = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in got.collect()}
    assert rows[5, "x y"] == [(0, 60, 2)] and rows[6, "ab cd"] == [(0, 60_000, 2)]
    assert rows[2, ""] == rows[3, ""] == rows[7, ""] == [] and rows[None, "a b c d e f"] == []
    assert got.where("doc_id = 5").count() == 2
    digested = runs.digest(edges)
    assert sorted(map(str, map(tuple, digested.where("doc_id in (1, 2, 3, 7, 8, 10)").collect()))) == sorted(str(_runs_row(d, t)) for d, t in EDGES if d in (1, 2, 3, 7, 8, 10))
    assert runs.digest(empty).collect() == [] and runs.find_runs(empty).collect() == []
    with pytest.raises(ValueError, match="four"):
        runs.find_runs(edges, exponent=3)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(library):
    bpe, rng = piece_bpe.codec(MODEL), random.Random(4)
    letters, pieces = list("abcdeing theTHE  \n▁é漢字\t\x00\U0001f600 .,"), list(bpe.ids)
    texts = ["", " ", "  ", "\n", " \n ", "\n\n a", "a\n\n\nb", "a \nb", "▁▁ x▁", "a" * 3000, " " * 500, "ab " * 1000, "\n" * 50, "the" * 900, "<s> </s> <unk> <0x41>", "\x00", "\U0001f600" * 90]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 12))).replace("▁", " ") for _ in range(4000)]
    got = [ids for k in range(0, len(texts), 500) for ids in bpe.encode(texts[k : k + 500])]
    for text, ids, want in zip(texts, got, library.encode(texts, add_bos=True, add_eos=True), strict=True):
        assert ids.tolist() == want, text
        assert bpe.decode(ids).decode() == library.decode(want)


def test_any_ids_decode_as_the_library_does(library):
    bpe, rng = piece_bpe.codec(MODEL), random.Random(5)
    for _ in range(4000):
        ids = [rng.randrange(rng.choice([3, 262, 32000])) for _ in range(rng.randint(0, 8))]
        assert bpe.decode(np.array(ids, np.int64)).decode() == library.decode(ids)


def test_failed_places_are_walked_once():
    """A long text whose longest matches fail again and again at its end takes time in proportion to its length."""
    bpe = piece_bpe.codec(MODEL)
    calls, fits = [0], bpe.fits
    text = "▁" + "ab" * 20_000
    bpe.fits = lambda a, b: calls.__setitem__(0, calls[0] + 1) or fits(a, b)
    try:
        bpe._encode_words([text])
    finally:
        bpe.fits = fits
    assert calls[0] < 20 * len(text)


def test_pieces_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op13_piece_backtracking"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_edges(spark, edges, empty, library):
    ids = piece_bpe.encode(edges, MODEL)
    assert ids.columns == ["doc_id", "ids"]
    want = sorted(str((d, library.encode(t or "", add_bos=True, add_eos=True))) for d, t in EDGES)
    assert sorted(str((r.doc_id, list(r.ids))) for r in ids.collect()) == want
    back = piece_bpe.decode(ids.unionByName(spark.createDataFrame([(99, None)], "doc_id long, ids array<int>")), MODEL)
    assert sorted(str((r.doc_id, r.decoded)) for r in back.collect()) == sorted(str((d, (t or "").replace("▁", " "))) for d, t in [*EDGES, (99, None)])
    assert piece_bpe.encode(empty, MODEL).collect() == [] and piece_bpe.digest(empty, MODEL).collect() == [] and piece_bpe.decode(piece_bpe.encode(empty, MODEL), MODEL).collect() == []


def test_other_vocabulary_kinds_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge models"):
        piece_bpe.PieceBPE(str(tmp_path / "m"))
