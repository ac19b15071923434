"""Token packing by vector best-fit.

Every piece is a vector of tokens, documents (one) and attention cost (length squared); every sequence has a capacity
in each dimension. Pieces are taken longest first; each goes to the open sequence that fits it in every dimension and
has the best score: the largest dot-product of the piece with the residual capacity under inverse weights
("dot_product"), or the smallest weighted norm of what would be left ("residual_norm", the default).

All three dimensions weigh in the score. By default the limits on documents and attention cost bind no earlier than the
tokens do, as every tighter limit costs sequences; on given tables the number of sequences is then the least possible or one
more for each group.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.durable import durable
from tidemark.llm.piece_table import PieceTable
from tidemark.llm.slices import give_back

CAPACITY = 4096
GROUP_TOKENS = 8_000_000
GROUP_PIECES = 40_000
WEIGHTS = (1.0, 0.5, 0.5)
WORDS_KEPT = 500_000
MARK = "\x01"
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORD_END = "</w>"
LOWER = "a-zß-öø-ÿ"
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch  # printable ASCII and the letters of Latin-1
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Ids of whole texts by a Hugging Face tokenizer file, one call for each new word and tables for the rest.

    The tokenizer drops white space, and its normaliser and pre-tokenizer never look across it, so a text's ids are
    its words' ids in order. The four information separators are white space to ``str.split`` but not to the
    tokenizer: texts that hold one are cut at plain white space only.

    Marks such as an end-of-text token stand for their ids wherever they occur, as the library has it by default; words
    that hold one go through the whole tokenizer alone.

    If the file cuts lower-cased words by a pattern and no more, new words of printable ASCII and Latin-1 letters, which
    normal forms leave alone, are cut here by that pattern, so that "Word" and "word," share a piece; a copy of the tokenizer that
    only merges gives the pieces' ids, and the word-end mark of its tokens tells where a piece ends. All other words go
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark_id,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if any(re.search(r"\s", token) for token in added):
            raise ValueError("marks that hold white space are not known")
        self.marked = re.compile("|".join(map(re.escape, [MARK, *added]))).search
        firsts = {token[0] for token in added}
        self.first = firsts.pop() if len(firsts) == 1 else ""
        self.cut = _word_pattern(path)
        self.merger = Tokenizer.from_file(path)
        self.merger.encode_special_tokens = True
        bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.merger.normalizer, self.merger.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_only])
        vocabulary = self.merger.get_vocab(with_added_tokens=True)
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.table = PieceTable(self._encode_words, WORDS_KEPT)
        self.pieces = PieceTable(self._encode_pieces, WORDS_KEPT)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.table.encode([[w for w in re.split("[ \\t\\r\\n]+", t) if w] if _SEPARATORS.search(t) else t.split() for t in texts])

    def forget(self) -> None:
        """Drop the tables of known words and pieces; they fill again from the next texts."""
        self.table.clear()
        self.pieces.clear()

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.cut is None:
            return self._tokenize(words)
        return self.pieces.encode_joined([self.cut(w.lower()) if self._simple(w) else [w] for w in words])

    def _simple(self, word: str) -> bool:
        return _SIMPLE(word) is not None and not (self.first in word and self.marked(word))

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, joined, and their counts."""
        simple = np.fromiter(map(self._simple, pieces), bool, len(pieces))
        lengths = np.zeros(len(pieces), np.int64)
        merged, lengths[simple] = self._merge([p for p, s in zip(pieces, simple, strict=True) if s])
        others, lengths[~simple] = self._tokenize([p for p, s in zip(pieces, simple, strict=True) if not s])
        of_simple = np.repeat(simple, lengths)
        ids = np.empty(len(of_simple), np.int64)
        ids[of_simple], ids[~of_simple] = merged, others
        return ids, lengths

    def _merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = self.merger.encode_batch_fast([" ".join(pieces[k : k + 500]) for k in range(0, len(pieces), 500)], add_special_tokens=False)
        ids = np.array([i for e in encoded for i in e.ids], np.int64)
        return ids, np.diff(np.flatnonzero(self.ends_piece[ids]), prepend=-1)

    def _tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words go in one text with a mark between them: a call for each costs more."""
        marked = [self.marked(w) is not None for w in words]
        plain = [w for w, m in zip(words, marked, strict=True) if not m]
        chunks = [plain[k : k + 500] for k in range(0, len(plain), 500)]
        encoded = self.tokenizer.encode_batch_fast([f" {MARK} ".join([*c, ""]) for c in chunks], add_special_tokens=False)
        ids = np.array([i for e in encoded for i in e.ids], np.int64)
        ends = np.flatnonzero(ids == self.mark_id)
        lengths = np.diff(ends, prepend=-1) - 1
        ids = ids[ids != self.mark_id]
        if len(plain) == len(words):
            return ids, lengths
        alone = [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast([w for w, m in zip(words, marked, strict=True) if m], add_special_tokens=False)]
        rest, others = iter(np.split(ids, np.cumsum(lengths)[:-1])), iter(alone)
        each = [next(others if m else rest) for m in marked]
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))


def _word_pattern(path: str):
    """How the tokenizer file cuts a word of lower-case letters, digits and signs, or None if it does more than cut by a pattern."""
    import regex

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    normal, before = described.get("normalizer") or {}, described.get("pre_tokenizer") or {}
    normals, steps = normal.get("normalizers", [normal]), before.get("pretokenizers", [before])
    split, kinds = steps[0], {n.get("type") for n in normals}
    cuts = split.get("type") == "Split" and "Regex" in split.get("pattern", {}) and split.get("behavior") == "Removed" and split.get("invert")
    bytes_only = [s.get("type") for s in steps[1:]] == ["ByteLevel"] and not steps[1].get("use_regex")
    space_only = all(n["pattern"] == {"Regex": "\\s+"} for n in normals if n.get("type") == "Replace")
    if not (cuts and bytes_only and space_only and "Lowercase" in kinds and kinds <= {"NFC", "Replace", "Lowercase"} and described["model"].get("end_of_word_suffix") == _WORD_END):
        return None
    pattern = split["pattern"]["Regex"]
    whole = regex.compile(pattern).findall
    try:  # the same for the characters of simple words, in the faster module
        plain = re.compile(pattern.replace(r"\p{L}", LOWER).replace(r"\p{N}", "0-9")).findall
    except re.error:
        return whole
    tried = "aßé09'-.,<|sltrevdm"
    return plain if all(plain(x + y + z) == whole(x + y + z) for x in tried for y in tried for z in tried) else whole


_ENCODERS: dict[str, WordEncoder] = {}


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, with ``with_ids``, the piece's ``ids``.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut, every ``capacity`` tokens.
    A null or empty text is the end id alone. Repeated rows give repeated pieces. Other columns are not carried.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer_path) or _ENCODERS.setdefault(tokenizer_path, WordEncoder(tokenizer_path))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                out: list[tuple] = []
                texts = [t or "" for t in batch["text"].to_pylist()]
                for doc, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(texts), strict=True):
                    ids = np.append(ids, np.int32(end_id))
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((doc, k, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), part))
                docs, ks, starts, lengths, crcs, parts = zip(*out, strict=True)
                columns = [pa.array(docs, pa.int64()), pa.array(ks, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return rows.mapInArrow(pieces, PIECE_SCHEMA + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacities: tuple[float, float, float], weights: tuple[float, float, float] = WEIGHTS, rule: str = "residual_norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and token offset of each piece, for pieces given in the order in which they are to be placed.

    ``capacities`` and ``weights`` stand for tokens, documents and attention cost. Ties go to the oldest sequence. A
    piece beyond a capacity by itself gets a sequence of its own.
    """
    cap, w = np.asarray(capacities, float), np.asarray(weights, float)
    left = np.zeros((max(1, len(lengths)), 3))
    open_bins = np.zeros(0, np.int64)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = np.zeros(len(left), np.int64)
    n = 0
    for i, length in enumerate(lengths.tolist()):
        item = np.array([length, 1.0, float(length) * length])
        room = left[open_bins]
        fits = np.flatnonzero((room >= item).all(axis=1)) if len(open_bins) else ()
        if len(fits):
            if rule == "dot_product":
                best = fits[np.argmax(-(room[fits] / cap) @ (w * item / cap))]  # least room along the piece: fullest first
            else:
                best = fits[np.argmin((((room[fits] - item) / cap) ** 2) @ w)]
            b = open_bins[best]
        else:
            b, n = n, n + 1
            left[b] = cap
            if (item < cap).all():
                open_bins = np.append(open_bins, b)
            best = -1
        sequence[i], offset[i] = b, used[b]
        used[b] += length
        left[b] -= item
        if len(open_bins) and open_bins[best] == b and (left[b] <= 0).any():
            open_bins = np.delete(open_bins, best)
    return sequence, offset


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, max_docs: int | None = None, max_attention: float | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = "residual_norm", group_tokens: int = GROUP_TOKENS, group_pieces: int = GROUP_PIECES, seed: int = 9) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a durable table of pieces.

    Pieces are dealt by a seeded hash into groups of about ``group_tokens`` tokens, each packed in one task, so the
    work and the memory of a task are the same at any size; a group leaves about one sequence unfilled. Without
    ``max_docs`` and ``max_attention`` those dimensions never bind below ``capacity`` tokens.
    """
    total = pieces.agg(F.sum("length").alias("t"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, -(-(total["t"] or 0) // group_tokens), -(-total["n"] // group_pieces))
    capacities = (float(capacity), float(max_docs or capacity), float(max_attention or capacity**2))
    dealt = pieces.withColumn("bin_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = best_fit(pdf["length"].to_numpy(), capacities, weights, rule)
        return pdf.assign(sequence_id=pdf["bin_group"] * (1 << 32) + sequence, offset=offset).drop(columns="bin_group")

    return dealt.groupBy("bin_group").applyInPandas(place, PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pieces of all documents with their sequences; see ``token_pieces`` and ``pack``."""
    return pack(durable(token_pieces(df, tokenizer_path, id_col, text_col, capacity=options.get("capacity", CAPACITY), with_ids=False)), **options)


def vocabulary_size(path: str) -> int:
    """Entries in a tokenizer file, for tests."""
    return len(json.load(open(path))["model"]["vocab"])
