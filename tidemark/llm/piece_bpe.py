"""Encoding and decoding with a SentencePiece model of merge type, by backtracking over longest matches.

A text's pieces are the only split in which every two neighbours are *compatible*: merging the characters of both
together, best score first and leftmost among equals, gives these two pieces again. (Merges inside a stretch that no
merge crosses do not depend on what lies around it, so the split of the whole text and of each pair agree.) The split
is therefore found from left to right without merging the text: an Aho-Corasick automaton gives the longest piece that
starts at each place; a piece that does not fit its left neighbour gives way to its longest proper prefix in the
vocabulary; where none is left, the place is marked in a bitfield as failed and the piece before it is shortened. A
prefix of the text has one valid split only, so a failed place fails whatever led to it, and each place fails once at
most.

Texts are cut before spaces and line ends first if the vocabulary allows it: no piece may hold a space mark after another
character, or a line end.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.piece_table import PieceTable
from tidemark.llm.slices import slices

SPACE = "▁"
WORDS_KEPT = 400_000
PAIRS_KEPT = 600_000
#: A text with a longer word is encoded where it stands and its words are not kept, so that the table's memory is bounded.
LONGEST_KEPT = 64
_RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n[^{SPACE}\n]*")

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceBPE:
    """Encoder and decoder for a SentencePiece BPE model file with byte fallback and without a normal form."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds, normal, trainer = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec, model.trainer_spec
        known = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix or not normal.escape_whitespaces or trainer.treat_whitespace_as_suffix or any(p.type not in known for p in model.pieces):
            raise ValueError("only merge models with byte fallback, a space in front and no normal form are known")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.byte_ids = [next(i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE and p.piece == f"<0x{b:02X}>") for b in range(256)]
        self.ends = trainer.bos_id, trainer.eos_id
        self.control = np.array([p.type == kinds.CONTROL for p in model.pieces])
        self.spaced = np.array([p.type == kinds.NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        shown = {kinds.NORMAL: lambda p: p.piece.replace(SPACE, " ").encode(), kinds.CONTROL: lambda p: b"", kinds.UNKNOWN: lambda p: trainer.unk_surface.encode(), kinds.BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
        self.shown = [shown[p.type](p) for p in model.pieces]
        own = [p for p in self.ids if self.merge(p) == [p]]  # pieces that merging can reach
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in own_set), p[0]) for own_set in [set(own)] for p in own if len(p) > 1}
        self.automaton = ahocorasick.Automaton()
        for p in own:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.cuts = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)
        held = {c for p in self.ids for c in p}
        self.gap = next(chr(c) for c in range(128) if chr(c) not in held)  # a character in no piece
        self.fitting: dict[tuple[str, str], bool] = {}
        self.table = PieceTable(self._encode_words, WORDS_KEPT)

    def merge(self, text: str) -> list[str]:
        """What merging gives: always the best score, among equals the leftmost. For texts of a few dozen characters."""
        parts = list(text)
        score = self.scores.get
        ranks = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, r in enumerate(ranks):
                if r is not None and (best is None or r > best):
                    best, at = r, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = score(parts[at] + parts[at + 1])

    def fits(self, left: str, right: str) -> bool:
        """Whether merging both pieces' characters together gives the two pieces again."""
        found = self.fitting.get((left, right))
        if found is None:
            if len(self.fitting) >= PAIRS_KEPT:
                self.fitting.clear()
            found = self.fitting[left, right] = self.merge(left + right) == [left, right]
        return found

    def split(self, text: str, longest: list[int], base: int = 0) -> list[str]:
        """The pieces of ``text``; ``longest[base + k]`` is the length of the longest piece that starts at k (0: none)."""
        n, at, pieces = len(text), 0, []
        failed = bytearray((n >> 3) + 1)
        piece = text[: longest[base] or 1]
        while True:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1 and (not pieces or self.fits(pieces[-1], piece)):
                pieces.append(piece)
                if end == n:
                    return pieces
                at, piece = end, text[end : end + (longest[base + end] or 1)]
                continue
            while (shorter := self.shorter.get(piece)) is None:
                failed[at >> 3] |= 1 << (at & 7)
                piece = pieces.pop()
                at -= len(piece)
            piece = shorter

    def words(self, text: str) -> list[str]:
        """The text's parts that are encoded apart. One that starts with neither a space mark nor a line end has a space before it."""
        if not text:
            return []
        if not self.cuts:
            return [f" {text}".replace(" ", SPACE)]
        if "  " in text or text[0] == " " or SPACE in text:
            return _RUNS.findall(f" {text}".replace(" ", SPACE))
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the begin and end ids."""
        begin, end = np.array([self.ends[0]], np.int32), np.array([self.ends[1]], np.int32)
        return [np.concatenate([begin, ids, end]) for ids in self._encode_split([self.words(t) for t in texts])]

    def _encode_split(self, split: list[list[str]]) -> list[np.ndarray]:
        longest = [max(map(len, words), default=0) for words in split]
        if max(longest, default=0) <= LONGEST_KEPT:
            return self.table.encode(split)
        known = self.table.encode([[] if size > LONGEST_KEPT else words for words, size in zip(split, longest, strict=True)])
        return [self._encode_words(words)[0].astype(np.int32) if size > LONGEST_KEPT else ids for words, size, ids in zip(split, longest, known, strict=True)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, joined, and their counts; the automaton runs over all of them at once."""
        spelt = [w if w[:1] in (SPACE, "\n") and w else SPACE + w for w in words]
        joined = self.gap.join(spelt)
        longest = [0] * (len(joined) + 1)
        for end, length in self.automaton.iter(joined):
            longest[end - length + 1] = length  # ends ascend, so the longest comes last
        flat: list[int] = []
        lengths = np.zeros(len(words), np.int64)
        base, ids, byte_ids = 0, self.ids, self.byte_ids
        for k, word in enumerate(spelt):
            before = len(flat)
            pieces = self.split(word, longest, base)
            try:
                flat += [ids[p] for p in pieces]
            except KeyError:  # characters outside the vocabulary are spelt in bytes
                for p in pieces:
                    flat += [ids[p]] if p in ids else [byte_ids[b] for b in p.encode("utf-8", "replace")]
            lengths[k] = len(flat) - before
            base += len(word) + 1
        return np.array(flat, np.int64), lengths

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8: control ids vanish, the first piece loses its space, every wrong byte is U+FFFD."""
        stops = np.flatnonzero(self.control[ids])
        parts = [p for p in np.split(ids, stops) if len(p)]  # each but perhaps the first starts with a control id
        shown = self.shown.__getitem__
        texts = [b"".join(map(shown, p.tolist())).decode("utf-8", "each_byte") for p in parts]
        seen = ids[~self.control[ids]]
        return "".join(texts)[int(len(seen) > 0 and self.spaced[seen[0]]) :].encode()


_CODECS: dict[str, PieceBPE] = {}


def codec(path: str) -> PieceBPE:
    """The worker's codec for a model file, built once."""
    if path not in _CODECS:
        _CODECS[path] = PieceBPE(path)
    return _CODECS[path]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every whole text with begin and end ids; null and empty texts have these two only.

    Repeated rows are encoded each; null ids stay null; other columns are not carried. No row is moved.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = codec(path).encode([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], _lists(ids)], ["doc_id", "ids"])

    return rows.mapInArrow(encoded, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded``: the text that each list of ids stands for; a null list decodes to an empty text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(ids_col, F.array().cast("array<int>")).alias("ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(np.array(ids, np.int64)).decode() for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(decoded, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, decoded string")


def digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded and decoded again in one pass.

    The ids are digested as little-endian unsigned 32-bit integers. Nulls and repeated rows as in ``encode``.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bpe = codec(path)
            ids = bpe.encode([t or "" for t in batch["text"].to_pylist()])
            hashes = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]
            texts = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]
            columns = [batch["doc_id"], pa.array([len(x) for x in ids], pa.int64()), pa.array(hashes), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(digested, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
