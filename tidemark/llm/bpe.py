"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

Texts are split by the tokenizer's pattern. All new pieces of a batch are put into padded matrices by byte length. In
every round each row merges its leftmost pair of minimum rank and is compacted by one column; rows without a mergeable
pair leave the matrix. Pair ranks come from an open-addressing hash table held in two numpy arrays.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.piece_table import PieceTable, gather

NO_RANK = np.int64(1) << 40
LONG_PIECE = 256
MATRIX_CELLS = 1 << 21
ROWS_AT_ONCE = 400
#: The characters with the Unicode property White_Space, as a regex class.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of white space with what follows: no match of the tokenizers' patterns crosses such a cut.
_SEGMENTS = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


_OTHER_SPACE = re.compile(f"[{WHITE_SPACE.replace(' ', '')}]")


def _keys(text: str) -> list[str]:
    """The text's segments: a key without a space in front stands for itself with one, unless it starts a line.

    Single spaces and line ends are cut by ``str.split``; a text with any other white space by ``_SEGMENTS``.
    """
    plain = text.replace("\n", " \n")
    if "  " in plain or "\n " in plain or text[-1:].isspace() or text[:1].isspace() or _OTHER_SPACE.search(text.replace("\n", "")):
        return [f" {s}" for s in _SEGMENTS.findall(text)]
    words = plain.split(" ")
    words[0] = f" {words[0]}"
    return words


class PairHash:
    """Ranks of token pairs by linear probing; a missing pair has ``NO_RANK``."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(len(keys) * 2.5 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int64)
        slots = self._slots(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            free = self.keys[slots[waiting]] == -1
            claimed, first = np.unique(slots[waiting[free]], return_index=True)
            winners = waiting[free][first]
            self.keys[claimed], self.ranks[claimed] = keys[winners], ranks[winners]
            waiting = np.setdiff1d(waiting, winners, assume_unique=True)
            slots[waiting] = np.where(self.keys[slots[waiting]] == -1, slots[waiting], (slots[waiting] + 1) & self.mask)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Ranks for ``keys`` of any shape; a negative key has none."""
        flat = keys.reshape(-1)
        out = np.full(len(flat), NO_RANK, np.int64)
        at = np.flatnonzero(flat >= 0)
        slots = self._slots(flat[at])
        while len(at):
            there = self.keys[slots]
            hit = there == flat[at]
            out[at[hit]] = self.ranks[slots[hit]]
            more = ~hit & (there != -1)
            at, slots = at[more], (slots[more] + 1) & self.mask
        return out.reshape(keys.shape)


def _without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix with one column of every row taken out."""
    kept = np.ones(matrix.shape, bool)
    kept[np.arange(len(matrix)), column] = False
    return matrix[kept].reshape(len(matrix), matrix.shape[1] - 1)


class ByteBPE:
    """Encoder and decoder for a file of base64 tokens with ranks; a token's rank is its id."""

    def __init__(self, path: str, pattern: str):
        import public_tokenizers
        import regex

        if pattern != public_tokenizers.PATTERN:
            raise ValueError("texts are cut at white space, which is known to be right for the tokenizers' own pattern only")
        self.find = regex.compile(pattern).findall
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(self.ranks.values()) + 1
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        by_id = {rank: token for token, rank in self.ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.table = PieceTable(self._encode_keys, 600_000)

    @cached_property
    def pair_ranks(self) -> dict[int, int]:
        """Rank of every pair of tokens whose join is a token, by left * size + right."""
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        return found

    @cached_property
    def pairs(self) -> PairHash:
        found = self.pair_ranks
        return PairHash(np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.table.encode([_keys(t) for t in texts])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, joined, and where each id's bytes end."""
        return gather(self.token_bytes, self.token_starts, ids.astype(np.int64))

    def _encode_keys(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.find(k[1:] if k[:1] == " " else k if k[:1] == "\n" else f" {k}") for k in keys]
        number: dict[str, int] = {}
        which = np.fromiter((number.setdefault(p, len(number)) for pieces in split for p in pieces), np.int64)
        flat, lengths = self.encode_pieces([p.encode("utf-8", "replace") for p in number])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        ids, ends = gather(flat, starts, which)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(p) for p in split])])]
        return ids, np.diff(bounds)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, joined, and their counts."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        lengths = (whole >= 0).astype(np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # piece numbers and their ids, a matrix each
        todo = np.flatnonzero(whole < 0)
        for i in todo[sizes[todo] > LONG_PIECE]:
            ids = self._merge_long(pieces[i])
            found.append((np.array([i]), np.array([ids])))
        short = todo[sizes[todo] <= LONG_PIECE]
        short = short[np.argsort(sizes[short], kind="stable")]
        at = 0
        while at < len(short):
            narrow = sizes[short[at]]
            width = narrow if narrow < 16 else min(LONG_PIECE, int(narrow * 5 // 4))
            end = min(np.searchsorted(sizes[short], width, side="right"), at + max(1, MATRIX_CELLS // width))
            found += self._merge_bucket([pieces[i] for i in short[at:end]], short[at:end], int(sizes[short[end - 1]]))
            at = end
        for numbers, ids in found:
            lengths[numbers] = (ids >= 0).sum(axis=1)
        starts = np.cumsum(lengths) - lengths
        flat = np.empty(lengths.sum(), np.int64)
        flat[starts[whole >= 0]] = whole[whole >= 0]
        for numbers, ids in found:
            place = starts[numbers][:, None] + np.arange(ids.shape[1])
            flat[place[ids >= 0]] = ids[ids >= 0]
        return flat, lengths

    def _merge_bucket(self, pieces: list[bytes], numbers: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.where(np.arange(width) < sizes[:, None], self.byte_ids[padded], -1)
        ids = np.concatenate([ids, np.full((len(ids), 1), -1)], axis=1)  # a spare column: the last pair is never real
        ranks = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        done = []
        while len(ids):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(ids)), best]
            over = rank == NO_RANK
            if over.any():
                done.append((numbers[over], ids[over]))
                ids, ranks, numbers, best, rank = ids[~over], ranks[~over], numbers[~over], best[~over], rank[~over]
            if not len(ids):
                break
            row = np.arange(len(ids))
            ids = _without(ids, best + 1)
            ranks = _without(ranks, np.minimum(best + 1, ranks.shape[1] - 1))
            ids[row, best] = rank
            right = np.minimum(best, ranks.shape[1] - 1)
            if ranks.shape[1]:
                ranks[row, right] = self._pair_ranks(ids[row, right], ids[row, right + 1])
                left = np.maximum(best - 1, 0)
                ranks[row, left] = self._pair_ranks(ids[row, left], ids[row, left + 1])
            else:
                done.append((numbers, ids))
                break
        return done

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.look_up(np.where((left >= 0) & (right >= 0), left * self.size + right, -1))

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges for a piece too long for a matrix, by a heap of (rank, place) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before, alive = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), [True] * len(ids)
        get = self.pair_ranks.get
        heap = [(r, i) for i in range(len(ids) - 1) if (r := get(ids[i] * self.size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= len(ids) or get(ids[i] * self.size + ids[j]) != rank:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
                if (r := get(rank * self.size + ids[after[j]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := get(ids[p] * self.size + rank)) is not None:
                heapq.heappush(heap, (r, p))
        return [x for x, there in zip(ids, alive, strict=True) if there]


_CODECS: dict[tuple[str, str], ByteBPE] = {}


def codec(path: str, pattern: str) -> ByteBPE:
    """The worker's codec for a vocabulary file, built once."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBPE(path, pattern)
    return _CODECS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", *, with_decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every whole text, without special tokens; null and empty texts have no ids.

    ``with_decoded`` adds ``decoded``, the bytes that the ids stand for, made from the ids in the same pass. Repeated
    rows are encoded each; null ids stay null; other columns are not carried.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                ids = bpe.encode([t or "" for t in batch["text"].to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                more = [_decoded(bpe, lists)] if with_decoded else []
                yield pa.RecordBatch.from_arrays([batch["doc_id"], lists, *more], ["doc_id", "ids", "decoded"][: 2 + len(more)])

    return rows.mapInArrow(encoded, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>" + ", decoded binary" * with_decoded)


def _decoded(bpe: ByteBPE, ids: pa.ListArray) -> pa.Array:
    offsets = ids.offsets.to_numpy()
    flat, ends = bpe.decode(ids.values.to_numpy()[offsets[0] : offsets[-1]])
    bounds = np.concatenate([[0], ends])[offsets - offsets[0]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(flat))])


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that each list of ids stands for; a null list decodes to no bytes."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(ids_col, F.array().cast("array<int>")).alias("ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], _decoded(bpe, batch["ids"])], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(decoded, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, decoded binary")


def digest(df: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded texts."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
