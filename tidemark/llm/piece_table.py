"""A bounded table from text pieces to their token ids, kept by a Python worker across batches."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np


class _Numbers(dict):
    """Numbers pieces in the order of their first look-up; ``fresh`` lists the new ones."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class PieceTable:
    """Ids of pieces, computed once for each new piece by ``encode_new(pieces) -> (flat ids, lengths)``.

    It is emptied when it holds ``limit`` pieces, so its memory is bounded; results do not depend on it.
    """

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1_000_000):
        self.encode_new, self.limit = encode_new, limit
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def encode(self, split: list[list[str]]) -> list[np.ndarray]:
        """For each list of pieces, the ids of all its pieces in order."""
        numbers = self._numbers(split)
        return [gather(self.flat, self.starts, n)[0] for n in numbers]

    def encode_joined(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lists, joined, and how many each list has."""
        (numbers,) = self._numbers([list(chain.from_iterable(split))])
        ids, ends = gather(self.flat, self.starts, numbers)
        upto = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return ids, np.diff(upto)

    def _numbers(self, split: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > self.limit:
            self.clear()
        number = self.known.__getitem__
        numbers = [np.fromiter(map(number, pieces), np.int64, len(pieces)) for pieces in split]
        if self.known.fresh:
            flat, lengths = self.encode_new(self.known.fresh)
            self.known.fresh = []
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return numbers


def gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``flat[starts[w]:starts[w + 1]]`` of every w, joined, and where each slice ends."""
    first, lengths = starts[which], starts[which + 1] - starts[which]
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0], ends
    return flat[np.arange(ends[-1]) + np.repeat(first - ends + lengths, lengths)], ends
