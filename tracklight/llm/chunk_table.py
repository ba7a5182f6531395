"""A bounded table of chunks of text and the ids that they were solved to, held by a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, repeat

import numpy as np

#: Ids one after the other, and how many each chunk has.
Ids = tuple[np.ndarray, np.ndarray]


class Generation:
    """Chunks and, per side, the ends of their ids in one flat array."""

    def __init__(self, sides: int):
        self.place: dict[str, int] = {}
        self.ends = [np.zeros(1, dtype=np.int64) for _ in range(sides)]
        self.flat = [np.empty(0, dtype=np.int32) for _ in range(sides)]

    def gather(self, side: int, places: np.ndarray) -> Ids:
        begin, ends = self.ends[side][places], self.ends[side]
        length = ends[places + 1] - begin
        after = np.cumsum(length)
        total = int(after[-1]) if len(after) else 0
        return self.flat[side][np.repeat(begin - (after - length), length) + np.arange(total)], length

    def add(self, chunks: list[str], solved: list[Ids]) -> None:
        for side, (ids, lengths) in enumerate(solved):
            self.ends[side] = np.concatenate([self.ends[side], len(self.flat[side]) + np.cumsum(lengths)])
            self.flat[side] = np.concatenate([self.flat[side], ids.astype(np.int32)])
        first = len(self.place)
        self.place.update(zip(chunks, range(first, first + len(chunks))))


class ChunkTable:
    """Ids of each known chunk on one or more sides.

    Two generations are kept: when the young one holds ``most`` chunks or ``most_ids`` ids it becomes the old one, and what is met
    again moves from there, so that frequent chunks stay. ``solve`` maps a list of new chunks to their ids on each side.
    """

    def __init__(self, sides: int, solve: Callable[[list[str]], list[Ids]], most: int = 150_000, most_ids: int = 1 << 20):
        self.sides, self.solve, self.most, self.most_ids = sides, solve, most, most_ids
        self.young, self.old = Generation(sides), Generation(sides)

    def places(self, chunks: list[str]) -> np.ndarray:
        """The places of the chunks, which ``gather`` takes; new ones are solved first. Good until the next call."""
        if len(self.young.place) > self.most or any(len(flat) > self.most_ids for flat in self.young.flat):
            self.young, self.old = Generation(self.sides), self.young
        place = np.fromiter(map(self.young.place.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(place < 0).tolist()
        if new:
            unknown = [chunks[i] for i in new]
            missing = list(dict.fromkeys(unknown))
            was = list(map(self.old.place.get, missing))
            again = [c for c, p in zip(missing, was) if p is not None]
            if again:
                kept = np.array([p for p in was if p is not None], dtype=np.int64)
                self.young.add(again, [self.old.gather(side, kept) for side in range(self.sides)])
            fresh = [c for c, p in zip(missing, was) if p is None]
            if fresh:
                self.young.add(fresh, self.solve(fresh))
            place[new] = list(map(self.young.place.__getitem__, unknown))
        return place

    def gather(self, side: int, places: np.ndarray) -> Ids:
        """The ids of all the chunks one after the other, and how many each has."""
        return self.young.gather(side, places)


def flat_ids(lists: list[list[int]]) -> Ids:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths


def joined(lists: Iterable[list[str]]) -> tuple[list[str], np.ndarray]:
    """All chunks of some texts one after the other, and how many each text has."""
    lists = list(lists)
    return list(chain.from_iterable(lists)), np.array([len(own) for own in lists], dtype=np.int64)


def per_text(lengths: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Ids per text from ids per chunk and chunks per text."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return np.diff(sums[np.concatenate([[0], np.cumsum(chunks)])])
