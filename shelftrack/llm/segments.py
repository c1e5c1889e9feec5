"""Numbers of whole texts put together from those of their words or segments.

A tokenizer that never looks across a blank gives a word the same numbers
wherever it stands. So each distinct word is encoded once, in long joined texts,
and a text's numbers are gathered from its words'.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def parts(batch: pa.RecordBatch, most: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, each part of about ``most`` bytes of text or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def gather(first: np.ndarray, size: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows of a ragged array, and the bounds of each."""
    n = size[rows]
    bounds = np.concatenate([[0], np.cumsum(n)])
    return flat[np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[rows], n)], bounds


class Ragged:
    """Rows of numbers of different lengths, to which more are added."""

    def __init__(self, dtype):
        self.first, self.size, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, dtype)
        self.rows = self.values = 0

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.first, self.size = _room(self.first, self.rows + len(sizes)), _room(self.size, self.rows + len(sizes))
        self.flat = _room(self.flat, self.values + len(flat))
        at = slice(self.rows, self.rows + len(sizes))
        self.size[at] = sizes
        self.first[at] = self.values + np.cumsum(sizes) - sizes
        self.flat[self.values : self.values + len(flat)] = flat
        self.rows, self.values = self.rows + len(sizes), self.values + len(flat)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.first, self.size, self.flat, rows)


def _room(values: np.ndarray, n: int) -> np.ndarray:
    if n <= len(values):
        return values
    out = np.zeros(max(n, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


class Known:
    """Indexes of the values met so far; forgotten when they are too many, which costs time only."""

    def __init__(self, most: int):
        self.most, self.index = most, {}

    def look_up(self, values: pa.Array, forget: Callable[[], None], add: Callable[[list], None]) -> np.ndarray:
        """The index of each of some distinct values; ``add`` gets the new ones in the order of their indexes."""
        values = values.to_pylist()
        found = list(map(self.index.get, values))
        new = [value for value, k in zip(values, found, strict=True) if k is None]
        if new and self.index and len(self.index) + len(new) > self.most:
            self.index, new = {}, values
            forget()
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            add(new)
            found = list(map(self.index.get, values))
        return np.array(found, np.int64)
