"""Helpers for tasks that read Arrow batches: byte slices, word hashes, work tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from daybook.sources.session import stored  # noqa: F401

SLICE_BYTES = 4_000_000
KNOWN_WORDS = 300_000


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch holding about ``size`` bytes of ``column``, with those bytes per row.

    A NULL is read as empty. A row longer than ``size`` is a part of its own.
    """
    texts = batch.column(column).cast(pa.binary())
    # Lengths are read from the offsets: no more than a part's texts become Python objects at a time.
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start), [t or b"" for t in texts.slice(start, stop - start).to_pylist()]
        start = stop


class WordHashes(dict):
    """64-bit hashes of words, computed once each; forgotten when too many are held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that their order is unrelated to the input."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values, by starting position; runs are joined from halves."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    out, out_size = None, 0
    power, power_size = hashes, 1
    with np.errstate(over="ignore"):
        while True:
            if size & power_size:
                if out is None:
                    out = power
                else:
                    n = min(len(out), len(power) - out_size)
                    out = out[:n] * np.uint64(pow(factor, power_size, 1 << 64)) + power[out_size : out_size + n]
                out_size += power_size
            if out_size == size:
                return mixed(out[: len(hashes) - size + 1])
            n = len(power) - power_size
            power = power[:n] * np.uint64(pow(factor, power_size, 1 << 64)) + power[power_size:]
            power_size *= 2


def minimizers(order: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the leftmost least value of each run of ``width`` values.

    Returns (place, first run, last run) for each place; every run belongs to one
    place, and runs with the same values pick the same place in them. Places are
    picked by the upper bits first; where these hide a smaller value, all are
    picked again by whole values.
    """
    n = len(order)
    if n < width:
        return (np.empty(0, np.int64),) * 3
    bits = np.uint64(max(16, int(n).bit_length()))
    marked = (order >> bits << bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = marked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    runs = n - width + 1
    place = (np.minimum(behind[:runs], ahead[width - 1 : width - 1 + runs]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    chosen, first, last = _by_place(place)
    ends = np.append(order, np.iinfo(np.uint64).max)
    least = np.minimum.reduceat(ends, np.column_stack((first, last + width)).ravel())[::2]
    if (least != order[chosen]).any():
        every = np.lib.stride_tricks.sliding_window_view(order, width)
        step = max(1, 10_000_000 // width)
        place = np.concatenate([every[a : a + step].argmin(axis=1) + np.arange(a, min(a + step, runs)) for a in range(0, runs, step)])
        chosen, first, last = _by_place(place)
    return chosen, first, last


def _by_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
    return place[first], first, np.concatenate((first[1:], [len(place)])) - 1
