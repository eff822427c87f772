"""Removal of byte strings that stand twice, by interval expansion on a Burrows-Wheeler transform.

The contexts of a task are one text, with a symbol of its own after each. Sorting its
suffixes by doubling tells rows apart that differ in their first 128 bytes. From
there its Burrows-Wheeler transform is expanded breadth first: extending all
intervals backward by one byte bounds those of the next depth, so that common
prefixes of neighbouring rows are found by increasing value.
The expansion stops at the least length: boundaries that are still open join rows
whose strings of that length stand elsewhere, and every byte of these is covered.

Defined results: NULL is the empty text, of which nothing is removed; a text shorter
than the least length stays whole; equal rows lose all strings that are long enough;
matches never cross rows; texts of any length are read whole; an empty table gives no
rows. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Symbols, removed

LEAST_BYTES = 200
GRAM_BYTES = 32


def byte_values(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)


def ranked(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ranks of all suffixes by their first ``depth`` symbols or more, by doubling; those one doubling before, and by how many symbols these are.

    A suffix whose rank is its own is done; only the others are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(symbols[order])
    shared, reach = _shared(order, rank[order]), 1
    coarse, known = rank, 1
    while reach < depth and len(shared):
        coarse, known = rank.copy(), reach
        ahead = np.where(shared + reach < n, rank[np.minimum(shared + reach, n - 1)] + 1, 0)
        own = rank[shared]
        order = np.argsort(own * (n + 1) + ahead)
        shared, own, ahead = shared[order], own[order], ahead[order]
        # a group's members lie together: each gets its group's rank plus the smaller members of the group
        within = _group_starts(own * (n + 1) + ahead) - _group_starts(own)
        rank[shared] = own + within
        shared = _shared(shared, own + within)
        reach *= 2
    return rank, coarse, known


def _group_starts(values: np.ndarray) -> np.ndarray:
    """For each of some grouped values: the place where its group starts."""
    starts = np.zeros(len(values), np.int64)
    places = np.flatnonzero(values[1:] != values[:-1]) + 1
    starts[places] = places
    return np.maximum.accumulate(starts)


def _shared(suffixes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Suffixes whose rank, in this order, a neighbour has too."""
    same = ranks[1:] == ranks[:-1]
    twice = np.zeros(len(ranks), bool)
    twice[1:] = same
    twice[:-1] |= same
    return suffixes[twice]


def expand(transform: np.ndarray, bounded: np.ndarray, depth: int, least: int) -> np.ndarray:
    """For each row of the sorted suffixes: whether its common prefix with the row before is shorter than ``least``.

    ``transform`` holds the symbol before each suffix, ``bounded`` says where the
    common prefix is shorter than ``depth``. Extending rows i' < i, next to
    each other among the rows with the same symbol, backward by it gives neighbours;
    they are bounded at depth d if any boundary between i' and i is at depth d - 1.
    From one depth to the next only rows that are open still are looked at.
    """
    n = len(transform)
    row = np.argsort(transform, kind="stable").astype(np.int32)  # row[k]: the row that extends to row k
    bounded = bounded.copy()
    open_rows = np.flatnonzero(~bounded).astype(np.int32)
    low, high = row[open_rows - 1], row[open_rows]
    before = np.empty(n, np.int32)
    for _ in range(depth, least):
        np.cumsum(bounded, out=before)
        reached = before[high] > before[low]
        if not reached.any():
            break
        bounded[open_rows[reached]] = True
        left = ~reached
        open_rows, low, high = open_rows[left], low[left], high[left]
    return bounded


def repeated_in(contexts: list[bytes], counts: list[int], least: int = LEAST_BYTES) -> list[list[tuple[int, int]]]:
    """Per context: byte intervals covered by strings of ``least`` bytes that start at two places or more."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    starts = np.cumsum(sizes + 1) - sizes  # a symbol of its own before each context and after the last
    text = np.frombuffer(b"\0" + b"\0".join(contexts) + b"\0", np.uint8).astype(np.int32) + len(contexts) + 1
    text[np.append(starts - 1, len(text) - 1)] = np.arange(len(contexts) + 1)
    rank, coarse, known = ranked(text, least)
    order = np.argsort(rank, kind="stable")
    bounded = np.ones(len(text), bool)
    bounded[1:] = np.diff(coarse[order]) != 0
    bounded = expand(text[order - 1], bounded, known, least)
    twice = np.zeros(len(text), bool)
    twice[order[~bounded]] = True
    twice[order[np.flatnonzero(~bounded) - 1]] = True
    out = []
    for start, size, count in zip(starts.tolist(), sizes.tolist(), counts):
        if count > 1:
            out.append([(0, size)])
            continue
        places = np.flatnonzero(twice[start : start + max(0, size - least + 1)])
        if not len(places):
            out.append([])
            continue
        cuts = np.flatnonzero(np.diff(places) > least)
        firsts = places[np.concatenate(([0], cuts + 1))]
        lasts = places[np.concatenate((cuts, [len(places) - 1]))]
        out.append([(int(a), int(b) + least) for a, b in zip(firsts, lasts)])
    return out


BYTES = Symbols(LEAST_BYTES, GRAM_BYTES, bytes, byte_values, lambda text, start, end: text[start:end])


def kept_bytes(text: bytes, spans: list[tuple[int, int]] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the intervals removed."""
    if spans is None:
        spans = [(0, len(text))] if len(text) >= LEAST_BYTES else []
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]]), spans


def digest(text: bytes, spans: list[tuple[int, int]] | None) -> tuple[int, int, int, str]:
    kept, gone = kept_bytes(text, spans)
    return len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()


def repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    schema = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return removed(docs, id_column, text_column, BYTES, repeated_in, digest, schema)


def without_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the bytes kept (cuts may fall inside a character) and the intervals removed."""

    def keep(text, spans):
        kept, gone = kept_bytes(text, spans)
        return kept, [{"start": a, "end": b} for a, b in gone]

    schema = "kept binary, gone array<struct<start:bigint,end:bigint>>"
    return removed(docs, id_column, text_column, BYTES, repeated_in, keep, schema)
