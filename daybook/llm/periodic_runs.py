"""Periodic runs of words, found with a recompression grammar.

A run is a stretch of at least ``min_words`` words and ``min_repeats`` periods,
words one (smallest) period apart being equal, that no neighbouring word extends.
Every run of period q covers a multiple of (min_repeats - 1) * q together with the
word q further on, so pairs on these harmonic grids are the only candidates: about
n log n of them in a text of n words. Most differ at once. For the others a
grammar is built by recompression: turns of block compression (a stretch of one
symbol becomes a symbol that knows its length) and pair compression (symbols are
dealt to two sides, and each left symbol followed by a right one becomes a pair) until few
symbols are left. Equal stretches of text get equal symbols but for their rims, so
that the longest common extension of two places climbs and descends the levels
once; forwards and backwards it gives a candidate's whole run.

Defined results: NULL text has no words; a NULL id stays NULL; equal rows are
treated one by one; texts of any length are read whole, their words compared
as they are (no hashes); an empty table gives no rows. Only the id and
the text are read, so other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

MIN_REPEATS = 4
MIN_WORDS = 6
SLICE_BYTES = 2_000_000
#: Candidate pairs looked at together.
PAIRS_AT_ONCE = 2_000_000
#: A level of so few symbols is not compressed further.
TOP_SYMBOLS = 8

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each different pair."""
    keys = left.astype(np.int64) * (int(right.max()) + 1) + right
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def sides(symbols: np.ndarray) -> np.ndarray:
    """A side (0 or 1) for each symbol, such that many left ones stand before right ones.

    Neighbours differ. A few deals by different hashes are tried both ways round;
    one such deal makes pairs of a quarter of all neighbours on average. The last
    resort makes a pair of the first two symbols.
    """
    kinds = np.arange(int(symbols.max()) + 1, dtype=np.uint64)
    best, most = (kinds != symbols[0]).astype(np.int8), 1
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        with np.errstate(over="ignore"):
            side = (((kinds + np.uint64(1)) * np.uint64(factor)) >> np.uint64(63)).astype(np.int8)
        step = np.diff(side[symbols])
        for sign in (1, -1):
            pairs = int(np.count_nonzero(step == sign))
            if pairs > most:
                best, most = side if sign == 1 else 1 - side, pairs
    return best


class Grammar:
    """Run-length grammar of a sequence by recompression, with longest common extensions.

    The first and the last symbol must occur nowhere else. Level 0 is the sequence;
    ``first[d][k]`` is the first child, one level down, of symbol k of level d.
    """

    def __init__(self, sequence: np.ndarray):
        symbols = np.unique(sequence, return_inverse=True)[1].reshape(-1)
        self.symbols, self.parents, self.first, self.blocks = [], [], [memoryview(b"")], [False]
        block = True
        while True:
            self.symbols.append(memoryview(symbols.astype(np.int32)))
            if len(symbols) <= TOP_SYMBOLS:
                break
            starts, block_level = self._blocks(symbols), True
            if not block or len(starts) == len(symbols):
                starts, block_level = self._pairs(symbols), False
            ends = np.append(starts[1:], len(symbols))
            if block_level:
                longer = ends - starts
            else:
                longer = np.where(ends - starts == 2, symbols[ends - 1] + 1, 0)
            parents = np.zeros(len(symbols), np.int32)
            parents[starts[1:]] = 1
            self.parents.append(memoryview(np.cumsum(parents, dtype=np.int32)))
            self.first.append(memoryview(np.append(starts, len(symbols)).astype(np.int32)))
            self.blocks.append(block_level)
            symbols = named(symbols[starts], longer)
            block = not block_level
        self.top = len(self.symbols) - 1

    @staticmethod
    def _blocks(symbols: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.flatnonzero(np.diff(symbols)) + 1))

    @staticmethod
    def _pairs(symbols: np.ndarray) -> np.ndarray:
        side = sides(symbols)[symbols]
        starts = np.ones(len(symbols), bool)
        starts[1:] = ~((side[:-1] == 0) & (side[1:] == 1))
        return np.flatnonzero(starts)

    def forward(self, i: int, j: int) -> int:
        """How many symbols from places i < j on are equal."""
        symbols, parents, first, blocks, top = self.symbols, self.parents, self.first, self.blocks, self.top
        depth, a, b = 0, i, j
        while True:
            while depth < top:
                pa_, pb = parents[depth][a], parents[depth][b]
                above = first[depth + 1]
                if above[pa_] == a and above[pb] == b and symbols[depth + 1][pa_] == symbols[depth + 1][pb]:
                    depth, a, b = depth + 1, pa_, pb
                else:
                    break
            if symbols[depth][a] == symbols[depth][b]:
                step = 1
                if depth < top and blocks[depth + 1]:
                    step = min(above[pa_ + 1] - a, above[pb + 1] - b)
                a, b = a + step, b + step
            elif depth == 0:
                return a - i
            else:
                a, b = first[depth][a], first[depth][b]
                depth -= 1

    def backward(self, i: int, j: int) -> int:
        """How many symbols from places i < j back are equal, these included."""
        symbols, parents, first, blocks, top = self.symbols, self.parents, self.first, self.blocks, self.top
        depth, a, b = 0, i, j
        while True:
            while depth < top:
                pa_, pb = parents[depth][a], parents[depth][b]
                above = first[depth + 1]
                if above[pa_ + 1] == a + 1 and above[pb + 1] == b + 1 and symbols[depth + 1][pa_] == symbols[depth + 1][pb]:
                    depth, a, b = depth + 1, pa_, pb
                else:
                    break
            if symbols[depth][a] == symbols[depth][b]:
                step = 1
                if depth < top and blocks[depth + 1]:
                    step = min(a - above[pa_], b - above[pb]) + 1
                a, b = a - step, b - step
            elif depth == 0:
                return i - a
            else:
                a, b = first[depth][a + 1] - 1, first[depth][b + 1] - 1
                depth -= 1


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All sequences in one, with symbols of their own around each; and where each starts.

    Three such symbols stand at both ends, so that looking two places too far stays inside.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes + 2
    out = -1 - np.arange(int(starts[-1] + sizes[-1]) + 3, dtype=np.int64)
    for start, text in zip(starts.tolist(), texts):
        out[start : start + len(text)] = text
    return out, starts


def candidates(
    sequence: np.ndarray, starts: np.ndarray, sizes: np.ndarray, repeats: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of pairs on the grids that may lie in a run, by text, period and place.

    A run of period q holds at least (repeats - 1) * q consecutive places x whose words x
    and x + q are equal, among them a place of the grid. Pairs that cannot be in
    so long a stretch, seen by the two neighbours or by the places q and 2q off, are left out.
    """
    periods = sizes // repeats
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (repeats - 1) * period
    points = (sizes[text] - 1 - period) // step + 1
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, side="right")))
        count = points[at:stop]
        t, q = np.repeat(text[at:stop], count), np.repeat(period[at:stop], count)
        x = (np.arange(len(t)) - np.repeat(ends[at:stop] - count - base, count)) * np.repeat(step[at:stop], count)
        at = stop
        place = starts[t] + x

        def equal(offset):
            return sequence[place + offset] == sequence[place + offset + q]

        def narrowed(keep):
            return t[keep], q[keep], x[keep], place[keep]

        t, q, x, place = narrowed(equal(0))
        if repeats >= 4:  # at least three equal places in a row
            after, before = equal(1), equal(-1)
            t, q, x, place = narrowed((after & before) | (after & equal(2)) | (before & equal(-2)))
            limit = sizes[t] - q

            def at_period(k):
                y = x + k * q
                inside = (y >= 0) & (y < limit)
                y = starts[t] + np.where(inside, y, 0)
                return inside & (sequence[y] == sequence[y + q])

            after, before = at_period(1), at_period(-1)
            t, q, x, place = narrowed((after & before) | (after & at_period(2)) | (before & at_period(-2)))
        yield t, x, q


class Found:
    """Runs of one text by period, each period's in order of their starts."""

    def __init__(self):
        self.by_period: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        starts, ends = self.by_period.setdefault(period, ([], []))
        starts.append(start)
        ends.append(end)

    def covers(self, place: int, period: int) -> bool:
        """The ``period`` words from ``place`` on lie in a run whose period divides it."""
        for shorter, (starts, ends) in self.by_period.items():
            if period % shorter == 0:
                k = bisect_right(starts, place) - 1
                if k >= 0 and ends[k] >= place + period:
                    return True
        return False

    def rows(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        return sorted((s, e - s, q) for q, (starts, ends) in self.by_period.items() for s, e in zip(starts, ends))


def find_runs(texts: list[np.ndarray], repeats: int = MIN_REPEATS, min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each sequence of symbols >= 0.

    Periods are tried in ascending order. A stretch whose period is a multiple of
    a shorter one is part of a run found before, which is how it is told; a stretch met
    once is not measured again from later places of its grid.
    """
    if repeats < 2:
        raise ValueError("A run has at least two periods.")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list[list] = [[] for _ in texts]
    if not len(texts) or sizes.max() < repeats:
        return out
    sequence, starts = laid_out(texts)
    parts = [np.column_stack(part) for part in candidates(sequence, starts, sizes, repeats)]
    pairs = np.concatenate(parts)
    if not len(pairs):
        return out
    with_pairs = np.unique(pairs[:, 0])
    sequence, starts = laid_out([texts[t] for t in with_pairs])
    grammar = Grammar(sequence)
    bounds = np.searchsorted(pairs[:, 0], with_pairs, side="left").tolist() + [len(pairs)]
    for k, t in enumerate(with_pairs.tolist()):
        base, found = int(starts[k]), Found()
        measured, until = 0, 0
        for _, x, q in pairs[bounds[k] : bounds[k + 1]].tolist():
            if q != measured:
                measured, until = q, 0
            if x < until or found.covers(x, q):
                continue
            place = base + x
            after = grammar.forward(place, place + q)
            before = grammar.backward(place - 1, place + q - 1)
            until = x + after
            length = before + after + q
            if length >= max(min_words, repeats * q):
                found.add(x - before, x - before + length, q)
        out[t] = found.rows()
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def collapse_runs(
    docs: DataFrame, repeats: int = MIN_REPEATS, min_words: int = MIN_WORDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every document.

    ``runs`` holds (start, length, period) in words, numbered from 0, by start and
    period; ``collapsed`` is the text whose words are in no run after that run's
    first period, joined by one space. A document is read by one task and nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def find(batches):
        for batch in batches:
            for part, texts in slices(batch, "text", SLICE_BYTES):
                known: dict[bytes, int] = {}
                number = known.setdefault
                words = [t.split() for t in texts]
                numbers = [np.fromiter((number(w, len(known)) for w in ws), np.int64, len(ws)) for ws in words]
                every = find_runs(numbers, repeats, min_words)
                for i, runs in enumerate(every):
                    if runs:
                        words[i] = [words[i][k] for k in np.flatnonzero(kept_words(len(words[i]), runs)).tolist()]
                flat = np.asarray([r for runs in every for r in runs], np.int64).reshape(-1, 3)
                fields = [pa.array(c) for c in np.ascontiguousarray(flat.T)]
                ends = np.concatenate(([0], np.cumsum([len(runs) for runs in every]))).astype(np.int32)
                listed = pa.ListArray.from_arrays(
                    pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(n) for n in numbers], pa.int64()), listed,
                     pa.array([b" ".join(w) for w in words], pa.binary())],
                    ["id", "n_words", "runs", "collapsed"])

    found = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        find, f"id {kind}, n_words bigint, runs {RUNS}, collapsed binary")
    return found.select(F.col("id").alias(id_column), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
