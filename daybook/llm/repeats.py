"""Where a long run of symbols of one text stands anywhere else: the distributed part.

A run (of bytes or words) of the given size is represented by its anchor, the
least-hashed short gram in it; equal runs have equal anchors. Anchors that occur
once are done. For the others the surroundings are cut out, from the first to the
last run with that anchor: a context holds exactly the runs of its anchor. Equal
contexts are merged before they are shuffled; a solver finds, among the contexts of
a group of anchors, the runs that occur twice. Results travel back to texts as
intervals.

Equal texts are worked on once; every run of a text that occurs twice is repeated.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import minimizers, slices, stored, windows

GROUP_BYTES = 400_000
#: Bytes of text whose runs are hashed at once.
TASK_BYTES = 1_500_000
#: Contexts of one anchor in a task; the runs of an anchor with more are counted by hash.
GROUP_CONTEXTS = 20_000

Solver = Callable[[list[bytes], list[int]], list[list[tuple[int, int]]]]


@dataclass(frozen=True)
class Symbols:
    """How texts are read: ``split`` gives the symbols of a text, ``hashes`` their hashes, ``cut`` a context."""

    run: int
    gram: int
    split: Callable[[bytes], object]
    hashes: Callable[[object], np.ndarray]
    cut: Callable[[object, int, int], bytes]


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def anchors(symbols: Symbols, text: bytes) -> tuple[object, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a text, places and hashes of its anchors, and the first and last run of each."""
    parts = symbols.split(text)
    grams = windows(symbols.hashes(parts), symbols.gram)
    place, first, last = minimizers(grams, symbols.run - symbols.gram + 1)
    return parts, place, grams[place], first, last


def anchor_rows(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """(anchor, key, first) for the texts (key, text); texts that a task has seen are passed over."""

    def find(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for part, raw in slices(batch, "text", TASK_BYTES):
                keys = part.column("key").to_pylist()
                found, owners, firsts = [np.empty(0, np.uint64)], [], [np.empty(0, np.int64)]
                for key, text in zip(keys, raw):
                    if key in seen:
                        continue
                    seen.add(key)
                    _, _, hashes, first, _ = anchors(symbols, text)
                    found.append(hashes)
                    firsts.append(first)
                    owners += [key] * len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(owners, pa.binary()), pa.array(np.concatenate(firsts))],
                    ["anchor", "key", "first"],
                )

    return texts.mapInArrow(find, "anchor bigint, key binary, first bigint")


def context_rows(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """(anchor, context, at, key, first) for the texts (key, text, firsts) at the listed runs.

    ``at`` is the place of the anchor in the context; equal contexts have it at the same place.
    """

    def cut(batches):
        for batch in batches:
            for part, raw in slices(batch, "text", TASK_BYTES):
                hashes, contexts, ats, owners, starts = [], [], [], [], []
                for key, text, wanted in zip(part.column("key").to_pylist(), raw, part.column("firsts").to_pylist()):
                    parts, place, found, first, last = anchors(symbols, text)
                    for i in np.flatnonzero(np.isin(first, wanted)):
                        hashes.append(found[i])
                        contexts.append(symbols.cut(parts, int(first[i]), int(last[i]) + symbols.run))
                        ats.append(int(place[i] - first[i]))
                        owners.append(key)
                        starts.append(int(first[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(contexts, pa.binary()), pa.array(ats, pa.int32()), pa.array(owners, pa.binary()), pa.array(starts, pa.int64())],
                    ["anchor", "context", "at", "key", "first"],
                )

    return texts.mapInArrow(cut, "anchor bigint, context binary, at int, key binary, first bigint")


def counted(contexts: DataFrame, symbols: Symbols) -> DataFrame:
    """What ``solved`` gives, by counting the hash of each run; for anchors with too many contexts for a task."""

    def runs(batches):
        for batch in batches:
            for part, raw in slices(batch, "context", 200_000):
                hashes = [windows(symbols.hashes(symbols.split(c)), symbols.run) for c in raw]
                rows = np.repeat(np.arange(len(raw)), [len(h) for h in hashes])
                places = np.concatenate([np.arange(len(h)) for h in hashes])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("anchor").take(pa.array(rows)), part.column("context_key").take(pa.array(rows)),
                        pa.array(np.concatenate(hashes).view(np.int64)), pa.array(places), part.column("n").take(pa.array(rows)),
                    ],
                    ["anchor", "context_key", "hash", "place", "n"],
                )

    each = contexts.mapInArrow(runs, "anchor bigint, context_key binary, hash bigint, place bigint, n bigint")
    twice = each.groupBy("anchor", "hash").agg(F.sum("n").alias("total")).where("total > 1").drop("total")
    span = F.struct(F.col("place").alias("start"), (F.col("place") + symbols.run).alias("end"))
    return each.join(twice, ["anchor", "hash"]).groupBy("anchor", "context_key").agg(F.collect_list(span).alias("spans"))


SPANS = "array<struct<start:bigint,end:bigint>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def with_partners(rows: list[tuple], symbols: Symbols) -> list[tuple]:
    """The contexts (context, n, at, key) of one anchor that may hold a run of another one, or their own twice.

    A run that two contexts share goes on from the anchor to both sides, over
    half of what it has besides the anchor on one of them at least. So contexts
    that share neither that half with another one are left out.
    """
    half = -(-(symbols.run - symbols.gram) // 2)
    sides, count = [], Counter()
    for context, n, at, _ in rows:
        parts = symbols.split(context)
        right = at + symbols.gram
        own = []
        if at >= half:
            own.append((0, symbols.cut(parts, at - half, at)))
        if len(parts) - right >= half:
            own.append((1, symbols.cut(parts, right, right + half)))
        for side in own:
            count[side] += n
        sides.append(own)
    return [row for row, own in zip(rows, sides) if any(count[side] > 1 for side in own)]


def solved(contexts: DataFrame, symbols: Symbols, solve: Solver) -> DataFrame:
    """(anchor, context_key, spans) of the distinct contexts (anchor, context, at, n): symbols in repeated runs.

    A task takes whole groups of an anchor, sorted; contexts that share no side of
    it are put aside, and of the others some hundred kilobytes are solved at a time.
    """

    def work(batches):
        def out(rows):
            if not rows:
                return
            spans = solve([row[1] for row in rows], [row[2] for row in rows])
            kept = [(row[0], row[3], s) for row, s in zip(rows, spans) if s]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a for a, _, _ in kept], pa.int64()),
                    pa.array([k for _, k, _ in kept], pa.binary()),
                    pa.array([[{"start": x, "end": y} for x, y in s] for _, _, s in kept], SPAN_TYPE),
                ],
                ["anchor", "context_key", "spans"],
            )

        columns = ("anchor", "context", "n", "at", "context_key")
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
        held, size = [], 0
        for anchor, group in groupby(rows, key=lambda row: row[0]):
            for context, n, _, key in with_partners([(c, n, at, k) for _, c, n, at, k in group], symbols):
                held.append((anchor, context, n, key))
                size += len(context)
            if size >= GROUP_BYTES:
                yield from out(held)
                held, size = [], 0
        yield from out(held)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "context", "n", "at", "context_key").mapInArrow(work, f"anchor bigint, context_key binary, spans {SPANS}")


def repeated_spans(docs: DataFrame, text_column: str, symbols: Symbols, solve: Solver) -> DataFrame:
    """(key, spans): merged intervals of symbols, for each distinct text that holds a run found elsewhere.

    Texts that occur twice as a whole are not listed for that reason alone.
    """
    texts = docs.select(text_key(F.col(text_column)).alias("key"), F.col(text_column).alias("text")).where("text is not null")
    found = stored(anchor_rows(texts, symbols), "anchors")
    place = F.xxhash64("key", "first")
    # stored, so that the join has two plain shuffles and adaptive execution may split a frequent anchor
    shared = stored(
        found.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high").select("anchor"),
        "anchors-twice",
    )
    wanted = stored(
        found.join(shared, "anchor").groupBy("key").agg(F.collect_set("first").alias("firsts")), "anchors-shared"
    )
    distinct = texts.dropDuplicates(["key"]).join(wanted, "key")
    contexts = stored(
        context_rows(distinct, symbols).withColumn("context_key", text_key(F.col("context"))), "contexts"
    )
    merged = contexts.groupBy("anchor", "context_key").agg(F.first("context").alias("context"), F.first("at").alias("at"), F.count("*").alias("n"))
    per_anchor = contexts.select("anchor", "context_key").distinct().groupBy("anchor").agg(F.count("*").alias("contexts"))
    crowded = stored(per_anchor.where(F.col("contexts") > GROUP_CONTEXTS).select("anchor"), "crowded")
    if crowded.isEmpty():
        spans = solved(merged, symbols, solve)
    else:
        spans = solved(merged.join(crowded, "anchor", "left_anti"), symbols, solve).unionByName(counted(merged.join(crowded, "anchor"), symbols))
    each = contexts.select("anchor", "context_key", "key", "first").join(stored(spans, "spans"), ["anchor", "context_key"])
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("first")).alias("start"), (s["end"] + F.col("first")).alias("end")))
    return each.select("key", moved.alias("spans")).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def joined(spans: list[dict]) -> list[tuple[int, int]]:
    """Overlapping or touching intervals as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def removed(docs: DataFrame, id_column: str, text_column: str, symbols: Symbols, solve: Solver, digest: Callable, schema: str) -> DataFrame:
    """A row for each row of ``docs``: its id and what ``digest`` makes of (text, spans to remove).

    Every distinct text is handled once; spans of None stand for a text that occurs
    twice, all of whose runs are repeated. The rows get the results by the text's key.
    """
    key = text_key(F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.select(F.col(id_column).alias("doc_id"), key.alias("key"))
    spans = stored(repeated_spans(docs, text_column, symbols, solve), "repeated")
    copies = rows.groupBy("key").agg((F.count("*") > 1).alias("copied"))
    texts = docs.select(key.alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).dropDuplicates(["key"])
    work = texts.join(copies, "key").join(spans, "key", "left")

    def cut(batches):
        for batch in batches:
            for part, raw in slices(batch, "text", TASK_BYTES):
                copied, found = part.column("copied").to_pylist(), part.column("spans").to_pylist()
                results = [digest(t, None if c else joined(s or [])) for t, c, s in zip(raw, copied, found)]
                columns = [pa.array(c) for c in zip(*results)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], ["key", *names])

    names = [part.split()[0] for part in schema.split(", ")]
    results = stored(work.mapInArrow(cut, f"key binary, {schema}"), "results")
    return rows.join(results, "key").drop("key")
