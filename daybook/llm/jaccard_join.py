"""Similarity join on word n-grams with prefix trees, and the groups it links.

A text's set holds a 64-bit hash of every distinct run of five words. Sets are in
one global order, rare hashes first. Two sets that are similar enough share several
of the first hashes of either; only sets that do are compared:

1. Of each distinct set a beginning in hash order is kept. Hashes that two sets
   share are counted; sets with too few of them have no partner and are done.
2. Among the shared ones, ordered by frequency, a similar set must hold one of the
   first few. Sets meet at the least set that holds one of these hashes, their hub:
   copies of one text have few hubs, so a set travels to few places.
3. The sets of a hub are joined with a prefix tree: paths that share one of their
   first ranks are walked with their partial overlaps, and left as soon as the remaining
   lengths cannot give the similarity. Sets that are linked already are not compared again, so that no
   group is expanded into its pairs. A hub with many sets is first compared with the
   hub itself; only sets not linked to it are compared with all, in blocks.
4. Links form groups by repeated exchange of least labels.

Defined results: a text that is NULL or has no words has an empty set and is alone;
fewer than five words are one sequence; equal rows are in one group; rows with a
NULL id count as members but have no id to give; of a group's rows with equal least ids
``one_of_each_group`` keeps one; texts of any length are read whole; an empty table
gives no rows; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import fresh, WordHashes, slices, stored, windows

SHINGLE_WORDS = 5
PERCENT = 80
BLOCK_SETS = 1_000


def least_overlap(n, percent: int):
    """Hashes that a set of n must share with any similar set."""
    return -(-n * percent // 100)


def extra(n):
    """Hashes kept beyond the plain prefix; a similar set shares as many of them, with its own size."""
    return -(-n // 25)


def shingle_set(words: WordHashes, text: bytes) -> np.ndarray:
    """Sorted distinct hashes of five words in turn, A-Z in lower case."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = words.of(parts)
    return np.unique(windows(hashes, min(SHINGLE_WORDS, len(parts))))


def set_rows(docs: DataFrame, id_column: str, text_column: str, percent: int) -> DataFrame:
    """(doc_id, text_hash, key, low, n, beginning): the key of the set, its first eight bytes as a number, and the beginning.

    A task gives the beginning of equal sets once.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_hash"))

    def build(batches):
        words, seen = WordHashes(), set()
        for batch in batches:
            for part, raw in slices(batch, "text"):
                keys, lows, sizes, beginnings = [], [], [], []
                for text in raw:
                    values = shingle_set(words, text)
                    n = len(values)
                    key = xxhash.xxh3_128_digest(values.tobytes()) if n else None
                    keys.append(key)
                    lows.append(int.from_bytes(key[:8], "big", signed=True) if n else None)
                    sizes.append(n)
                    if n and key not in seen:
                        seen.add(key)
                        beginnings.append(values[: n - least_overlap(n, percent) + extra(n)].view(np.int64))
                    else:
                        beginnings.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(keys, pa.binary()), pa.array(lows, pa.int64()), pa.array(sizes, pa.int64()), pa.array(beginnings, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "key", "low", "n", "beginning"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(build, f"doc_id {kind}, text_hash bigint, key binary, low bigint, n bigint, beginning array<bigint>")


def placed_sets(texts: DataFrame) -> DataFrame:
    """(hub, members, key, low, n, set) of the columns text and hubs; the set as 64-bit numbers in turn.

    ``hubs`` lists (low, hub, members) of the text. A task places a set at a hub once.
    """

    def build(batches):
        words, seen = WordHashes(), set()
        for batch in batches:
            for part, raw in slices(batch, "text"):
                rows = []
                for text, hubs in zip(raw, part.column("hubs").to_pylist()):
                    values = shingle_set(words, text)
                    if not len(values):
                        continue
                    data = values.tobytes()
                    key = xxhash.xxh3_128_digest(data)
                    low = int.from_bytes(key[:8], "big", signed=True)
                    for place in hubs:
                        if place["low"] == low and (place["hub"], key) not in seen:
                            seen.add((place["hub"], key))
                            rows.append((place["hub"], place["members"], key, low, len(values), data))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["hub", "members", "key", "low", "n", "set"])

    return texts.select("text", "hubs").mapInArrow(build, "hub bigint, members bigint, key binary, low bigint, n bigint, set binary")


def similar(overlap, n, m, percent: int):
    return 100 * overlap >= percent * (n + m - overlap)


class PrefixTree:
    """Sets as paths of ranks, rare ranks first, kept in order with the length of path that neighbours share."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, counts))] = np.arange(len(values))
        ends = np.cumsum([len(s) for s in sets])
        paths = [np.sort(p) for p in np.split(rank[place], ends[:-1])]
        self.order = sorted(range(len(sets)), key=lambda i: paths[i].astype(">u4").tobytes())
        self.paths = [paths[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.paths, self.paths[1:]):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared.append(int(differ[0]) if len(differ) else n)
        self.size = len(values)
        self.sizes = np.array([len(p) for p in self.paths], np.int64)
        self.beginnings = [p[: len(p) - least_overlap(len(p), percent) + 1] for p in self.paths]
        ranks = np.concatenate(self.beginnings)
        holders = np.repeat(np.arange(len(self.paths)), [len(b) for b in self.beginnings])
        by_rank = np.argsort(ranks, kind="stable")
        self.holders = holders[by_rank]
        self.starts = np.searchsorted(ranks[by_rank], np.arange(self.size + 1))

    def candidates(self, probe: int, percent: int) -> np.ndarray:
        """Places after ``probe`` whose sets may be similar to it: of like size, and sharing a rank of both beginnings.

        Similar sets share at least ``least_overlap`` of either, so in one order of ranks
        their beginnings, which leave out fewer than that, have a rank in common.
        """
        ranks = self.beginnings[probe]
        found = [self.holders[a:b] for a, b in zip(self.starts[ranks], self.starts[ranks + 1]) if b - a > 1]
        if not found:
            return np.empty(0, np.int64)
        marked = np.zeros(len(self.paths), bool)
        marked[np.concatenate(found)] = True
        places = np.flatnonzero(marked[probe + 1 :]) + probe + 1
        n, m = self.sizes[probe], self.sizes[places]
        return places[100 * np.minimum(n, m) >= percent * np.maximum(n, m)]

    def links(self, probe: int, percent: int, places: np.ndarray) -> list[int]:
        """Of ``places``, which rise and come after ``probe`` (in tree order), those whose sets are similar to it."""
        if not len(places):
            return []
        mine = self.paths[probe]
        n = len(mine)
        held = np.zeros(self.size, bool)
        held[mine] = True
        found = []
        sums = np.zeros(1, np.int64)  # overlaps along the path last walked
        common = 0  # of which this much is a part of the path at hand
        before = probe
        for place in places.tolist():
            common = min(common, *self.shared[before + 1 : place + 1])
            before = place
            path = self.paths[place]
            m = len(path)
            need = -(-percent * (n + m) // (100 + percent))
            at, total = common, int(sums[common])
            walked = [sums[: common + 1]]
            while at < m and total + min(m - at, n - total) >= need:
                step = held[path[at : at + 64]].cumsum() + total
                walked.append(step)
                at, total = at + len(step), int(step[-1])
            sums, common = np.concatenate(walked), at
            if at == m and total >= need:
                found.append(place)
        return found


class Groups:
    """Union by least member; ``label`` has the least member of each one's group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.label[i], self.label[j]))
        if a != b:
            self.label[self.label == b] = a


def block_links(keys: list[bytes], sets: list[np.ndarray], probes: list[bool], percent: int) -> list[tuple[bytes, bytes]]:
    """Links of one block that connect what its similar pairs connect; a pair needs a probe."""
    tree = PrefixTree(sets, percent)
    groups = Groups(len(keys))
    asks = np.array([probes[i] for i in tree.order], bool)
    for place in range(len(keys)):
        others = tree.candidates(place, percent)
        apart = groups.label[others] != groups.label[place]
        for other in tree.links(place, percent, others[apart & (asks[place] | asks[others])]):
            groups.join(place, other)
    names = [keys[i] for i in tree.order]
    return [(names[least], names[i]) for i, least in enumerate(groups.label.tolist()) if least != i]


LINKS = "a binary, b binary"


def joined_blocks(rows: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Links within each block: ``rows`` are (by..., key, set, probe), a block as large as BLOCK_SETS probes and sets."""

    def work(batches):
        def out(block):
            if len(block) > 1:
                merged: dict[bytes, list] = {}
                for key, values, probe in block:
                    merged.setdefault(key, [np.frombuffer(values, np.uint64), False])[1] |= probe
                links = block_links(list(merged), [v for v, _ in merged.values()], [p for _, p in merged.values()], percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], ["a", "b"])

        held, block = None, []
        for batch in batches:
            for *name, key, values, probe in zip(*(batch.column(c).to_pylist() for c in (*by, "key", "set", "probe"))):
                if name != held:
                    yield from out(block)
                    held, block = name, []
                block.append((key, values, probe))
        yield from out(block)

    return rows.select(*by, "key", "set", "probe").repartition(*by).sortWithinPartitions(*by).mapInArrow(work, LINKS)


def hub_links(rows: DataFrame, percent: int) -> DataFrame:
    """(hub, key, set, hub_key, linked) for rows (hub, key, set, hub_key, hub_set)."""

    def compare(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set").to_pylist(), batch.column("hub_set").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                linked.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("hub", "key", "set", "hub_key")), pa.array(linked)], ["hub", "key", "set", "hub_key", "linked"]
            )

    return rows.mapInArrow(compare, "hub bigint, key binary, set binary, hub_key binary, linked boolean")


def meeting_places(rows: DataFrame, percent: int) -> DataFrame:
    """(low, hub): where each set that may have a similar one meets others."""
    entries = rows.where("beginning is not null").select("low", F.explode("beginning").alias("hash"))
    counted = entries.groupBy("hash").agg(F.count("*").alias("c"), F.min("low").alias("least"), F.max("low").alias("most"))
    shared = stored(counted.where("least < most").select("hash", "c"), "shared-hashes")
    sizes = rows.where("n > 0").groupBy("low").agg(F.min("n").alias("n"))
    lists = entries.join(shared, "hash").groupBy("low").agg(F.array_sort(F.collect_set(F.struct("c", "hash"))).alias("hashes"))
    # of its shared hashes a set shares this many with any similar set
    wanted = F.ceil(F.col("n") * percent / F.lit(2500)).cast("int")
    first = F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - F.col("wanted") + 1, F.lit(0)))
    firsts = lists.join(sizes, "low").withColumn("wanted", wanted).select("low", F.explode(first).alias("at"))
    places = stored(firsts.select("low", F.col("at.hash").alias("hash")), "first-hashes")
    hubs = places.groupBy("hash").agg(F.min("low").alias("hub"), F.count("*").alias("c")).where("c > 1").select("hash", "hub")
    return stored(places.join(hubs, "hash").select("low", "hub").distinct(), "hubs")


def links(docs: DataFrame, rows: DataFrame, id_column: str, text_column: str, percent: int) -> DataFrame:
    """(a, b): keys of sets, enough links to connect all that similar sets connect."""
    members = meeting_places(rows, percent)
    sizes = members.groupBy("hub").agg(F.count("*").alias("members")).where("members > 1")
    hubs = members.join(sizes, "hub").groupBy("low").agg(F.collect_list(F.struct("low", "hub", "members")).alias("hubs"))
    first = rows.where("n > 0").groupBy("low").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).join(hubs, "low")
    named = first.groupBy("first.doc_id", "first.text_hash").agg(F.flatten(F.collect_list("hubs")).alias("hubs"))
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("own_hash"))
    # which texts are wanted grows with the input: both sides are shuffled, at any size
    same = (F.col("own_hash") == F.col("text_hash")) & F.col("id").eqNullSafe(F.col("doc_id"))
    chosen = chosen.where("text is not null").join(named.hint("merge"), same)
    sets = stored(placed_sets(chosen), "sets")
    small = sets.where(F.col("members") <= BLOCK_SETS).withColumn("probe", F.lit(True))
    found = joined_blocks(small, ["hub"], percent)
    large = sets.where(F.col("members") > BLOCK_SETS)
    if large.isEmpty():
        return found
    hub_sets = large.where("low = hub").groupBy("hub").agg(F.min_by("key", "key").alias("hub_key"), F.min_by("set", "key").alias("hub_set"))
    compared = stored(hub_links(large.join(hub_sets, "hub"), percent), "compared")
    found = found.unionByName(compared.where("linked and key != hub_key").select(F.col("hub_key").alias("a"), F.col("key").alias("b")))
    counts = compared.groupBy("hub").agg(F.count("*").alias("sets"), F.count_if(~F.col("linked")).alias("probes")).where("probes > 0")
    part = lambda seed, column: F.pmod(F.xxhash64("key", F.lit(seed)), F.ceil(F.col(column) / BLOCK_SETS).cast("bigint"))
    every = lambda column: F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(column) / BLOCK_SETS).cast("bigint") - 1)
    split = compared.join(counts, "hub")
    asking = split.where("not linked").select("hub", part(1, "probes").alias("i"), F.explode(every("sets")).alias("j"), "key", "set", F.lit(True).alias("probe"))
    asked = split.select("hub", F.explode(every("probes")).alias("i"), part(2, "sets").alias("j"), "key", "set", F.lit(False).alias("probe"))
    return found.unionByName(joined_blocks(asking.unionByName(asked), ["hub", "i", "j"], percent))


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of the links (a, b) is connected with.

    In a round every node takes the least label around it, then the label of its
    label; distances at least halve, and rounds end when no label changes.
    """
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        nearest = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = nearest.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("old != label").isEmpty():
            return labels


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, the least id that links of the similarity reach, for every row."""
    rows = stored(set_rows(docs, id_column, text_column, percent), "shingle-sets")
    labels = connected(links(docs, rows, id_column, text_column, percent))
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_key = stored(named.select("key", "label").join(groups, "label").select("key", "component_id"), "groups")
    component: Column = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n", "key").join(of_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows with the least id of each group; rows with a NULL id stay. Rows that repeat an id in a group stay once."""
    groups = stored(similar_groups(docs, id_column, text_column, percent), "document-groups")
    counts = groups.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if counts["n"] == counts["ids"]:
        other = fresh(docs, "_gone")
        gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias(other))
        return docs.join(gone, F.col(id_column) == F.col(other), "left_anti")
    # an id with several texts: decide by id and text
    row, other = fresh(docs, "_row"), fresh(docs, "_kept")
    again = docs.withColumn(row, F.struct(F.col(id_column).alias("id"), F.unhex(F.md5(F.coalesce(text_column, F.lit("")))).alias("text")))
    rows = similar_groups(again, row, text_column, percent).where("doc_id = component_id or doc_id.id is null or n_shingles = 0")
    kept = rows.select(F.col("doc_id").alias(other)).distinct()
    named = again.join(kept, F.col(row).eqNullSafe(F.col(other)), "left_semi")
    return named.where(F.col(id_column).isNotNull()).dropDuplicates([row]).unionByName(named.where(F.col(id_column).isNull())).drop(row)
