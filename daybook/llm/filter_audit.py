"""Filter interaction audit: what each filter removes in every order of all filters.

A row fails some of k filters; its failure mask has a bit for each. Rows are
counted by part and mask, so at most 2^k counts a part remain, whatever the input.
A part's counts become a decision diagram: one level for each filter, a "passes"
and a "fails" branch at each node, counts at the leaves, equal nodes shared, and
each node knowing the counts below it. Neighbouring levels are swapped in place,
one swap from each order to the next, until all k! orders have been seen. In each
order the path that passes every filter gives the steps: what lies below the
"fails" branch of a node on it is what that filter removes there.

Defined results: a NULL part is the empty string; a condition that is NULL counts
as passed; NULL text is empty; a NULL id is no copy, has no copies and no labels; repeated
rows count one by one, and rows with equal id and text are no copies of each
other; several label rows of one id count as one that has each flag any of them
has; texts of any length are read whole; an empty table gives no rows. Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import stored

SPACE = r"[\x20\x09-\x0D]+"


def plain_changes(n: int) -> list[int]:
    """Places k of swaps (k, k + 1) that lead through all orders of n things, each seen once."""
    if n < 2:
        return []
    out: list[int] = []
    inner = plain_changes(n - 1)
    down = True
    for turn in range(len(inner) + 1):
        sweep = range(n - 1)
        out += reversed(sweep) if down else sweep
        if turn < len(inner):
            out.append(inner[turn] + down)
        down = not down
    return out


class Diagram:
    """Count-weighted decision diagram over failure masks, with levels that can be swapped.

    No level is left out of a path, so that the counts below a node depend on the
    node alone. ``levels[d]`` maps a node to its (passes, fails) children one level down.
    """

    def __init__(self, letters: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(letters)
        self.totals: list[tuple[int, ...]] = []
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in letters]
        self._known: list[dict[tuple[int, int], int]] = [{} for _ in letters]
        nothing = (0,) * len(next(iter(counts.values())))
        leaves: dict[tuple[int, ...], int] = {}

        def leaf(mask: int) -> int:
            value = counts.get(mask, nothing)
            if value not in leaves:
                leaves[value] = self._new(value)
            return leaves[value]

        row = [leaf(mask) for mask in range(1 << len(letters))]
        for depth in reversed(range(len(letters))):  # the last filter is the highest bit
            half = len(row) // 2
            row = [self._node(depth, row[i], row[i + half]) for i in range(half)]
        self.root = row[0]

    def _new(self, total: tuple[int, ...]) -> int:
        self.totals.append(total)
        return len(self.totals) - 1

    def _node(self, depth: int, passes: int, fails: int) -> int:
        found = self._known[depth].get((passes, fails))
        if found is None:
            found = self._new(tuple(a + b for a, b in zip(self.totals[passes], self.totals[fails])))
            self._known[depth][passes, fails] = found
            self.levels[depth][found] = (passes, fails)
        return found

    def swap(self, depth: int) -> None:
        """Exchange the filters of two neighbouring levels; only nodes of these two change."""
        upper, lower = self.levels[depth], self.levels[depth + 1]
        self.levels[depth + 1], self._known[depth + 1] = {}, {}
        for node, (passes, fails) in upper.items():
            (pp, pf), (fp, ff) = lower[passes], lower[fails]
            upper[node] = (self._node(depth + 1, pp, fp), self._node(depth + 1, pf, ff))
        self._known[depth] = {children: node for node, children in upper.items()}
        self.order[depth], self.order[depth + 1] = self.order[depth + 1], self.order[depth]

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts kept, counts removed) along the path that passes every filter."""
        node = self.root
        for letter, level in zip(self.order, self.levels):
            passes, fails = level[node]
            yield letter, self.totals[passes], self.totals[fails]
            node = passes


def all_orders(letters: str, counts: dict[int, tuple[int, ...]]) -> list[tuple[str, list]]:
    """(order, steps) for every order of the filters."""
    diagram = Diagram(letters, counts)
    out = [("".join(diagram.order), list(diagram.steps()))]
    for depth in plain_changes(len(letters)):
        diagram.swap(depth)
        out.append(("".join(diagram.order), list(diagram.steps())))
    return out


def mask_counts(rows: DataFrame, part: str, failures: dict[str, Column], tallies: dict[str, Column]) -> DataFrame:
    """(part, mask, n, one column for each tally): rows by part and failure mask, the first filter the lowest bit."""
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failures.values())]
    slim = rows.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        reduce(lambda a, b: a + b, bits).alias("mask"),
        *[F.when(flag, 1).otherwise(0).alias(f"t{i}") for i, flag in enumerate(tallies.values())],
    )
    sums = [F.sum(f"t{i}").alias(name) for i, name in enumerate(tallies)]
    return slim.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)


def audit(counts: DataFrame, letters: str, tallies: list[str]) -> DataFrame:
    """For each part, order and step: what the step's filter keeps and removes.

    ``counts`` comes from ``mask_counts``. Columns: part, filter_order, step, kept,
    removed, redundant (fails the filter, removed earlier), unique_fails (fails it
    alone), ``<tally>_lost`` (removed here, with the flag) and shapley (removed by
    the filter, summed over all orders). k filters give k * k! rows a part; a
    part's group holds at most 2^k rows.
    """
    numbers = ["kept", "removed", "redundant", "unique_fails", *[f"{t}_lost" for t in tallies], "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{n} bigint" for n in numbers)

    def orders(key, frame):
        values = frame[["n", *tallies]].itertuples(index=False)
        known = {int(mask): tuple(int(v) for v in row) for mask, row in zip(frame["mask"], values)}
        every = all_orders(letters, known)
        removed_in = {letter: [] for letter in letters}
        failed, alone = {}, {}
        for _, steps in every:
            for place, (letter, _, gone) in enumerate(steps):
                removed_in[letter].append(gone[0])
                if place == 0:
                    failed[letter] = gone[0]
                if place == len(letters) - 1:
                    alone[letter] = gone[0]
        shapley = {letter: sum(gone) for letter, gone in removed_in.items()}
        rows = [
            (key[0], order, place + 1, kept[0], gone[0], failed[letter] - gone[0], alone[letter], *gone[1:], shapley[letter])
            for order, steps in every
            for place, (letter, kept, gone) in enumerate(steps)
        ]
        return pd.DataFrame(rows, columns=["part", "filter_order", "step", *numbers])

    return counts.groupBy("part").applyInPandas(orders, schema)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


#: Letter of each text filter and the test that fails it.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text."""
    words = split_words(text)
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (id, key and others) with ``copy``: a smaller id has the same key.

    The least id of each key is found by partial aggregation, so a key with any
    share of the rows sends one row a task. Rows then meet the (id, key) pairs
    that come first, by id and key together: no hot key is joined on.
    """
    first = rows.groupBy("key").agg(F.min("id").alias("id")).where(F.col("id").isNotNull()).withColumn("first", F.lit(True))
    return rows.join(first, ["id", "key"], "left").withColumn("copy", F.col("id").isNotNull() & F.col("first").isNull()).drop("first")


def audit_documents(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """Audit of five filters on whole texts: A few words, B repeated words, C capitals, D symbols, E copies.

    Texts are read once, for four conditions and a 256-bit key; all later stages
    move an id, a key, a part and a few bits a row. ``labels`` has the id, ``quality`` and ``toxic``.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    failed = text_failures(text)
    slim = stored(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(part_column).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("key"),
            *[condition.alias(letter) for letter, condition in failed.items()],
        ),
        "audit",
    )
    flags = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = with_copies(slim).join(flags, "id", "left")
    conditions = {letter: F.col(letter) for letter in failed} | {"E": F.col("copy")}
    tallies = {"good": F.col("good"), "toxic": F.col("toxic")}
    return audit(mask_counts(rows, "part", conditions, tallies), "".join(conditions), list(tallies))
