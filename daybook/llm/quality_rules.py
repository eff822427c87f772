"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a test on measures of the words of a text. Its cost (seconds on a
bounded sample) and its selectivity (share of the sample it rejects) are measured;
rules are then tried by rejections per second, and a row stops at the first rule
that rejects it: the cascade is one CASE, whose later branches Spark computes only
for rows that pass the earlier ones. The order changes the cost and the rule that
is named, never the verdict.

Defined results: NULL text has no words and all counts are 0, so that it is
rejected as too short; equal rows are judged one by one; rules with equal
rejections per second are tried by name; texts of any length are read whole; an
empty table gives no rows; ``judge`` replaces a column ``rejected_by`` and
``measured`` those of its measures, other columns may have any name.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.rules import materialize_columns

from .batches import fresh, stored

SAMPLE_ROWS = 500
WINDOW_WORDS = 8
SPACE = r"[\x20\x09-\x0D]+"


def split_words(text: Column) -> Column:
    """Runs of anything but white space (space and code points 9 to 13)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column, words: Column) -> Column:
    return F.size(words).cast("bigint")


def word_chars(text: Column, words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("bigint")


def n_symbols(text: Column, words: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint")


def n_shouts(text: Column, words: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("!")), F.lit(0)).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column, words: Column) -> Column:
    return F.size(lines_with_words(text)).cast("bigint")


def n_dup_lines(text: Column, words: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = lines_with_words(text)
    return F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("bigint")


def n_repeat_words(text: Column, words: Column) -> Column:
    """Words covered by runs of 8 words that stand twice or more in the text, the first included.

    Runs are compared by 64-bit hashes. Few texts have equal runs at all; only
    for those are runs sorted. The starts of repeated runs, in order, each cover
    8 words or those up to the next start.
    """
    last = F.size(words) - (WINDOW_WORDS - 1)

    def joined(values: Column, step: int) -> Column:
        return F.transform(values, lambda x, i: F.xxhash64(x, F.get(values, i + step)))

    def then(values: Column, step: int) -> Column:
        return F.transform(F.array(values), lambda x: joined(x, step))[0]

    # hashes of 2, 4 and 8 words from each place on
    runs = F.when(last > 0, F.slice(then(then(joined(words, 1), 2), 4), F.lit(1), F.greatest(last, F.lit(0))))

    def covered(hashes: Column) -> Column:
        places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ordered = F.transform(F.array(F.array_sort(places)), marked)[0]
        return F.transform(F.array(F.array_sort(ordered)), spread)[0]

    def marked(ordered: Column) -> Column:
        same = lambda p, j: F.coalesce(F.get(ordered, j)["h"] == p["h"], F.lit(False))
        kept = F.transform(ordered, lambda p, k: F.when(same(p, k - 1) | same(p, k + 1), p["i"]))
        return F.array_compact(kept)

    def spread(starts: Column) -> Column:
        step = lambda i, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(starts, k + 1) - i, F.lit(WINDOW_WORDS)))
        return F.aggregate(F.transform(starts, step), F.lit(0), lambda total, x: total + x)

    count = F.transform(F.array(runs), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))[0]
    return F.coalesce(count, F.lit(0)).cast("bigint")


MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_shouts, n_lines, n_dup_lines, n_repeat_words)
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the measure of a name, as a column, and gives a condition."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


BASE_RULES = (
    Rule("too_short", lambda m: m("n_words") < 20),
    Rule("repeated_words", lambda m: m("n_repeat_words") * 100 > m("n_words") * 30),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda m: m("n_symbols") * 100 > m("n_words") * 25),
    Rule("shouting", lambda m: m("n_shouts") * 100 > m("n_words") * 30),
    Rule("word_length", lambda m: ~m("word_chars").between(m("n_words") * 2, m("n_words") * 40)),
    Rule("duplicate_lines", lambda m: m("n_dup_lines") * 100 > m("n_lines") * 60),
)


def cascade(rules: tuple[Rule, ...], measure: Callable[[str], Column]) -> Column:
    """The name of the first rule that rejects, else NULL."""
    first, *rest = rules
    out = F.when(first.rejects(measure), F.lit(first.name))
    for rule in rest:
        out = out.when(rule.rejects(measure), F.lit(rule.name))
    return out


def from_words(text: str, words: str) -> Callable[[str], Column]:
    """Measures computed where they are used, from a text and its words."""
    return lambda name: MEASURES[name](F.col(text), F.col(words))


def with_words(docs: DataFrame, words: str, text_column: str = "text") -> DataFrame:
    """A column of words, split once however often it is used."""
    return materialize_columns(docs.withColumn(words, split_words(F.col(text_column))))


def ordered_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by rejections per second on ``sample_rows`` rows.

    Seconds are those of the rule alone, beyond reading the sample and splitting it into words.
    """
    sample = stored(docs.select(F.col(text_column).alias("text")).limit(sample_rows), "quality-sample")
    split, measure = with_words(sample, "words"), from_words("text", "words")

    def timed(value: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = split.agg(F.avg(value)).first()[0] or 0.0
        return time.perf_counter() - start, share

    timed(F.size("words"))  # the first run compiles and is not counted
    bare = timed(F.size("words"))[0]
    measured = []
    for rule in rules:
        seconds, share = timed(rule.rejects(measure).cast("int"))
        measured.append((rule, max(seconds - bare, 1e-3), share))
    return sorted(measured, key=lambda x: (-x[2] / x[1], x[0].name))


def measured(docs: DataFrame, names: list[str], text_column: str = "text") -> DataFrame:
    """Adds the named measures to every row. A name that ``docs`` has already is replaced."""
    words = fresh(docs, "_words")
    measure = from_words(text_column, words)
    return materialize_columns(with_words(docs, words, text_column).withColumns({n: measure(n) for n in names}).drop(words))


def judged(docs: DataFrame, verdict: str, rules: tuple[Rule, ...] | None = None, text_column: str = "text") -> DataFrame:
    """Adds a column with the first rule in the measured order that rejects the row, NULL for rows to keep.

    The column replaces one of that name.
    """
    order = rules or tuple(r for r, _, _ in ordered_rules(docs, RULES, text_column))
    words = fresh(docs, "_words")
    found = cascade(order, from_words(text_column, words))
    return materialize_columns(with_words(docs, words, text_column).withColumn(verdict, found).drop(words))


def judge(docs: DataFrame, rules: tuple[Rule, ...] | None = None, text_column: str = "text") -> DataFrame:
    """Adds ``rejected_by``; a column of that name is replaced."""
    return judged(docs, "rejected_by", rules, text_column)


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``, all as they were."""
    verdict = fresh(docs, "_rejected_by")
    return judged(docs, verdict, None, text_column).where(F.col(verdict).isNull()).select(*docs.columns)
