"""Benchmark decontamination: BM25 over test items, block-max WAND, verified overlap.

Test items are the indexed side. Each is cut into units of at most 64 words;
postings hold the BM25 weight of a term divided by the unit's full score, so that
a passage scores the share of a unit's weight that it holds. Every training text
is read as overlapping passages of 128 words, each a query: all units above the
threshold are retrieved. Bounds are first summed for whole passages, over the best
posting of each term and over the best in each block; passages that may reach the
threshold walk the postings by block-max WAND. Retrieved items are verified on the
text: word 5-grams of the question, words of the answer. An item without a question
is verified by the 5-grams of its answer, as a question; so is an answer of 5 words
or more after a question of fewer. No item is found by a bag of words alone.

Defined results: NULL or empty texts and items without words match nothing; equal
rows are judged one by one; equal items are both reported; an item without an
answer needs its question only; empty tables give no rows or match nothing.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import fresh, slices, stored

UNIT_WORDS = 64
BLOCK_UNITS = 2
#: Sums of bounds held at once, by passage and block of units.
BOUND_CELLS = 2_000_000
THRESHOLD = 0.5
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.6
GRAM_WORDS = 5
K1, B = 1.2, 0.75
#: Bytes of items in one broadcast index; more items are searched in several passes.
INDEX_BYTES = 16_000_000

WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_grams(words: list[str]) -> set[tuple[str, ...]]:
    """Distinct 5-grams; fewer words are one gram."""
    if not words:
        return set()
    return {tuple(words[i : i + GRAM_WORDS]) for i in range(max(1, len(words) - GRAM_WORDS + 1))}


def grams_held(words: list[str], near: list[str]) -> float:
    """The share of the grams of ``words`` that stand in ``near``; 1 for no words."""
    grams = word_grams(words)
    if not grams:
        return 1.0
    size = min(GRAM_WORDS, len(words))
    return len(grams & {tuple(near[i : i + size]) for i in range(len(near) - size + 1)}) / len(grams)


def units_of(words: list[str]) -> list[list[str]]:
    return [words[start : start + UNIT_WORDS] for start in range(0, len(words), UNIT_WORDS)]


def unit_statistics(units: list[list[str]]) -> tuple[int, int, dict[str, int]]:
    """How many units and words there are, and how many units hold each word."""
    frequency: dict[str, int] = defaultdict(int)
    for unit in units:
        for word in set(unit):
            frequency[word] += 1
    return len(units), sum(map(len, units)), frequency


class Terms(dict):
    """Numbers of known words; -1 for any other."""

    def __missing__(self, word: str) -> int:
        return -1


class ItemIndex:
    """Inverted index of items (id, question, answer) with postings in blocks.

    ``statistics`` of more items than these (units, their words, units by word) are
    given where these are a part of a benchmark.
    """

    def __init__(self, items: list[tuple[object, str | None, str | None]], statistics: tuple[int, int, dict[str, int]] | None = None):
        both = [(i, words_of(q or ""), words_of(a or "")) for i, q, a in items]
        self.items = [(i, q or a, a if q else []) for i, q, a in both]
        self.units: list[tuple[int, int]] = []  # item, words of the item
        texts = []
        for place, (_, question, answer) in enumerate(self.items):
            words = question + answer
            own = units_of(words)
            texts += own
            self.units += [(place, len(words))] * len(own)
        n_units, n_words, frequency = statistics or unit_statistics(texts)
        mean = n_words / n_units if n_units else 1.0
        self.terms = Terms({word: i for i, word in enumerate(sorted({w for t in texts for w in t}))})
        idf = {w: np.log(1 + (n_units - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w in self.terms}
        lists: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for unit, text in enumerate(texts):
            counts: dict[str, int] = defaultdict(int)
            for word in text:
                counts[word] += 1
            norm = K1 * (1 - B + B * len(text) / mean)
            weights = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in counts.items()}
            full = sum(weights.values())
            for word, weight in weights.items():
                lists[self.terms[word]].append((unit, weight / full))
        self.postings = [(np.array([u for u, _ in x]), np.array([w for _, w in x])) for x in lists]
        # the best weight of each term in each block of units that it occurs in
        self.blocks = []
        for units, weights in self.postings:
            block, first = np.unique(units // BLOCK_UNITS, return_index=True)
            self.blocks.append((block, np.maximum.reduceat(weights, first)))
        self.n_blocks = (len(self.units) - 1) // BLOCK_UNITS + 1
        self.block_sizes = np.array([len(x) for x, _ in self.blocks], np.int64)
        self.block_starts = np.concatenate(([0], np.cumsum(self.block_sizes)))
        self.block_of = np.concatenate([x for x, _ in self.blocks]) if texts else np.empty(0, np.int64)
        self.block_best = np.concatenate([x for _, x in self.blocks]) if texts else np.empty(0)
        self.bounds = np.array([w.max() for _, w in self.postings])

    def search(self, terms: list[int], threshold: float, low: int = 0, high: int | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: every unit from ``low`` on, below ``high``, whose weights over the distinct ``terms`` sum to ``threshold``."""
        lists = [self.postings[t] for t in terms]
        blocks = [self.blocks[t] for t in terms]
        bounds = [self.bounds[t] for t in terms]
        end = len(self.units) if high is None else min(high, len(self.units))
        at = [int(units.searchsorted(low)) for units, _ in lists]
        current = [min(end, int(units[i])) if i < len(units) else end for i, (units, _) in zip(at, lists)]
        found = []
        while True:
            order = sorted(range(len(terms)), key=current.__getitem__)
            total, pivot = 0.0, -1
            for place, t in enumerate(order):
                if current[t] == end:
                    break
                total += bounds[t]
                if total >= threshold - 1e-9:
                    pivot = place
                    break
            if pivot < 0:
                return found
            unit = current[order[pivot]]
            while pivot + 1 < len(order) and current[order[pivot + 1]] == unit:
                pivot += 1
            # the best that the block of ``unit`` can give; the bound holds to the block's end
            total, reach = 0.0, min(end, (unit // BLOCK_UNITS + 1) * BLOCK_UNITS)
            for t in order[: pivot + 1]:
                where, best = blocks[t]
                place = int(where.searchsorted(unit // BLOCK_UNITS))
                if place < len(where) and where[place] == unit // BLOCK_UNITS:
                    total += best[place]
            if total >= threshold - 1e-9:
                weights_held = []
                for t in order[: pivot + 1]:
                    units, weights = lists[t]
                    at[t] += int(units[at[t] :].searchsorted(unit))
                    if at[t] < len(units) and units[at[t]] == unit:
                        weights_held.append(weights[at[t]])
                        at[t] += 1
                    current[t] = min(end, int(units[at[t]])) if at[t] < len(units) else end
                score = math.fsum(weights_held)  # exact, so that the order of units and terms does not matter
                if score >= threshold - 1e-9:
                    found.append((unit, score))
            else:
                if pivot + 1 < len(order):
                    reach = min(reach, current[order[pivot + 1]])
                reach = max(reach, unit + 1)
                for t in order[: pivot + 1]:
                    units, _ = lists[t]
                    at[t] += int(units[at[t] :].searchsorted(reach))
                    current[t] = min(end, int(units[at[t]])) if at[t] < len(units) else end

    def candidates(self, words: list[str], threshold: float) -> dict[int, list[tuple[int, float]]]:
        """Item places with (first word, score) of the passages that retrieve them."""
        out: dict[int, list[tuple[int, float]]] = defaultdict(list)
        terms = np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
        known = np.flatnonzero(terms >= 0)
        if not len(known):
            return out
        # distinct terms of each passage: two runs of 64 words, each run but the first and last in two passages
        run, count = known // UNIT_WORDS, len(self.terms)
        last = max(0, (len(words) - 1) // UNIT_WORDS - 1)
        passage = np.concatenate((np.minimum(run, last), np.maximum(run - 1, 0)))
        pairs = np.unique(passage * count + np.tile(terms[known], 2))
        passage, term = pairs // count, pairs % count
        starts = np.searchsorted(passage, np.arange(last + 2))
        for p, block in self._passages(passage, term, starts, threshold):
            distinct = term[starts[p] : starts[p + 1]].tolist()
            for unit, score in self.search(distinct, threshold, block * BLOCK_UNITS, (block + 1) * BLOCK_UNITS):
                out[self.units[unit][0]].append((p * UNIT_WORDS, score))
        return out

    def _passages(self, passage: np.ndarray, term: np.ndarray, starts: np.ndarray, threshold: float) -> list[tuple[int, int]]:
        """(passage, block of units) where the best weights in the block may sum to ``threshold``."""
        out = []
        step = max(1, BOUND_CELLS // self.n_blocks)
        last = len(starts) - 1
        for low in range(0, last, step):
            high = min(low + step, last)
            inside = slice(starts[low], starts[high])
            sizes = self.block_sizes[term[inside]]
            offsets = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            entry = np.repeat(self.block_starts[term[inside]], sizes) + offsets
            row = np.repeat(passage[inside] - low, sizes)
            bound = np.bincount(row * self.n_blocks + self.block_of[entry], self.block_best[entry], (high - low) * self.n_blocks)
            row, block = np.divmod(np.flatnonzero(bound >= threshold - 1e-9), self.n_blocks)
            out += zip((row + low).tolist(), block.tolist())
        return out

    def matches(self, text: str, threshold: float, question_overlap: float, answer_overlap: float) -> list[tuple]:
        """(item id, score, question overlap, answer overlap, first and last word) of verified items."""
        words = words_of(text)
        out = []
        for place, hits in self.candidates(words, threshold).items():
            item, question, answer = self.items[place]
            size = len(question) + len(answer)
            best = None
            for first, score in hits:
                low, high = max(0, first - size), first + 2 * UNIT_WORDS + size
                near = words[low:high]
                held = grams_held(question, near)
                if len(question) < GRAM_WORDS <= len(answer):
                    said = grams_held(answer, near)
                else:
                    said = len(set(answer) & set(near)) / len(set(answer)) if answer else 1.0
                if held >= question_overlap and said >= answer_overlap and (best is None or (held, said, score) > best[:3]):
                    best = (held, said, score, low, min(high, len(words)))
            if best:
                out.append((item, best[2], best[0], best[1], best[3], best[4]))
        return out


def split_answer(text: Column) -> tuple[Column, Column]:
    """Question and answer of an item in one text: the answer is the last sentence, without a question if it is the only one."""
    plain = F.trim(F.coalesce(text, F.lit("")))
    at = F.length(F.regexp_extract(plain, r"^(?s)(.*[.!?:]\s+)\S", 1))
    return F.substring(plain, F.lit(1), at), F.substring(plain, at + 1, F.length(plain))


def contaminated(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = THRESHOLD, question_overlap: float = QUESTION_OVERLAP, answer_overlap: float = ANSWER_OVERLAP,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """A row for each text and test item it holds: doc_id, item_id, score, overlaps, first_word and last_word of the passage.

    ``items`` has item_id, question and answer. The index of a pass is built from at
    most ``index_bytes`` of items and broadcast; a larger benchmark takes more passes.
    Each has the statistics of all items, for its own words: passes change no score.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    items = items.select("item_id", "question", "answer")
    size = F.octet_length(F.coalesce("question", F.lit(""))) + F.octet_length(F.coalesce("answer", F.lit("")))
    total = items.agg(F.sum(size + 64)).first()[0] or 0
    passes = max(1, -(-2 * total // index_bytes)) if total > index_bytes else 1
    item_type = items.schema["item_id"].dataType.simpleString()
    schema = (
        f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, item_id {item_type}, score double, "
        "question_overlap double, answer_overlap double, first_word bigint, last_word bigint"
    )
    names = ["item_id", "score", "question_overlap", "answer_overlap", "first_word", "last_word"]
    whole = stored(_word_counts(items), "benchmark-words") if passes > 1 else None
    out = None
    for part in range(passes):
        chosen = items.where(F.pmod(F.xxhash64("question", "answer"), F.lit(passes)) == part) if passes > 1 else items
        rows = sorted((tuple(r) for r in chosen.collect()), key=str)
        statistics = None
        if passes > 1:
            own = _word_counts(chosen).select(F.col("word").alias("own"))
            counts = whole.join(own, F.col("word").eqNullSafe(F.col("own")), "left_semi").collect()
            sums = next((r for r in counts if r["word"] is None), None)
            statistics = (sums["units"], sums["words"], {r["word"]: r["units"] for r in counts if r["word"] is not None}) if sums else None
        shared = spark.sparkContext.broadcast((rows, statistics))
        found = texts.mapInArrow(_searcher(shared, names, threshold, question_overlap, answer_overlap), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _word_counts(items: DataFrame) -> DataFrame:
    """word, units that hold it; the word NULL has the numbers of all units and of their words."""

    def count(batches):
        for batch in batches:
            questions, answers = (batch.column(c).to_pylist() for c in ("question", "answer"))
            units = [u for q, a in zip(questions, answers) for u in units_of(words_of(q or "") + words_of(a or ""))]
            n_units, n_words, frequency = unit_statistics(units)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *frequency], pa.string()), pa.array([n_units, *frequency.values()], pa.int64()), pa.array([n_words] + [0] * len(frequency), pa.int64())],
                ["word", "units", "words"],
            )

    counted = items.select("question", "answer").mapInArrow(count, "word string, units bigint, words bigint")
    return counted.groupBy("word").agg(F.sum("units").alias("units"), F.sum("words").alias("words"))


def _searcher(shared, names, threshold, question_overlap, answer_overlap):
    def search(batches):
        index = ItemIndex(*shared.value)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows, found = [], []
                for i, raw in enumerate(texts):
                    matches = index.matches(raw.decode(), threshold, question_overlap, answer_overlap)
                    rows += [i] * len(matches)
                    found += matches
                columns = list(zip(*found)) if found else [()] * len(names)
                kinds = [None, *[pa.float64()] * 3, *[pa.int64()] * 2]
                arrays = [part.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
                if found:
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

    return search


def remove_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **thresholds) -> DataFrame:
    """The rows of ``docs`` that hold no test item. Rows with a NULL id are judged by their text like any other."""
    row, own_hash, own_id = fresh(docs, "_row"), fresh(docs, "_hash"), fresh(docs, "_id")
    hits = contaminated(
        docs.withColumn(row, F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("hash"))), items, row, text_column, **thresholds)
    found = hits.select(F.col("doc_id.hash").alias(own_hash), F.col("doc_id.id").alias(own_id)).distinct()
    same = F.col(id_column).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_column) == F.col(own_hash))
    return docs.join(found, same, "left_anti")
