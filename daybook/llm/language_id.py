"""Language identification with interpolated Kneser-Ney character models.

A text becomes lower-case letters, every run of anything else one space. Four
16-bit character codes packed into 64 bits are the key of a 4-gram, so keys are
exact hashes. Spark counts the 4-grams of all training texts; lower orders are
continuation counts derived from them. All 4-grams are kept. They are dealt into
shards by the two characters in their middle, so that a shard holds all that the
orders 4 and 3 of its 4-grams need; executors turn each into sorted arrays of keys
and probabilities, looked up by binary search. A task holds one shard at a time
and sums log probabilities shard by shard. The language of the lowest
cross-entropy per character is chosen; a text whose entropy is above what its
language's training texts reach is marked as rejected.

Defined results: a text that is NULL or has no letter is ``und`` with score 0; one
letter is enough for a verdict; equal rows are judged one by one; rows without a
language train nothing; an empty table gives no rows, and so does training on no
labelled rows for texts with letters: they are ``und`` too.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices, stored

ORDER = 4
SCORE_SLICE = 1_000_000
#: 4-grams times languages in one shard of the model; more take more shards, with the same results.
SHARD_CELLS = 4_000_000
#: Slices whose 4-grams are held while the shards of a model are read in turn.
GROUP_SLICES = 8
#: A factor below 2**30, so that its product with a 32-bit pair of characters is a 64-bit number.
PAIR_FACTOR = 0x2545F491
#: Different values of one language that the driver takes at once, and intervals that more of them are dealt into.
QUANTILE_VALUES, QUANTILE_PARTS = 2_000, 500
REJECTION_QUANTILE, REJECTION_SLACK = 0.999, 1.15
SCORE_CHARACTERS = 40
UNKNOWN = "und"
EDGE, SPACE = 2, 32

_codes: list[np.ndarray] = []


def character_codes() -> np.ndarray:
    """The 16-bit code of every code point: letters fold to 16 bits, all else is a space."""
    if not _codes:
        points = np.arange(0x110000)
        letter = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
        folded = np.where(points < 0x10000, points, 0x8000 | (points & 0x7FFF))
        codes = np.where(letter, folded, SPACE).astype(np.uint16)
        codes[EDGE] = EDGE
        _codes.append(codes)
    return _codes[0]


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram keys of all texts in turn, how many each text has, and how many letters."""
    marked = [f"\x02\x02\n{t.decode().lower()}\n" for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4")
    codes = character_codes()[points]
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, marked), np.int64, len(texts)))
    space = codes == SPACE
    double = np.zeros(len(codes), bool)
    double[1:] = space[1:] & space[:-1] & (owner[1:] == owner[:-1])
    codes, owner = codes[~double].astype(np.uint64), owner[~double]
    letters = np.bincount(owner[(codes != SPACE) & (codes != EDGE)], minlength=len(texts))
    if len(codes) < ORDER:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64), letters
    keys = (codes[:-3] << np.uint64(48)) | (codes[1:-2] << np.uint64(32)) | (codes[2:-1] << np.uint64(16)) | codes[3:]
    whole = owner[:-3] == owner[3:]
    return keys[whole], np.bincount(owner[:-3][whole], minlength=len(texts)), letters


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def discount_of(ones: int, twos: int) -> float:
    return float(ones / (ones + 2 * twos)) if ones else 0.5


@dataclass
class Order:
    """One order of a model: discounted shares by key, and back-off weights by context."""

    keys: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, discount: float | None = None) -> "Order":
        if discount is None:
            discount = discount_of((counts == 1).sum(), (counts == 2).sum())
        contexts, owner = np.unique(keys >> np.uint64(16), return_inverse=True)
        totals = np.bincount(owner, counts)
        shares = np.maximum(counts - discount, 0) / totals[owner]
        return cls(keys, shares, contexts, discount * np.bincount(owner) / totals)


@dataclass
class KneserNey:
    """The model of one language, from its 4-gram keys (sorted) and counts.

    In a shard the keys are those of the shard; ``discounts`` of the orders 4 and 3
    and the orders ``low`` (2 and 1) are then those of the whole language.
    """

    keys: np.ndarray
    counts: np.ndarray
    discounts: tuple[float, ...] = ()
    low: tuple[Order, ...] = ()
    orders: list[Order] = field(default_factory=list)

    def __post_init__(self):
        keys, counts = self.keys, self.counts.astype(float)
        for order in range(ORDER, len(self.low), -1):
            self.orders.append(Order.of(keys, counts, self.discounts[ORDER - order] if self.discounts else None))
            # continuation counts: in how many distinct longer keys each shorter one ends
            keys, counts = np.unique(keys & np.uint64((1 << (16 * (order - 1))) - 1), return_counts=True)
            counts = counts.astype(float)
        self.orders += self.low

    def log2(self, wanted: np.ndarray) -> np.ndarray:
        """Interpolated log probabilities (base 2) of the last character given the ones before."""
        out = np.full(len(wanted), 2.0**-16)
        for order in range(1, ORDER + 1):
            level = self.orders[ORDER - order]
            key = wanted & np.uint64((1 << (16 * order)) - 1) if order < ORDER else wanted
            at, there = find(level.keys, key)
            above, known = find(level.contexts, key >> np.uint64(16))
            share = np.where(there, level.shares[at] if len(level.shares) else 0, 0)
            weight = np.where(known, level.weights[above] if len(level.weights) else 1, 1)
            out = share + weight * out
        return np.log2(np.maximum(out, 2.0**-40))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 4-gram, from its second and third character; as ``shard_column``."""
    pairs = (keys >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
    return ((pairs * np.uint64(PAIR_FACTOR) >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def shard_column(shards: int) -> Column:
    pairs = F.shiftright("key", 16).bitwiseAND(F.lit(0xFFFFFFFF))
    return (F.shiftright(pairs * F.lit(PAIR_FACTOR), 20) % F.lit(shards)).cast("int")


@dataclass
class Shard:
    """Models of all languages in one shard, with one table of the keys that any of them knows there."""

    models: list[KneserNey]

    def __post_init__(self):
        self.keys = np.unique(np.concatenate([m.keys for m in self.models]))
        self.table = np.stack([m.log2(self.keys) for m in self.models]).astype(np.float32)
        for model in self.models:
            model.keys = model.counts = np.empty(0, np.uint64)

    def add_bits(self, bits: np.ndarray, unique: np.ndarray, place: np.ndarray, owner: np.ndarray) -> None:
        """Take the log probabilities of the 4-grams ``unique[place]`` off ``bits`` (text, language)."""
        at, there = find(self.keys, unique)
        for j, model in enumerate(self.models):
            values = np.where(there, self.table[j][at] if len(self.keys) else 0, 0).astype(np.float64)
            values[~there] = model.log2(unique[~there])
            bits[:, j] -= np.bincount(owner, values[place], minlength=len(bits))


@dataclass
class Model:
    """Languages, the broadcast shards of their models, and the entropies that reject."""

    languages: list[str]
    shards: list[Broadcast]
    levels: np.ndarray | None = None


def opened(shared: Broadcast) -> Shard:
    """The shard, read anew and not kept by the worker, so that it holds one at a time."""
    path = getattr(shared, "_path", None)
    return shared.load_from_path(path) if path else shared.value


def entropies(shards: list[Broadcast], languages: int, slices_of_texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice: bits per character in each language, by text; characters and letters of each text."""
    held = []
    for texts in slices_of_texts:
        keys, sizes, letters = grams(texts)
        unique, place = np.unique(keys, return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), sizes)
        held.append((np.zeros((len(texts), languages)), sizes, letters, unique, place, owner, shard_of(unique, max(1, len(shards)))))
    for number, shared in enumerate(shards):
        shard = opened(shared) if len(shards) > 1 else shared.value
        for bits, _, _, unique, place, owner, which in held:
            own = which == number
            if own.all():
                shard.add_bits(bits, unique, place, owner)
            elif own.any():
                inside = own[place]
                shard.add_bits(bits, unique[own], (np.cumsum(own) - 1)[place[inside]], owner[inside])
    return [(bits / np.maximum(sizes, 1)[:, None], sizes, letters) for bits, sizes, letters, *_ in held]


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, key, n over all rows of (lang, text): counted in each task first, then summed."""

    def count(batches):
        held: dict[str, list[np.ndarray]] = {}

        def flush():
            for lang, (keys, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "key", "n"]
                )
            held.clear()

        for batch in batches:
            for part, texts in slices(batch, "text", SCORE_SLICE):
                langs = np.asarray(part.column("lang").to_pylist(), object)
                for lang in sorted(set(langs)):
                    keys, counts = np.unique(grams([texts[i] for i in np.flatnonzero(langs == lang)])[0], return_counts=True)
                    if lang in held:
                        all_keys = np.concatenate([held[lang][0], keys])
                        all_counts = np.concatenate([held[lang][1], counts])
                        keys, place = np.unique(all_keys, return_inverse=True)
                        counts = np.bincount(place, all_counts).astype(np.int64)
                    held[lang] = [keys, counts]
                if sum(len(k) for k, _ in held.values()) > 1_000_000:
                    yield from flush()
        yield from flush()

    counted = labelled.mapInArrow(count, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def least_hashed(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows (lang, text) with the least hashes of their texts, ties by language.

    Only rows below a hash that some four times as many are expected to stay under are sorted, so
    that what the sort brings together does not grow with the table; if too few are there, as when few
    texts are copied often, all rows are sorted.
    """
    order = F.xxhash64("text"), F.col("lang")
    total = rows.count()
    if total > 4 * most:
        bound = int(4 * most / total * 2**64) - 2**63
        least = stored(rows.where(order[0] < bound).orderBy(*order).limit(most), "language-sample")
        if least.count() == most:
            return least
    return rows.orderBy(*order).limit(most)


def quantiles(rows: DataFrame, share: float, most: int = QUANTILE_VALUES) -> dict[str, float]:
    """Per ``lang`` the exact quantile of ``bits`` (finite, not NULL) over all rows, interpolated as numpy does.

    Values are counted where they lie. An interval that holds the wanted ranks is cut into parts,
    whose counts alone come to the driver, until few different values are left in it.
    """
    counts = stored(rows.groupBy("lang", "bits").agg(F.count("*").alias("n")), "language-bits")
    ranges = counts.groupBy("lang").agg(F.sum("n").alias("n"), F.min("bits").alias("low"), F.max("bits").alias("high"), F.count("*").alias("values"))
    out, open_ranks = {}, {}
    for r in ranges.collect():
        at = share * (r["n"] - 1)
        for rank in {int(np.floor(at)), int(np.ceil(at))}:
            open_ranks[r["lang"], rank] = (r["low"], r["high"], 0, r["values"])
        out[r["lang"]] = at
    found: dict[tuple[str, int], float] = {}
    while open_ranks:
        for (lang, rank), (low, high, before, values) in list(open_ranks.items()):
            inside = counts.where((F.col("lang") == lang) & F.col("bits").between(low, high))
            if values <= most or low == high:
                for value, n in sorted((r["bits"], r["n"]) for r in inside.select("bits", "n").collect()):
                    before += n
                    if before > rank:
                        found[lang, rank] = value
                        break
                del open_ranks[lang, rank]
                continue
            part = F.least(F.floor((F.col("bits") - low) / (high - low) * QUANTILE_PARTS), F.lit(QUANTILE_PARTS - 1))
            parts = inside.groupBy(part.alias("part")).agg(
                F.sum("n").alias("n"), F.min("bits").alias("low"), F.max("bits").alias("high"), F.count("*").alias("values")
            )
            for r in sorted(parts.collect(), key=lambda r: r["part"]):
                if before + r["n"] > rank:
                    open_ranks[lang, rank] = (r["low"], r["high"], before, r["values"])
                    break
                before += r["n"]
    for lang, at in out.items():
        low, high = found[lang, int(np.floor(at))], found[lang, int(np.ceil(at))]
        out[lang] = float(np.quantile([low, high], at - np.floor(at)))
    return out


def fit(labelled: DataFrame, lang_column: str = "lang", text_column: str = "text", cells: int = SHARD_CELLS) -> Model:
    """Models from all rows with a language and a text, with all their 4-grams.

    Shards of about ``cells`` 4-grams times languages are built by executors; to the
    driver come sums by language, counts of character pairs, and one shard at a time.
    Rejection levels come from the entropies of all these rows that get their own language.
    """
    rows = labelled.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text")).dropna()
    counts = stored(count_grams(rows), "language-counts")
    ones, twos = (F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2))
    sums = {r["lang"]: r for r in counts.groupBy("lang").agg(F.count("*").alias("keys"), ones.alias("ones"), twos.alias("twos")).collect()}
    languages = sorted(sums)
    model = Model(languages, _shards(counts, sums, languages, cells) if languages else [])
    own = classify(rows.withColumn("doc_id", F.lit(0)), model, keep=("lang",)).where("lang = lang_pred")
    reached = quantiles(own, REJECTION_QUANTILE)
    model.levels = np.asarray([reached[lang] * REJECTION_SLACK if lang in reached else np.inf for lang in languages])
    return model


def _shards(counts: DataFrame, sums: dict, languages: list[str], cells: int) -> list[Broadcast]:
    """The broadcast shards of the models, from ``counts`` (lang, key, n) and their sums by language."""
    context = counts.sparkSession.sparkContext
    number = max(1, -(-len(languages) * sum(r["keys"] for r in sums.values()) // cells))
    ones, twos = (F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2))
    triples = counts.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 48) - 1)).alias("key")).agg(F.count("*").alias("n"))
    pairs = triples.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("key")).agg(F.count("*").alias("n"), ones.alias("ones"), twos.alias("twos"))
    table = pairs.toPandas()
    given = []
    for lang in languages:
        own = table[table["lang"] == lang].sort_values("key")
        two = own["key"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy(float)
        one = np.unique(two[0] & np.uint64(0xFFFF), return_counts=True)
        low = Order.of(*two), Order.of(one[0], one[1].astype(float))
        given.append(((discount_of(sums[lang]["ones"], sums[lang]["twos"]), discount_of(own["ones"].sum(), own["twos"].sum())), low))
    known = context.broadcast(given)

    def build(rows: pa.Table) -> pa.Table:
        langs = np.asarray(rows.column("lang").to_pylist(), object)
        keys, n = rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy()
        models = []
        for lang, (discounts, low) in zip(languages, known.value):
            own = np.flatnonzero(langs == lang)
            own = own[np.argsort(keys[own])]
            models.append(KneserNey(keys[own], n[own], discounts, low))
        data = pickle.dumps(Shard(models), pickle.HIGHEST_PROTOCOL)
        return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "data": pa.array([data], pa.binary())})

    built = stored(counts.withColumn("shard", shard_column(number)).groupBy("shard").applyInArrow(build, "shard int, data binary"), "language-shards")
    # a shard without any key has no row: its languages know their low orders only
    bare = [KneserNey(np.empty(0, np.uint64), np.empty(0, np.int64), *g) for g in given]
    shards = []
    for k in range(number):
        row = built.where(F.col("shard") == k).select("data").first()
        shards.append(context.broadcast(pickle.loads(row["data"]) if row else Shard(bare)))
    return shards


def classify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, lang_pred, score, bits (per character) and rejected, for every row."""
    source = docs.select(F.col(id_column).alias("doc_id"), *keep, F.col(text_column).alias("text"))
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    languages, shards, levels = model.languages, model.shards, model.levels
    names = np.asarray([*languages, UNKNOWN], object)

    def judged(parts):
        for (part, _), (bits, sizes, letters) in zip(parts, entropies(shards, len(languages), [texts for _, texts in parts])):
            known = (letters > 0) & (len(languages) > 0)
            if languages:
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                spread = np.exp2(-(bits - least[:, None]) * np.minimum(sizes, SCORE_CHARACTERS)[:, None])
                score = 1 / spread.sum(axis=1)
                rejected = least > levels[best] if levels is not None else np.zeros(part.num_rows, bool)
            else:
                best, least, score, rejected = np.zeros((4, part.num_rows))
            columns = [
                pa.array(names[np.where(known, best, len(languages)).astype(int)], pa.string()),
                pa.array(np.where(known, score, 0.0)),
                pa.array(np.where(known, least, 0.0)),
                pa.array(~known | rejected.astype(bool)),
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *columns], [*part.schema.names[:-1], "lang_pred", "score", "bits", "rejected"]
            )

    def judge(batches):
        parts, group = [], GROUP_SLICES if len(shards) > 1 else 1
        for batch in batches:
            for sliced in slices(batch, "text", SCORE_SLICE):
                parts.append(sliced)
                if len(parts) == group:
                    yield from judged(parts)
                    parts = []
        yield from judged(parts)

    return source.mapInArrow(judge, f"{given}, lang_pred string, score double, bits double, rejected boolean")
