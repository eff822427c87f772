"""Packing of tokenized documents into sequences by cutting-stock column generation.

A document's ids are cut into pieces of the sequence length and one rest. Rests
are counted by length class. A linear program over patterns (how many rests of
each class share a sequence) is solved by column generation: a knapsack dynamic
program prices the best new pattern from the duals until none is better. Patterns
are rounded down, what they leave is filled first-fit by decreasing length, and
the plan is applied to the ranked rests of each class.

Defined results: NULL text is an empty document (one id, the end marker); equal
rows are packed one by one, ties of length in order of id and start; texts of any length are
cut whole; an empty table gives no rows; no column but the id and the text is read,
so other columns may have any name. A vocabulary file that does not treat words alone
is applied to whole texts, with the same ids and more time.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices, stored

SEQUENCE_TOKENS = 2048
CLASS_TOKENS = 8
TOLERANCE = 0.004
#: Words held by a worker process in each of two generations, about 170 bytes each.
WORDS_KEPT = 600_000
#: New words encoded together.
WORDS_AT_ONCE = 5_000
#: Bytes of text split into words at once.
SPLIT_BYTES = 4_000_000
RANK_BUCKET_ROWS = 20_000

#: A letter, the mark that ends its word, and the end.
MARK = r"([a-z])([.,])([\x20\x09-\x0D]|\z)"

# Parts of a tokenizer file under which a text's ids are those of its lower-case words.
WORD_NORMALIZER = ["NFC", "Replace", "Lowercase"]
WORD_SPACES = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, "TextEncoder"] = {}


def by_words(settings: dict) -> bool:
    """Whether a tokenizer file lower-cases, splits at white space and between letters and marks, and no more.

    Then the ids of a text are the ids of its words in turn, a word's case is
    of no account, and a full stop or comma at its end has an id of its own.
    """
    normalizers = (settings.get("normalizer") or {}).get("normalizers", [])
    splits = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [n.get("type") for n in normalizers] == WORD_NORMALIZER
        and normalizers[1] == WORD_SPACES
        and [p.get("type") for p in splits] == ["Split", "ByteLevel"]
        and splits[0].get("pattern") == {"Regex": WORD_PATTERN}
        and splits[0].get("behavior") == "Removed" and splits[0].get("invert") is True
        and not splits[1].get("add_prefix_space") and not splits[1].get("use_regex")
        and settings["model"].get("dropout") is None
    )


class TextEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, whatever the vocabulary file asks for."""

    def __init__(self, path: str):
        # Threads of the tokenizer would compete with the other tasks of the executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        return self.encoded([t.decode() for t in texts])


class WordEncoder(TextEncoder):
    """The same ids for files that ``by_words`` accepts, from words encoded once each.

    Words are held in lower case and without the mark at their end, in two
    generations: when the newer is full it becomes the older, and words met again
    move to the newer, so that frequent words stay. New words are encoded many at
    once with a special token between them, where their ids are cut apart. Texts that spell
    a special token, which is matched as written, are encoded whole.
    """

    def __init__(self, path: str):
        super().__init__(path)
        special = [(i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.special = [t.content.encode().lower() for _, t in special]
        self.between = next(((i, t.content) for i, t in special if t.special and not t.normalized and not t.lstrip and not t.rstrip), None)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Hold the ids of all ``words`` in the newer generation."""
        absent = words.difference(self.words)
        if len(self.words) + len(absent) > WORDS_KEPT:
            self.older, self.words = self.words, {}
            absent = words
        older = self.older.get
        known = {w: ids for w in absent if (ids := older(w)) is not None}
        self.words.update(known)
        new = [w for w in absent if w not in known]
        for start in range(0, len(new), WORDS_AT_ONCE):
            part = new[start : start + WORDS_AT_ONCE]
            self.words.update(zip(part, self.encoded_apart([w.decode() for w in part])))

    def encoded_apart(self, words: list[str]) -> list[bytes]:
        if self.between is None:
            return self.encoded(words)
        number, text = self.between
        ids = np.asarray(self.tokenizer.encode_batch_fast([text.join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == number)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(4 * (cuts + 1)).tolist()], [*(4 * cuts).tolist(), len(data)])]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if any(s in t.lower() for s in self.special)]
        plain = list(texts)
        for i in whole:
            plain[i] = b""
        lower = pc.ascii_lower(pa.array(plain, pa.large_binary()).view(pa.large_string())).view(pa.large_binary())
        parts = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, MARK, r"\1 \2\3").view(pa.large_string()))
        bounds = parts.offsets.to_numpy()
        numbered = parts.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        different = numbered.dictionary.view(pa.large_binary()).to_pylist()
        word = numbered.indices.to_numpy()
        self.learn(set(different))
        held = list(map(self.words.__getitem__, different))
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        data = np.frombuffer(b"".join(held), "<u4")
        size = sizes[word]
        ends = np.concatenate(([0], np.cumsum(size)))
        first = (np.cumsum(sizes) - sizes)[word]
        every = data[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        cuts = ends[bounds].tolist()
        out = [every[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for i in whole:
            out[i] = self.encoded([texts[i].decode()])[0]
        return out


def encoder(path: str) -> TextEncoder:
    """One encoder for each worker process and vocabulary file."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            words = by_words(json.load(file))
        _encoders[path] = WordEncoder(path) if words else TextEncoder(path)
    return _encoders[path]


def id_type(vocabulary: str) -> str:
    """The least of 16 and 32 bits that holds every id of a vocabulary file, as a little-endian type."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, size: int = SEQUENCE_TOKENS,
    id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Tokenize whole texts and cut them: a row for each piece of at most ``size`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, and with ``with_ids``
    the ids as little-endian bytes, two for each id where all ids of the
    vocabulary fit that, else four (``id_type``). The checksum is of four bytes an id either way.
    """
    kind = docs.schema[id_column].dataType
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names) + ", ids binary" * with_ids
    width = id_type(vocabulary) if with_ids and int(end_id) < 1 << 16 else "<u4"

    def cut(batches):
        end = int(end_id).to_bytes(4, "little")
        words = encoder(vocabulary)
        for batch in batches:
            for part, texts in slices(batch, "text", SPLIT_BYTES):
                rows, columns, pieces = [], [], []
                for i, ids in enumerate(words.ids(texts)):
                    ids += end
                    for at in range(0, len(ids), 4 * size):
                        piece = ids[at : at + 4 * size]
                        rows.append(i)
                        columns.append((at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                        if with_ids:
                            pieces.append(np.frombuffer(piece, "<u4").astype(width).tobytes())
                arrays = [part.column("doc_id").take(pa.array(rows, pa.int64()))]
                arrays += [pa.array(c, pa.int64()) for c in np.asarray(columns, np.int64).reshape(-1, 4).T]
                if with_ids:
                    arrays.append(pa.array(pieces, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names] + ["ids"] * with_ids)

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(cut, schema)


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of classes 1..n that fits ``capacity``: unbounded knapsack by dynamic programming."""
    n = len(values)
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        k = min(n, c)
        worth = best[c - 1 :: -1][:k] + values[:k]
        j = int(worth.argmax())
        if worth[j] > best[c - 1] + 1e-12:
            best[c], pick[c] = worth[j], j + 1
        else:
            best[c] = best[c - 1]
    counts = np.zeros(n, np.int64)
    c = capacity
    while c > 0:
        if pick[c]:
            counts[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def cutting_stock(demand: np.ndarray, capacity: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and their real-valued counts that cover ``demand`` with nearly the fewest sequences.

    ``demand[j]`` is the number of rests of class j + 1. A revised simplex keeps
    the inverse of the basis; columns come from ``best_pattern``. It ends when
    Farley's bound proves the sequences to be within ``tolerance`` of the optimum,
    or when a round of as many steps as there are classes gains less than a tenth
    of that. Demands are raised a little, each differently, against cycling.
    """
    used = np.flatnonzero(demand)
    m = len(used)
    basis = np.zeros((m, m))
    sizes = used + 1
    np.fill_diagonal(basis, capacity // sizes)
    inverse = np.diag(1.0 / (capacity // sizes))
    wanted = demand[used] + 1e-3 * (1 + np.arange(m) * 0.6180339887 % 1)
    x = wanted * np.diag(inverse)
    values = np.zeros(int(sizes[-1]))
    before = np.inf
    for step in range(50 * m):
        if step % m == 0:
            if x.sum() > before * (1 - tolerance / 10):
                break
            before = x.sum()
        duals = inverse.sum(axis=0)
        values[:] = 0
        values[used] = np.maximum(duals, 0)
        worth, counts = best_pattern(values, capacity)
        if worth <= 1 + tolerance:
            break
        column = counts[used].astype(float)
        direction = (inverse * column).sum(axis=1)
        rising = direction > 1e-9
        if not rising.any():
            break
        ratios = np.full(m, np.inf)
        ratios[rising] = x[rising] / direction[rising]
        r = int(ratios.argmin())
        amount = ratios[r]
        x = np.maximum(x - amount * direction, 0)
        x[r] = amount
        pivot = inverse[r] / direction[r]
        inverse = inverse - np.outer(direction, pivot)
        inverse[r] = pivot
        basis[:, r] = column
    patterns = np.zeros((m, len(demand)), np.int64)
    patterns[:, used] = np.rint(basis.T).astype(np.int64)
    return patterns, x


def packing_plan(demand: dict[int, int], capacity: int, tolerance: float = TOLERANCE) -> list[tuple[int, int, int, int, int]]:
    """Whole numbers of sequences for each pattern: rows (class, first_rank, last_rank, each, first_sequence).

    Rests of a class with ranks first_rank..last_rank go to sequences from
    first_sequence on, ``each`` to a sequence.
    """
    if not demand:
        return []
    left = np.zeros(max(demand), np.int64)
    for size, count in demand.items():
        left[size - 1] = count
    chosen: list[tuple[np.ndarray, int]] = []
    patterns, x = cutting_stock(left, capacity, tolerance)
    for pattern, amount in sorted(zip(patterns, x), key=lambda p: -p[1]):
        fits = int(min(int(amount + 1e-6), *(left[pattern > 0] // pattern[pattern > 0]))) if pattern.any() else 0
        if fits > 0:
            chosen.append((pattern, fits))
            left -= pattern * fits
    while left.any():  # what rounding left: the longest first, as many of each as fit
        pattern, room = np.zeros_like(left), capacity
        for j in np.flatnonzero(left)[::-1]:
            take = min(int(left[j]), room // (j + 1))
            pattern[j] = take
            room -= take * (j + 1)
        fits = int((left[pattern > 0] // pattern[pattern > 0]).min())
        chosen.append((pattern, fits))
        left -= pattern * fits
    rows, ranks, sequence = [], np.zeros(len(left), np.int64), 0
    for pattern, count in chosen:
        for j in np.flatnonzero(pattern):
            each = int(pattern[j])
            rows.append((int(j) + 1, int(ranks[j]), int(ranks[j]) + each * count - 1, each, sequence))
            ranks[j] += each * count
        sequence += count
    return rows


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS, width: int = CLASS_TOKENS, tolerance: float = TOLERANCE) -> DataFrame:
    """Give every piece its ``sequence_id`` and gapless ``offset``, and each sequence's ``padding``.

    ``pieces`` has doc_id, start and length (at most ``size``) and any other
    columns. Pieces are counted and ranked within hashed buckets of a class, so
    that many documents of one length are spread over tasks; only the counts by
    class, at most ``size / width`` rows, reach the driver. A sequence is padded
    to ``size``, except where its length is a power of two.
    """
    spark = pieces.sparkSession
    capacity = size // width
    classed = pieces.withColumn("_class", F.ceil(F.col("length") / width).cast("int"))
    histogram = {r["_class"]: r["n"] for r in classed.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        packing_plan(histogram, capacity, tolerance),
        "_class int, first_rank bigint, last_rank bigint, each bigint, first_sequence bigint",
    )
    buckets = max(64, sum(histogram.values()) // RANK_BUCKET_ROWS)
    classed = classed.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32"), F.lit(buckets)))
    # ranks before a bucket: a running sum over at most ``buckets`` counts of a class
    counts = classed.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_class").orderBy("_bucket")
    before = counts.select("_class", "_bucket", (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    rank = Window.partitionBy("_class", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        classed.withColumn("_rank", F.row_number().over(rank) - 1)
        .join(before, ["_class", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    # a plan has a row for each class of a pattern, at most (size / width) ** 2 rows whatever the input
    placed = (
        ranked.alias("p")
        .join(
            F.broadcast(plan).alias("q"),
            (F.col("p._class") == F.col("q._class")) & F.col("_rank").between(F.col("first_rank"), F.col("last_rank")),
        )
        .withColumn("sequence_id", F.col("first_sequence") + F.floor((F.col("_rank") - F.col("first_rank")) / F.col("each")))
        .select("p.*", "sequence_id")
    )
    within = Window.partitionBy("sequence_id")
    running = within.orderBy(F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, 0)
    fill = F.sum("length").over(within)
    return placed.select(
        *pieces.columns,
        "sequence_id",
        (F.sum("length").over(running) - F.col("length")).alias("offset"),
        F.when(F.bit_count(fill) == 1, 0).otherwise(size - fill).cast("bigint").alias("padding"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, size: int = SEQUENCE_TOKENS, **columns) -> DataFrame:
    """Tokenize, cut and pack whole documents. The pieces are stored once and read for the counts, ranks and rows.

    Ids, where asked for, stay out of counting and ranking: pieces get a number when they are
    stored, and the placed numbers meet the stored ids in one join.
    """
    pieces = token_pieces(docs, vocabulary, end_id, size, **columns)
    if "ids" not in pieces.columns:
        return pack(stored(pieces, "pieces"), size)
    pieces = stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.drop("ids"), size)
    return placed.join(pieces.select("piece", "ids"), "piece").drop("piece")
