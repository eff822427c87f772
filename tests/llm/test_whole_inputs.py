"""Levels from all rows, and batches read a part at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daybook.llm import jaccard_join, language_id
from daybook.llm.batches import slices


def test_quantiles_are_those_of_all_rows(spark):
    random = np.random.default_rng(5)
    values = {"a": random.normal(4, 1, 900).round(4), "b": np.full(50, 2.5), "c": np.array([1.0]), "d": np.append(random.random(300), 1e6)}
    rows = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v], "lang string, bits double")
    for share in (0.999, 0.5, 0.0, 1.0):
        got = language_id.quantiles(rows, share, most=3)
        assert got.keys() == values.keys()
        for lang, v in values.items():
            assert got[lang] == np.quantile(v, share)
    assert language_id.quantiles(rows.where("false"), 0.999) == {}


def test_rejection_levels_come_from_all_rows(spark):
    random = np.random.default_rng(7)
    words = ["alpha", "river", "stone", "cloud", "amber", "field", "quiet", "north"]
    texts = [" ".join(random.choice(words, random.integers(1, 9))) for _ in range(2_600)]
    rows = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    model = language_id.fit(rows)
    bits = language_id.classify(rows.withColumn("doc_id", F.lit(0)), model, keep=("lang",)).toPandas()["bits"]
    assert model.levels[0] == np.quantile(bits, language_id.REJECTION_QUANTILE) * language_id.REJECTION_SLACK


def test_slices_hold_one_part_at_a_time():
    texts = [b"x" * 10_000 if i % 7 else None for i in range(1_400)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    tracemalloc.start()
    got = []
    for part, raw in slices(batch, "text", 100_000):
        assert part.num_rows == len(raw) and sum(map(len, raw)) <= 100_000
        got += map(len, raw)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [len(t or b"") for t in texts] and peak < 2_000_000
    assert not list(slices(batch.slice(0, 0), "text"))


def test_sets_that_share_frequent_hashes_only_are_not_compared():
    rng = np.random.default_rng(3)
    crowd = np.arange(50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([crowd, rng.integers(100, 1 << 60, 40).astype(np.uint64)])) for _ in range(300)]
    sets += [np.sort(np.append(s[:-1], np.uint64(7_000 + i))) for i, s in enumerate(sets[:20])]
    tree = jaccard_join.PrefixTree(sets, 80)
    assert sum(len(tree.candidates(i, 80)) for i in range(len(sets))) == 20
    keys = [i.to_bytes(2) for i in range(len(sets))]
    links = jaccard_join.block_links(keys, sets, [True] * len(sets), 80)
    assert {frozenset(pair) for pair in links} == {frozenset((keys[i], keys[300 + i])) for i in range(20)}
