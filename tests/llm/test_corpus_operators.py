"""Operators that compare rows with each other, against brute force on small fixtures."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from daybook.llm import jaccard_join, repeats, substring_dedup, suffix_dedup
from daybook.llm.batches import minimizers, windows
from daybook.llm.registry import prepared

SCHEMA = "doc_id bigint, text string, lang string, key string, n bigint, anchor bigint, spans string, label string"


@pytest.fixture(autouse=True)
def shipped(spark):
    prepared(spark)


def table(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "k", 1, 2, "s", None) for i, t in zip(ids, texts)], SCHEMA)


def words(rng, n, pool=4000):
    return [f"w{i}" for i in rng.integers(0, pool, n)]


def corpus():
    """Random texts with exact and near copies, shared passages, repeated lines, empties and a long one."""
    rng = np.random.default_rng(11)
    texts = [None, None, "", " \t", "one", "one", "One", "a b c d", "é ü ß " * 90, "x " * 400]
    passage = words(rng, 60)
    for i in range(30):
        own = words(rng, int(rng.integers(20, 220)))
        at = int(rng.integers(0, len(own)))
        texts.append(" ".join(own[:at] + passage * (i % 2) + own[at:]))
    base = words(rng, 200)
    for i in range(25):  # edits of one text, some similar to each other, some to few
        edited = list(base)
        for at in rng.integers(0, 200, int(rng.integers(0, 7))):
            edited[at] = f"e{i}"
        texts.append(" ".join(edited))
    texts += texts[12:16] + [" ".join(words(rng, 9_000, 400))]
    return texts


def shingles(text):
    parts = (text or "").encode().lower().split()
    return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def brute_groups(texts, percent=80):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label, [len(s) for s in sets]


def test_windows_and_minimizers():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 300).astype(np.uint64)
    for size in (1, 2, 3, 5, 8, 13, 35):
        hashes = windows(values, size)
        runs = [tuple(values[i : i + size]) for i in range(len(values) - size + 1)]
        assert len(hashes) == len(runs)
        assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))
    order = windows(values, 4)
    place, first, last = minimizers(order, 20)
    assert first[0] == 0 and last[-1] == len(order) - 20 and (first[1:] == last[:-1] + 1).all()
    for p, a, b in zip(place, first, last):
        for run in (a, b):
            assert p == run + int(order[run : run + 20].argmin())


def test_equal_runs_pick_equal_places_in_texts_of_any_length():
    """Hashes that agree in their upper bits are told apart in long texts as in short ones."""
    rng = np.random.default_rng(3)
    run = np.full(40, 1 << 62, np.uint64)
    run[[10, 20]] = [(1 << 40) + 5, (1 << 40) + 2]
    long = np.concatenate((rng.integers(1 << 50, 1 << 63, 100_000).astype(np.uint64), run, rng.integers(1 << 50, 1 << 63, 500).astype(np.uint64)))
    place, first, last = minimizers(run, 30)
    assert place.tolist() == [20]
    place, first, last = minimizers(long, 30)
    assert 100_020 in place and 100_010 not in place[(first >= 100_000) & (first <= 100_010)]
    for p, a, b in zip(place, first, last):
        for k in (a, b):
            assert p == k + int(long[k : k + 30].argmin())


@pytest.mark.parametrize("block", [1_000, 3])
def test_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    texts = corpus()
    rows = sorted(jaccard_join.similar_groups(table(spark, texts)).collect())
    label, sizes = brute_groups(texts)
    assert [(r.n_shingles, r.component_id) for r in rows] == list(zip(sizes, label))


def test_groups_of_odd_rows(spark):
    docs = table(spark, ["a b c d e f", "a b c d e f", None, "q r s", "a b c d e f"], [None, 7, None, 7, 5])
    rows = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(docs).collect())
    assert rows == Counter([(None, 2, 5), (7, 2, 5), (5, 2, 5), (None, 0, None), (7, 1, 7)])
    assert jaccard_join.similar_groups(docs.limit(0)).collect() == []


def test_one_of_each_group(spark):
    texts = corpus()
    docs = table(spark, texts)
    kept = jaccard_join.one_of_each_group(docs)
    label, _ = brute_groups(texts)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))
    again = table(spark, ["a b c d e f", "a b c d e f", None, "q r s", "a b c d e f"], [7, 7, None, 7, 5])
    assert sorted((r.doc_id or 0, r.text or "") for r in jaccard_join.one_of_each_group(again).collect()) == [(0, ""), (5, "a b c d e f"), (7, "q r s")]


def covered(sequences, least):
    """Places covered by runs of ``least`` items that start at two places or more."""
    count = Counter(tuple(s[i : i + least]) for s in sequences for i in range(len(s) - least + 1))
    return [
        {k for i in range(len(s) - least + 1) if count[tuple(s[i : i + least])] > 1 for k in range(i, i + least)} for s in sequences
    ]


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_repeated_bytes(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", crowd)
    texts = corpus()[:50]
    raw = [(t or "").encode() for t in texts]
    rows = sorted(suffix_dedup.repeated_bytes(table(spark, texts)).collect())
    for r, text, gone in zip(rows, raw, covered(raw, 200)):
        kept = bytes(b for i, b in enumerate(text) if i not in gone)
        runs = sum(i - 1 not in gone for i in gone)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(text), len(gone), runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_repeated_words(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", crowd)
    texts = corpus()
    split = [(t or "").encode().split() for t in texts]
    rows = sorted(substring_dedup.repeated_words(table(spark, texts)).collect())
    for r, own, gone in zip(rows, split, covered(split, 35)):
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(own), len(gone), hashlib.sha256(kept).hexdigest())


def test_contexts_without_a_shared_side_are_put_aside():
    gram = b"G" * 32
    rng = np.random.default_rng(5)
    left, right = (bytes(rng.integers(97, 123, 168).astype(np.uint8)) for _ in range(2))
    other = [bytes(rng.integers(97, 123, 168).astype(np.uint8)) for _ in range(4)]
    rows = [(left + gram + right, 1, 168, b"a"), (left[-90:] + gram + other[0][:100], 1, 90, b"b"), (other[1] + gram + right[:85], 1, 168, b"c"),
            (other[2] + gram + other[3], 1, 168, b"d"), (other[0] + gram + other[1], 2, 168, b"e"), (left[-83:] + gram + other[2], 1, 83, b"f")]
    kept = [key for _, _, _, key in repeats.with_partners(rows, suffix_dedup.BYTES)]
    assert kept == [b"a", b"b", b"c", b"e"]


def test_repeats_of_nothing(spark):
    empty = table(spark, [])
    assert suffix_dedup.repeated_bytes(empty).collect() == []
    assert substring_dedup.repeated_words(empty).collect() == []
    kept = sorted(substring_dedup.without_repeated_words(table(spark, ["a  b", None, "c " * 40])).collect())
    assert [r.kept for r in kept] == ["a b", "", ""]


def test_suffix_automaton_counts_places():
    rng = np.random.default_rng(2)
    for _ in range(40):
        texts = [rng.choice(list("ab"), int(rng.integers(1, 14))).tolist() for _ in range(4)]
        automaton = substring_dedup.SuffixAutomaton()
        for text in texts:
            automaton.add(text, 1)
        automaton.finish()
        for text, want in zip(texts, covered(texts, 3)):
            got = {k for a, b in automaton.repeated(text, 3) for k in range(a, b)}
            assert got == want


def test_interval_expansion():
    rng = np.random.default_rng(4)
    for _ in range(40):
        texts = [bytes(rng.choice([97, 98], int(rng.integers(1, 30))).tolist()) for _ in range(4)]
        for got, want in zip(suffix_dedup.repeated_in(texts, [1] * 4, 6), covered(texts, 6)):
            assert {k for a, b in got for k in range(a, b)} == want


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scan", "packing"]
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        assert after.columns == docs.columns
        docs = after
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    label, _ = brute_groups([r.text for r in docs.orderBy("doc_id").collect()])
    assert label == list(range(len(label)))  # no near copies are left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == counts[4]


def test_pipeline_gives_token_ids(spark):
    texts = ["Ab, c. D", None, " ".join(f"w{i}" for i in range(3000)), "same text", "same text"]
    docs = table(spark, texts)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        assert np.frombuffer(b"".join(r.ids for r in own), "<u2").tolist() == want
        assert all(len(r.ids) == 2 * r.length for r in own)
    assert len(rows) > len(texts)
