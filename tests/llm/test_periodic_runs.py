"""Periodic runs against brute force over all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from daybook.llm import periodic_runs
from daybook.llm.queries import with_planted_runs
from daybook.llm.registry import QUERIES, prepared


@pytest.fixture(autouse=True)
def shipped(spark):
    prepared(spark)


def brute_runs(words, repeats=4, least=6):
    """Every maximal stretch of each period; those of a shorter period are not its own."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            start = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            end = x + q
            if end - start < max(least, repeats * q):
                continue
            shorter = any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q))
            if not shorter:
                out.append((start, end - start, q))
    return sorted(out)


def repetitive(rng):
    """Texts with runs of several periods, nested, touching, overlapping and almost periodic."""
    parts = []
    for _ in range(rng.randrange(1, 8)):
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8]))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(2, 5) + [rng.choice("abc")]
        stretch = unit * rng.randrange(1, 9)
        parts += stretch[: rng.randrange(1, len(stretch) + 1)] if rng.random() < 0.5 else stretch
        if rng.random() < 0.4:
            parts.append(rng.choice("abcdx"))
    return parts


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    texts = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 200, list("ab" * 30), list("aab" * 20 + "aab")]
    texts += [repetitive(rng) for _ in range(150)]
    texts += [[rng.choice("ab") for _ in range(rng.randrange(1, 120))] for _ in range(60)]
    numbers = [np.asarray([ord(w) for w in t], np.int64) for t in texts]
    assert periodic_runs.find_runs(numbers) == [brute_runs(t) for t in texts]
    for repeats in (2, 3, 5):
        assert periodic_runs.find_runs(numbers, repeats, 2) == [brute_runs(t, repeats, 2) for t in texts]
    alone = [periodic_runs.find_runs([t])[0] for t in numbers[:40]]
    assert alone == periodic_runs.find_runs(numbers)[:40]


def test_few_pairs_at_once_change_nothing(monkeypatch):
    rng = random.Random(9)
    numbers = [np.asarray([ord(w) for w in repetitive(rng)], np.int64) for _ in range(60)]
    whole = periodic_runs.find_runs(numbers)
    monkeypatch.setattr(periodic_runs, "PAIRS_AT_ONCE", 7)
    assert periodic_runs.find_runs(numbers) == whole


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_extensions_match_comparison(letters):
    rng = random.Random(len(letters))
    text = [rng.choice(letters) for _ in range(300)] + list("ab" * 200) + list("b" * 77) + list(letters * 30)
    sequence = np.asarray([-1, *map(ord, text), -2], np.int64)
    grammar = periodic_runs.Grammar(sequence)
    assert len(grammar.symbols) < 60
    for _ in range(3000):
        i, j = sorted(rng.sample(range(1, len(sequence) - 1), 2))
        k = 0
        while sequence[i + k] == sequence[j + k]:
            k += 1
        assert grammar.forward(i, j) == k
        k = 0
        while sequence[i - k] == sequence[j - k]:
            k += 1
        assert grammar.backward(i, j) == k


def test_long_extensions_take_few_steps():
    """Two far copies of a long stretch are compared by their symbols, not word by word."""
    rng = np.random.default_rng(3)
    stretch = rng.integers(0, 50, 20_000)
    sequence = np.concatenate(([-1], stretch, [99], stretch, [-2]))
    grammar = periodic_runs.Grammar(sequence)
    reads = 0

    class Counted:
        def __init__(self, view):
            self.view = view

        def __getitem__(self, k):
            nonlocal reads
            reads += 1
            return self.view[k]

    grammar.symbols = [Counted(s) for s in grammar.symbols]
    assert grammar.forward(1, 20_002) == 20_000
    assert grammar.backward(20_000, 40_001) == 20_000
    assert reads < 2_000


def test_collapsed_texts(spark):
    texts = [None, "", " \t\n", "one", "a a a a a a", "a a a a a", "x  y\tx y x y x\ny x y z", "é ß " * 40 + "end",
             "u v w " * 3, "go " * 30 + "stop " * 30, "k " * 60_000]
    texts += ["u v w " * 4] * 20
    rows = [(i, t, "r", 3, "c") for i, t in enumerate(texts)] + [(5, "a a a a a a", "r", 3, "c"), (None, "b " * 9, "r", 3, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_words int, collapsed string")
    got = periodic_runs.collapse_runs(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], []).append(r)
    for i, text, *_ in rows:
        words = (text or "").split()
        (r,) = [x for x in by_text[i] if x["n_words"] == len(words)]
        runs = brute_runs(words) if len(words) < 1000 else [(0, 60_000, 1)]
        assert [tuple(x) for x in r["runs"]] == runs
        keep = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        assert r["collapsed"] == " ".join(keep)
    assert periodic_runs.collapse_runs(docs.where("false")).count() == 0


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, None
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_on_small_table(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["a", "b", "c", "dd", "é"], k=rng.randrange(0, 90)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "   x"), (1003, "z\n" * 50)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = brute_runs(words)
        keep = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(got[doc_id]) == (
            doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(keep).encode()).hexdigest())


def test_planting_keeps_other_texts(spark):
    docs = spark.createDataFrame([(i, " a  b\t c ") for i in range(50)] + [(None, "x y")], "doc_id bigint, text string")
    for r in with_planted_runs(docs).collect():
        if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10:
            assert r["text"] in (" a  b\t c ", "x y")
        else:
            assert r["text"].split() == planted(r["doc_id"], " a  b\t c ")
