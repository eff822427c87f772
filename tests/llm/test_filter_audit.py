"""The filter audit against removing rows one filter after the other, in every order."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from daybook.llm import filter_audit
from daybook.llm.registry import prepared

LETTERS = "ABCDE"


@pytest.fixture(autouse=True)
def shipped(spark):
    prepared(spark)


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute_force(docs, labels):
    """(part, order, step) -> the eight numbers, by applying the filters to lists of rows."""
    flags = defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        if i is None:
            continue
        flags[i][0] |= quality == 1
        flags[i][1] |= toxic == 1
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = defaultdict(list)
    for i, text, part in docs:
        fails = failed(text or "") | {"E": i is not None and least[text or ""] < i}
        parts[part or ""].append((fails, *flags[i]))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations(LETTERS):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if r[0][letter]]
                left = [r for r in left if not r[0][letter]]
                every = [r for r in rows if r[0][letter]]
                alone = [r for r in every if sum(r[0].values()) == 1]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(every) - len(gone), len(alone), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for order in permutations(LETTERS):
            for step, letter in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[letter])
    return out


def corpus():
    """Nulls, empty and very long texts, hot copies, repeated rows, ids that repeat, a NULL part."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(900)]
    texts = [None, "", " \t\n", "a", "A B C", "50 % & more", "é " * 300, "x y " * 5000]
    for _ in range(40):
        words = rng.choices(pool[: rng.choice([20, 900])], k=rng.randrange(150, 260))
        texts.append(" ".join(words) + rng.choice(["", " #1", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3]))
    texts += [texts[10]] * 60 + texts[12:20]
    docs = [(i, t, rng.choice(["hot", "hot", "b", None, ""])) for i, t in enumerate(texts)]
    docs += [docs[11], docs[11], (11, "another text", "b"), (None, texts[10], "hot"), (None, None, None)]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 100, 3)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    rows = [(*d, "k", True, 0, "A", 1) for d in docs]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, source string, key string, copy boolean, mask int, part string, id int"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_audit_matches_brute_force(spark):
    docs, labels = corpus()
    got = filter_audit.audit_documents(*frames(spark, docs, labels))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                           "good_lost", "toxic_lost", "shapley"]
    rows = got.collect()
    want = brute_force(docs, labels)
    assert len(rows) == len(want) == 3 * 600
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in rows} == want


def test_empty_tables(spark):
    docs, labels = corpus()
    assert filter_audit.audit_documents(*frames(spark, [], labels)).count() == 0
    assert filter_audit.audit_documents(*frames(spark, docs[:3], [])).count() > 0


@pytest.mark.parametrize("n", range(7))
def test_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), set()
    seen.add(tuple(order))
    for k in filter_audit.plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add(tuple(order))
    assert len(seen) == len(filter_audit.plain_changes(n)) + 1 == len(list(permutations(range(n))))


def test_diagram_shares_equal_nodes_and_stays_exact():
    rng = random.Random(1)
    counts = {mask: (rng.choice([0, 1]),) for mask in range(64)}
    diagram = filter_audit.Diagram("abcdef", counts)
    for k in filter_audit.plain_changes(6):
        diagram.swap(k)
        assert all(len(level) <= min(2**d, 2 ** 2 ** (6 - d)) for d, level in enumerate(diagram.levels))
        left = [m for m in range(64)]
        for letter, kept, gone in diagram.steps():
            bit = 1 << "abcdef".index(letter)
            assert gone == (sum(counts[m][0] for m in left if m & bit),)
            left = [m for m in left if not m & bit]
            assert kept == (sum(counts[m][0] for m in left),)


def test_hot_copies_meet_by_id_not_by_text(spark):
    docs, labels = corpus()
    rows = frames(spark, docs, labels)[0].select("doc_id", "text").selectExpr("doc_id as id", "text as key")
    text = filter_audit.with_copies(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, ((id#" in text and "Window" not in text
