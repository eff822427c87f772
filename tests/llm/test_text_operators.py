"""Operators that look at one row at a time, against brute force and planted cases."""

import base64
import json
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import decontamination, jaccard_join, language_id, license_scan, packing, quality_rules, secret_scan, url_filter
from daybook.llm.registry import prepared

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, spans string, _class int, label string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def shipped(spark):
    prepared(spark)


def table(spark, texts, langs=None):
    """Documents with further columns whose names operators use themselves."""
    rows = [(i, t, langs[i] if langs else None, None, None, "k", "s", 1, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
ODD = [None, "", " \n\t", "one", "tie tie", "tie tie", LONG, "é𝒳 日本。 x", "a b c"]


def test_packing_keeps_every_id(spark):
    texts = [*ODD, "Ab, c. <|endoftext|> D", *["same text here"] * 40, *[f"w{i} " * i for i in range(60)]]
    rows = packing.pack_documents(table(spark, texts), VOCABULARY, 1, size=256).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
        assert {r.padding for r in pieces} == {0 if at & (at - 1) == 0 else 256 - at}
    used = sum(r.length for r in rows)
    assert len(by_sequence) * 256 < used * 1.1


ENDS = ["A.b. c.. d, (e). f.", "x.", "x,\ny.\tz.\x0b", "1. 2, é. 日.", ".", " . ", "a.\u00a0b.", "it's. IT'S.", "e\u0301. x", "q.\x1c r"]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    """Held words, forgotten or not, against the tokenizer, with odd spaces and marks; few words are encoded twice."""
    rng = np.random.default_rng(8)
    texts = [*[t or "" for t in ODD], *ENDS, "Ab, c. <|EndOfText|> D", "x<|endoftext|>y"]
    texts += [" ".join(f"Head{i}." if rng.random() < 0.8 else f"tail{rng.integers(0, 10**6)}," for i in rng.integers(0, 30, 400)) for _ in range(40)]
    plain = Tokenizer.from_file(VOCABULARY)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing, "WORDS_KEPT", 1_500)
    words = packing.WordEncoder(VOCABULARY)
    encoded = []
    apart = words.encoded_apart
    monkeypatch.setattr(words, "encoded_apart", lambda part: encoded.extend(part) or apart(part))
    got = [ids for t in texts for ids in words.ids([t.encode()])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    heads = Counter(w for w in encoded if w.startswith("head"))
    assert len(heads) == 30 and max(heads.values()) == 1
    assert len(words.words) + len(words.older) <= 2 * 1_500
    assert words.ids([]) == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_vocabularies_are_applied_to_whole_texts(spark, name, tmp_path):
    path = public_tokenizers.path(name)
    if name.startswith("word"):  # the same file without lower-casing is no word vocabulary any more
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        assert packing.by_words(settings)
        settings["normalizer"]["normalizers"].pop()
        path = f"{tmp_path}/{name}"
        with open(path, "w", encoding="utf-8") as file:
            json.dump(settings, file)
    assert type(packing.encoder(path)) is packing.TextEncoder
    texts = [*ODD, *ENDS, "Ab, c. D"]
    rows = packing.token_pieces(table(spark, texts), path, 1, size=512, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), packing.id_type(path)).tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_of_nothing(spark):
    assert packing.pack_documents(table(spark, []), VOCABULARY, 1).collect() == []


def test_plan_covers_demand():
    rng = np.random.default_rng(5)
    demand = dict(Counter(rng.integers(1, 65, 700).tolist()))
    fill, covered = defaultdict(int), Counter()
    for size, first, last, each, sequence in packing.packing_plan(demand, 64):
        assert first == covered[size]
        covered[size] = last + 1
        for rank in range(first, last + 1):
            fill[sequence + (rank - first) // each] += size
    assert covered == demand and max(fill.values()) <= 64
    assert len(fill) <= 1.02 * sum(s * n for s, n in demand.items()) / 64 + 4


def items():
    return [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa. ", "Lambda mu nu."),
        (2, "the of and to in that is was he for it with as his on", "be at by"),
        (2, "the of and to in that is was he for it with as his on", "be at by"),
        (3, "", ""), (4, None, None), (5, "solo", None),
        (6, " ".join(f"long{i}" for i in range(200)), "final answer words"),
    ]


def test_decontamination_finds_what_brute_force_scores():
    index = decontamination.ItemIndex(items())
    rng = np.random.default_rng(3)
    pool = [w for i in items() for w in decontamination.words_of(f"{i[1] or ''} {i[2] or ''}")] + [f"other{i}" for i in range(300)]
    for _ in range(60):
        words = rng.choice(pool, int(rng.integers(0, 400))).tolist()
        want = defaultdict(list)
        last = max(0, (len(words) - 1) // 64 - 1)
        for p in range(last + 1):
            held = set(words[p * 64 : p * 64 + 128])
            scores = np.zeros(len(index.units))
            for word in held & set(index.terms):
                units, weights = index.postings[index.terms[word]]
                scores[units] += weights
            for unit in np.flatnonzero(scores >= 0.3):
                want[index.units[unit][0]].append(p * 64)
        got = index.candidates(words, 0.3)
        assert {k: sorted(x for x, _ in v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_decontamination(spark):
    bench = spark.createDataFrame(items(), "item_id bigint, question string, answer string")
    noise = " ".join(f"n{i}" for i in range(500))
    texts = [
        *ODD,
        f"{noise} alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu {noise}",
        f"{noise} alpha beta gamma delta epsilon {noise} lambda mu nu",
        f"{noise} alpha beta gamma delta epsilon zeta eta theta iota kappa {noise}",
        f"x {items()[6][1]} final answer words {noise}",
    ]
    docs = table(spark, texts)
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert found == {(9, 1), (12, 6)}
    passes = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench, index_bytes=700).collect()}
    assert passes == found
    kept = decontamination.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(texts)) if i not in (9, 12)]
    assert decontamination.contaminated(docs, bench.limit(0)).collect() == []


def test_answer_is_the_last_sentence(spark):
    rows = spark.createDataFrame([("One two. Three four.",), ("Alone here",), (None,), ("",)], "t string")
    q, a = decontamination.split_answer(rows.t)
    assert [tuple(r) for r in rows.select(q, a).collect()] == [("One two. ", "Three four."), ("", "Alone here"), ("", ""), ("", "")]


def test_items_need_words_in_order():
    question = "what is the capital of the united states of america today"
    other = "today the states of america united what the capital of trade is"
    index = decontamination.ItemIndex([(1, "", question), (2, None, question), (3, "Q:", question), (4, question, None)])
    found = lambda text: sorted(m[0] for m in index.matches(text, 0.5, 0.6, 0.6))
    assert found(f"q {other}") == found(f"some q words {other} and more") == []
    assert found(f"q. {question}") == found(f"so Q: {question.title()}? yes") == [1, 2, 3, 4]
    assert found(question) == [1, 2, 4]


def test_passes_change_no_score(spark):
    rng = np.random.default_rng(9)
    items = [(i, " ".join(f"w{k}" for k in np.minimum(rng.zipf(1.4, 40), 90)), " ".join(f"a{k}" for k in rng.integers(0, 30, 4))) for i in range(40)]
    texts = [f"{' '.join(q.split()[:n])} {a} " + " ".join(f"n{k}" for k in range(60)) for _, q, a in items for n in (12, 18, 24, 30)]
    docs = table(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, question string, answer string")
    found = [
        sorted(decontamination.contaminated(docs, bench, question_overlap=0.1, answer_overlap=0.1, index_bytes=size).collect())
        for size in (decontamination.INDEX_BYTES, 2_500)
    ]
    assert found[0] == found[1] and any(r.score < 0.6 for r in found[0]) and len({r.doc_id for r in found[0]}) < len(texts)


def glob_regex(glob):
    out = "".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in re.split(r"(\*\*|\*)", glob))
    return re.compile(out, re.DOTALL)


def test_automaton_against_regular_expressions():
    globs = ["*.org//**", "*.example.org//en/1**", "**", "ab*c", "*a*b*", "**/x**.exe", "", "a" * 70 + "*b"]
    texts = ["", ".org//", ".a.org//x", ".a.com//b.org//", "abxxc", "ab/c", "q/x1/y.exe", "a" * 70 + "zb", "a" * 71, "é*"]
    found = url_filter.ShiftAnd(globs).matches([t.encode() for t in texts])
    for j, glob in enumerate(globs):
        assert found[:, j].tolist() == [bool(glob_regex(glob).fullmatch(t)) for t in texts]


def test_url_verdicts(spark):
    rules = [url_filter.site_rule(v, n) for v, n in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/x.org/": ("", "", None, "allow"),
        "http://A.Example.ORG/es/x?q": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org": ("example.org", "", None, "allow"), "https://example.org/en/1": ("example.org", "/en/1", "example.org/en/1", "block"),
        "https://xexample.org/es/#a": ("xexample.org", "/es/", "org/", "allow"), "x://b.com/fr/é": ("b.com", "/fr/é", "com/fr/", "allow"),
        "x://b.com/x.org/": ("b.com", "/x.org/", None, "allow"), "x://cheap-pills.net/a": ("cheap-pills.net", "/a", None, "block"),
        "x://a.net/s/y.exe?z": ("a.net", "/s/y.exe", None, "block"), "x://y://org/": ("y:", "//org/", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id bigint, url string, host string")
    rows = sorted(url_filter.judge_urls(pages, rules).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == list(cases.values())
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def tlv(tag, body):
    size = len(body)
    return bytes([tag]) + (bytes([size]) if size < 128 else b"\x82" + size.to_bytes(2, "big")) + body


def rsa_key(fill=7):
    return tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([fill + i]) * 24) for i in range(8)))


def signed_token(size=32, header=b'{"alg":"HS256","typ":"JWT"}'):
    code = lambda b: base64.urlsafe_b64encode(b).rstrip(b"=").decode()
    return ".".join(map(code, (header, json.dumps({"sub": "x"}).encode(), b"s" * size)))


def test_secrets(spark):
    der = base64.b64encode(rsa_key()).decode()
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b""))
    ssh += (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"q" * 136))
    texts = [
        *ODD, f"é x {der} y", f"x {der[:-8]}AAAAAAAA y"[:-20], f"t {signed_token()} z", f"t {signed_token(31)} z",
        f"k {rsa_key().hex()} k", f"k {base64.b64encode(ssh).decode()}", f"-----BEGIN RSA PRIVATE KEY-----\n{der[:64]}\n{der[64:]}\n-----END RSA PRIVATE KEY-----",
        "PassWord = 'abcdefgh' token:short api-key", "AKIAABCDEFGHIJKL AKIA123", "ab" * 16, "token=apikey:abcdefgh1", "ſecret=abcdefghi",
    ]
    docs = table(spark, texts)
    rows = {r.doc_id: [(s.start, s.end, s.kind) for s in r.found] for r in secret_scan.scan_secrets(docs).collect()}
    kinds = {i: [k for _, _, k in v] for i, v in rows.items() if v}
    assert kinds == {9: ["der_key"], 11: ["jwt"], 13: ["hex", "der_key"], 14: ["ssh_key"], 15: ["pem_key"], 16: ["assign"], 17: ["access"], 18: ["hex"]}
    assert rows[9] == [(4, 4 + len(der), "der_key")] and rows[16] == [(0, 20, "assign")]
    clean = secret_scan.scan_secrets(docs, redact=True)
    assert clean.columns == [*docs.columns, "found"]
    shown = {r.doc_id: r.text for r in clean.collect()}
    assert shown[0] is None and shown[9] == "é x [der_key] y" and shown[6] == LONG
    assert secret_scan.scan_secrets(docs.limit(0)).collect() == []


def test_keys_over_line_ends():
    code = base64.b64encode(rsa_key()).decode()
    parts = [b"none", b"none", b"", b"p" * 51, b"q" * 300]
    fields = [len(x).to_bytes(4, "big") + x for x in parts]
    ssh = base64.b64encode(b"openssh-key-v1\0" + b"".join(fields[:3]) + (1).to_bytes(4, "big") + b"".join(fields[3:])).decode()
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    for width in (64, 76):
        for key, kind in ((code, "der_key"), (ssh, "ssh_key")):
            lines = [key[i : i + width] for i in range(0, len(key), width)]
            for join in ("\n", "\r\n    ", "\\n", "\\r\\n", "\\\\n", '" +\n  "', '\\n"\n  "', "\\n\\\n"):
                body = join.join(lines)
                for before, after in (("key:\n", "\nmore words here"), ('{"k": "', '"}'), ("x\\n", "\\nmore")):
                    assert secret_scan.structure_spans(before + body + after) == [(len(before), len(before + body), kind)], (join, before)
                whole = begin + join + body + join + end
                assert secret_scan.structure_spans(f'{{"k": "{whole}"}}') == [(7, 7 + len(whole), "pem_key")], join
                assert not secret_scan.structure_spans("x " + join.join(lines[:-1]) + " y")
    lines = [code[i : i + 64] for i in range(0, len(code), 64)]
    sealed = base64.b64encode(bytes(range(256)) * 2).decode()
    assert secret_scan.structure_spans(code.replace("/", "\\/")) == [(0, len(code.replace("/", "\\/")), "der_key")]
    for join in ("\n", "\\n", '\\n" +\n"'):
        head = join.join(["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF", "", ""])
        text = begin + join + head + join.join([sealed[:64], sealed[64:]]) + join + end
        assert secret_scan.structure_spans(text) == [(0, len(text), "pem_encrypted")], join
        assert secret_scan.structure_spans(text.replace("4,ENCRYPTED", "4,MIC-ONLY")) == []
        text = begin + join + "Comment: own" + join * 2 + join.join(lines) + join + end
        assert secret_scan.structure_spans(text) == [(0, len(text), "pem_key")], join


def test_tokens_after_other_segments():
    for token in (signed_token(), signed_token(header=b'{\r\n"alg":"HS256"}')):
        for before in ("documentation.", "one-more-word.claims12.", "eyJub3RhdG9rZW4.", "a.b.c ", ""):
            text = f"{before}{token} end"
            assert secret_scan.structure_spans(text) == [(len(before), len(before + token), "jwt")]
    assert secret_scan.structure_spans(f"x{signed_token()}") == secret_scan.structure_spans(f"documentation.{signed_token(31)}") == []


def test_language(spark):
    rng = np.random.default_rng(0)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "xyzéñ"}

    def text(lang):
        return " ".join("".join(rng.choice(list(letters[lang]), 4)) for _ in range(60))

    langs = [list(letters)[i % 3] for i in range(90)]
    texts = [text(lang) for lang in langs]
    train = table(spark, [*texts, None, ""], [*langs, "aa", "bb"])
    model = language_id.fit(train)
    tests = [text(list(letters)[i % 3]) for i in range(30)]
    rows = sorted(language_id.classify(table(spark, [*tests, *ODD, "12 !!", "a"]), model).collect())
    assert sum(r.lang_pred == list(letters)[i % 3] for i, r in enumerate(rows[:30])) >= 29
    assert [r.lang_pred for r in rows[30:33]] == ["und"] * 3 and rows[-2].lang_pred == "und" and rows[-1].lang_pred in letters
    assert all(0 <= r.score <= 1 for r in rows) and rows[30].score == 0
    assert rows[37].rejected and not rows[0].rejected
    empty = language_id.fit(train.limit(0))
    assert {r.lang_pred for r in language_id.classify(table(spark, ["abc", None]), empty).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    keys, _, _ = language_id.grams([b"abab baba abba bab aab"])
    unique, counts = np.unique(keys, return_counts=True)
    model = language_id.KneserNey(unique, counts)
    context = int(unique[3]) >> 16
    total = sum(2.0 ** model.log2(np.array([(context << 16) | c], np.uint64))[0] for c in (32, 97, 98))
    assert 0.95 < total <= 1.0


def test_shards_keep_all_grams(spark):
    rng = np.random.default_rng(1)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "rare": "xyzéñ"}

    def text(lang, words):
        return " ".join("".join(rng.choice(list(letters[lang]), 5)) for _ in range(words))

    langs = ["aa"] * 40 + ["bb"] * 40 + ["rare"] * 2
    texts = [text(lang, 50 if lang != "rare" else 6) for lang in langs]
    tests = table(spark, [*(text(lang, 20) for lang in langs), "zzz qqq", *ODD])
    train = table(spark, texts, langs)
    whole = {}
    for lang in letters:
        keys = np.concatenate([language_id.grams([t.encode()])[0] for t, own in zip(texts, langs) if own == lang])
        whole[lang] = language_id.KneserNey(*np.unique(keys, return_counts=True))
    for cells, several in ((10**9, False), (400, True)):
        model = language_id.fit(train, cells=cells)
        rows = language_id.classify(tests.withColumn("own", tests.text), model, keep=("own",)).collect()
        for r in rows:
            keys, sizes, count = language_id.grams([(r.own or "").encode()])
            if count[0]:
                bits = {lang: -m.log2(keys).sum() / sizes[0] for lang, m in whole.items()}
                assert r.bits == pytest.approx(min(bits.values()), rel=1e-5)
                assert bits[r.lang_pred] == pytest.approx(min(bits.values()), rel=1e-5)
        assert [r.lang_pred for r in sorted(rows)[80:82]] == ["rare"] * 2
        assert (len(model.shards) > 1) == several


def test_licences(spark):
    S = license_scan.SENTENCES
    texts = [
        *ODD, "Words.\nReleased under the MIT License.\nMore.", "wordswithoutend\nAll rights reserved. x",
        f'{S["apache-head"]}\n{S["apache-comply"]} {S["apache-copy"]}', S["mit-grant"].replace(" to ", "\n  to ") + "\n\n" + S["mit-notice"],
        S["gpl-free"] + " Unknown one. Unknown two. " + S["gpl-hope"], "This is about a license.", "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.",
    ]
    rows = license_scan.scan_licenses(table(spark, texts)).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        found[r.doc_id].append((r.licence, r.n_sentences))
    assert found == {
        9: [("MIT", 1)], 10: [("all-rights-reserved", 1)], 11: [("Apache-2.0", 3)], 12: [("MIT", 2)],
        13: [("GPL-3.0-or-later", 2)], 15: [("CC-BY-NC-4.0", 1)] * 2,
    }
    assert all(any(t in s.lower().encode() for t in license_scan.TRIGGERS) or n.startswith("spdx") for n, s in S.items())


BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DAMAGES ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def test_bsd_at_any_width():
    S, book = license_scan.SENTENCES, license_scan.SentenceBook(license_scan.SENTENCES)
    two = ["Copyright (c) 2020, Some Body", S["bsd-grant"], *BSD_CLAUSES, BSD_END]
    three = [*two[:-1], "3. " + S["bsd-names"], BSD_END]
    for width in (24, 40, 60, 72, 80, 10_000):
        for mark in ("", "# ", " * "):
            for paragraphs, licence, n in ((two, "BSD-2-Clause", 1), (three, "BSD-3-Clause", 2)):
                lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width, break_long_words=False), ""]]
                found = license_scan.match_rules(book.identifiers("\n".join(mark + line for line in lines)))
                assert [(name, size) for name, size, _, _ in found] == [(licence, n)], (width, mark)
    gap = lambda n: S["bsd-grant"] + " Unknown here." * n + " " + S["bsd-names"]
    assert [license_scan.match_rules(book.identifiers(gap(n)))[0][0] for n in (8, 9)] == ["BSD-3-Clause", "BSD-2-Clause"]


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(runs)
    covered = {k for i, r in enumerate(runs) if count[r] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    texts = [*ODD, "a b c d e f g h " * 3, "x\ny\nx\n \n \nx", "# * | <>", "\u00a0a \u2003b", "a " * 9, " ".join("abcdefgh" * 2), "1 2 3 4 5 6 7 8 9 " * 2 + "z"]
    docs = table(spark, texts)
    rows = sorted(quality_rules.measured(docs.select("doc_id", "text"), [*quality_rules.MEASURES]).collect())
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
    assert got == [brute_measures(t) for t in texts]


def test_quality_cascade(spark):
    good = " ".join(f"word{i}" for i in range(40))
    texts = [good, None, "", "short", "a b c d e f g h " * 6, good.replace(" ", "## "), good.replace(" ", "!! "), "\n".join(["the same line again"] * 9 + [good])]
    docs = table(spark, texts)
    order = quality_rules.ordered_rules(docs)
    assert sorted(r.name for r, _, _ in order) == sorted(r.name for r in quality_rules.RULES)
    assert [r.doc_id for r in quality_rules.keep_good(docs).collect()] == [0]
    assert quality_rules.keep_good(docs).columns == docs.columns
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1]):
        assert [r.doc_id for r in quality_rules.judge(docs, rules).where("rejected_by is null").collect()] == [0]
    assert quality_rules.keep_good(docs.limit(0)).collect() == []


def scanned(text, kind):
    """Base spans by trying every place in turn, without expressions."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = at
        if kind == "hex":
            while end < n and text[end] in "0123456789abcdef":
                end += 1
            good = end - at >= 32
        elif kind == "access":
            if text.startswith("AKIA", at):
                end = at + 4
                while end < n and text[end] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
                    end += 1
                end = end if end > at + 4 else at
            good = end - at >= 16
        else:
            good = False
            names = ("password", "passwd", "secret", "token", "api_key", "apikey")
            low = "".join(c.lower() if c.isascii() else c for c in text[at : at + 8])
            name = next((x for x in names if low.startswith(x)), None)
            if name:
                k = at + len(name)
                for marks in ("\"'", None, ":=", None, "\"'"):
                    if marks is None:
                        while k < n and text[k] == " ":
                            k += 1
                    elif k < n and text[k] in marks:
                        k += 1
                    elif marks == ":=":
                        k = n + 1
                        break
                value = k
                while k < n and (text[k].isascii() and text[k].isalnum() or text[k] in "+/_.=-"):
                    k += 1
                if k <= n and k > value:
                    end, good = k, k - value >= 8
        if end > at:
            out += [(at, end)] * good
            at = end
        else:
            at += 1
    return out


def test_base_spans_against_brute_force():
    rng = np.random.default_rng(6)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "api", "=", ":", " ", " ", "\"", "'", "\n", "AKIA", "AKIAAKIA",
            "0123456789abcdef", "ABCDEF0123456789", "deadbeef", "x", "é", "\u212a", "ſecret", "+/_.=-", "9f8e7d6c5b4a3928"]
    for _ in range(1500):
        text = "".join(rng.choice(bits, int(rng.integers(1, 30))))
        want = sorted((s, e, k) for k in secret_scan.BASE_KINDS for s, e in scanned(text, k))
        assert sorted(secret_scan.base_spans(text)) == want, text


@pytest.mark.parametrize("line", [
    "b3Blbn\n", "MISAAAAAAgEA\n", "MIIBAAIBAA\n", "b3BlbnNzaC1rZXktdjEAAAAABG5vbmU\n", "eyJhbGci.eyJz.\n", "MIIB\" + \"", "\"\n",
    "-----BEGIN PRIVATE KEY-----\n", "password = \n"])
def test_scan_takes_time_in_proportion(line):
    def seconds(size):
        text = (line * (size // len(line) + 1))[:size]
        start = time.perf_counter()
        secret_scan.find_spans(text)
        return time.perf_counter() - start

    seconds(10_000)
    small = min(sum(seconds(60_000) for _ in range(10)) for _ in range(2))
    assert seconds(600_000) < 2 * small + 0.3


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own helpers come through unchanged."""
    names = ["_h", "_id", "_hash", "_row", "_kept", "_gone", "_words", "_text", "rejected_by", "_rejected_by", "words", "doc", "label", "key"]
    good = " ".join(f"word{i} and{i % 7}" for i in range(60))
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate([good, good + " more", None, "short", "x " * 90])]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, good, "")], "item_id bigint, question string, answer string")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted([rows[0], rows[1], rows[5]])
    one = jaccard_join.one_of_each_group(docs)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == [0, 2, 3, 4]
    assert {tuple(r) for r in one.collect()} <= set(rows)
    once = jaccard_join.one_of_each_group(docs.where("doc_id > 0"))
    assert once.columns == docs.columns and sorted(map(tuple, once.collect())) == sorted(rows[1:5])
    clean = decontamination.remove_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == sorted(rows[2:5])
    assert quality_rules.judge(docs).where("doc_id = 3").first()["rejected_by"] == "too_short"


def test_least_hashed_rows_are_those_of_a_whole_sort(spark):
    rows = spark.createDataFrame([(f"l{i % 3}", f"text {i}") for i in range(2000)] + [("l0", "copied")] * 900, "lang string, text string")
    for most in (5, 60, 2900):
        want = rows.orderBy(F.xxhash64("text"), "lang").limit(most).collect()
        assert sorted(map(tuple, language_id.least_hashed(rows, most).collect())) == sorted(map(tuple, want))
    same = rows.where("text = 'copied'")
    assert language_id.least_hashed(same, 7).count() == 7 and language_id.least_hashed(rows.where("false"), 7).count() == 0
