"""URL filter rules as one bit-parallel wildcard automaton.

All rules are globs over a canonical URL: a dot, the host with A-Z lower-cased, a
slash and the path. ``*`` stands for any bytes but a slash, ``**`` for any bytes.
Every byte of every glob is a bit of a multiword Shift-And mask; one step per URL
byte moves all rules of all URLs of a batch at once.

Defined results: a NULL URL or one without ``://`` has an empty host and path and
is judged by the rules like any other; equal rows are judged one by one; an empty
table gives no rows; only the URL and the id are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; among fitting rules the highest (level, length of name) decides."""

    verdict: str
    name: str
    glob: str
    level: int = 0


def site_rule(verdict: str, name: str, level: int = 1) -> Rule:
    """A rule ``host/path``: the host and its subdomains, with paths that start alike."""
    host, slash, path = name.partition("/")
    return Rule(verdict, name, f"*.{host}/{slash}{path}**", level)


#: Verdicts for URLs that no site rule fits.
GENERAL_RULES = (
    Rule(ALLOW, "**", "**"),
    Rule(BLOCK, "host *pills*", "*pills*/**"),
    Rule(BLOCK, "host *casino*", "*casino*/**"),
    Rule(BLOCK, "host *porn*", "*porn*/**"),
    Rule(BLOCK, "path **/wp-login*", "*/**/wp-login**"),
    Rule(BLOCK, "path **.exe", "*/**.exe"),
    Rule(BLOCK, "path **.zip", "*/**.zip"),
)


class ShiftAnd:
    """The bit masks of a list of globs, packed into 64-bit words one after another."""

    def __init__(self, globs: list[str]):
        places: list[tuple[int | None, bool, bool]] = []  # byte or None at the end, loops on non-slash, loops on slash
        self.first, self.last = [], []
        for glob in globs:
            raw, i, loop = glob.encode(), 0, 0
            self.first.append(len(places))
            while i < len(raw):
                if raw[i : i + 1] == b"*":
                    double = raw[i : i + 2] == b"**"
                    loop, i = max(loop, 2 if double else 1), i + (2 if double else 1)
                    continue
                places.append((raw[i], loop >= 1, loop == 2))
                loop, i = 0, i + 1
            places.append((None, loop >= 1, loop == 2))
            self.last.append(len(places) - 1)
        self.words = len(places) // 64 + 1
        # state bit p: everything before place p has been read
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for p, (byte, any_but_slash, slash) in enumerate(places):
            w, bit = p // 64, np.uint64(1 << (p % 64))
            if byte is not None:
                self.step[byte, w] |= bit
            if any_but_slash:
                self.stay[np.arange(256) != ord("/"), w] |= bit
            if slash:
                self.stay[ord("/"), w] |= bit
        for p in self.first:
            self.start[p // 64] |= np.uint64(1 << (p % 64))

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row of booleans, one for each glob, for each whole text."""
        state = np.tile(self.start, (len(texts), 1))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))[order] if len(texts) else sizes
        lengths = sizes[order]
        active = len(texts)
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(lengths[0]) if len(texts) else 0):
            active = int(np.searchsorted(-lengths[:active], -at, side="left"))
            byte = data[starts[:active] + at]
            now = state[:active]
            read = now & self.step[byte]
            moved = read << one
            moved[:, 1:] |= read[:, :-1] >> top
            state[:active] = moved | (now & self.stay[byte])
        found = np.zeros((len(texts), len(self.last)), bool)
        for j, p in enumerate(self.last):
            found[order, j] = (state[:, p // 64] >> np.uint64(p % 64)) & one == 1
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: on to ``?``, ``#`` or the end."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(
    pages: DataFrame, rules: list[Rule], general: tuple[Rule, ...] = GENERAL_RULES,
    id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """A row for each URL: page_id, host, path, rule (of ``rules``, else NULL), general_rule and verdict."""
    host, path = host_and_path(F.col(url_column))
    parts = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    ranked = sorted([*rules, *general], key=lambda r: (r.level, len(r.name)), reverse=True)
    own = {r.name for r in rules}
    names = ["rule", "general_rule", "verdict"]
    schema = f"page_id {parts.schema['page_id'].dataType.simpleString()}, host string, path string, " + ", ".join(f"{n} string" for n in names)

    def judge(batches):
        automaton = ShiftAnd([r.glob for r in ranked])
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            found = automaton.matches([f".{h}/{p}".encode() for h, p in zip(hosts, paths)])
            winners = [ranked[j] if any_found else None for j, any_found in zip(found.argmax(axis=1), found.any(axis=1))]
            columns = [
                [r.name if r and r.name in own else None for r in winners],
                [r.name if r and r.name not in own else None for r in winners],
                [r.verdict if r else ALLOW for r in winners],
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.string()) for c in columns]], [*batch.schema.names, *names])

    return parts.mapInArrow(judge, schema)
