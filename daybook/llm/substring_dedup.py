"""Removal of word sequences that stand twice, by suffix automata of reference shards.

A reference shard holds the contexts of a group of anchors. Its suffix automaton
accepts every word sequence in them and counts where each ends. The contexts are
then streamed through it: at every word the longest sequence ending there that
stands twice or more (the matching statistic) is followed, and words covered by
sequences of the least length are removed. Shards are dealt out with a shuffle by
anchor, not sent to every task, since all of them together grow with the corpus.

Defined results: NULL and empty texts have no words; a text with fewer words than
the least length stays whole; equal rows lose every sequence that is long enough;
an empty table gives no rows; kept words are joined by one space.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from .batches import WordHashes
from .repeats import Symbols, removed

LEAST_WORDS = 35
GRAM_WORDS = 6

_hashes = WordHashes()


class SuffixAutomaton:
    """All word sequences of several texts, with the number of places where each ends."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words: list, weight: int) -> None:
        """Add a text that stands ``weight`` times."""
        last = 0
        nexts, link, length, count = self.next, self.link, self.length, self.count
        for word in words:
            known = nexts[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                count[last] += weight
                continue
            state = len(nexts)
            if known is not None:  # another text reached here through a longer sequence
                nexts.append(dict(nexts[known]))
                link.append(link[known])
                length.append(length[last] + 1)
                count.append(weight)
                link[known] = state
                p = last
                while p >= 0 and nexts[p].get(word) == known:
                    nexts[p][word] = state
                    p = link[p]
                last = state
                continue
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            count.append(weight)
            p = last
            while p >= 0 and word not in nexts[p]:
                nexts[p][word] = state
                p = link[p]
            if p >= 0:
                q = nexts[p][word]
                if length[q] == length[p] + 1:
                    link[state] = q
                else:
                    clone = len(nexts)
                    nexts.append(dict(nexts[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    count.append(0)
                    while p >= 0 and nexts[p].get(word) == q:
                        nexts[p][word] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def finish(self) -> None:
        """Sum the places of longer sequences into their suffixes."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list, least: int) -> list[tuple[int, int]]:
        """Intervals of a text of this automaton that sequences of ``least`` words, standing twice, cover."""
        out: list[tuple[int, int]] = []
        state, size = 0, 0
        for at, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            while state and self.count[state] < 2:
                state = self.link[state]
                size = self.length[state]
            if size >= least:
                start = at + 1 - size
                if out and start <= out[-1][1]:
                    out[-1] = (min(start, out[-1][0]), at + 1)
                else:
                    out.append((start, at + 1))
        return out


def repeated_in(contexts: list[bytes], counts: list[int], least: int = LEAST_WORDS) -> list[list[tuple[int, int]]]:
    """Per context: word intervals covered by sequences of ``least`` words that start at two places or more."""
    automaton = SuffixAutomaton()
    texts = [c.split() for c in contexts]
    for words, count in zip(texts, counts):
        automaton.add(words, count)
    automaton.finish()
    return [[(0, len(w))] if n > 1 else automaton.repeated(w, least) for w, n in zip(texts, counts)]


WORDS = Symbols(LEAST_WORDS, GRAM_WORDS, bytes.split, _hashes.of, lambda words, start, end: b" ".join(words[start:end]))


def kept_words(text: bytes, spans: list[tuple[int, int]] | None) -> tuple[int, list[bytes]]:
    words = text.split()
    if spans is None:
        spans = [(0, len(words))] if len(words) >= LEAST_WORDS else []
    kept, at = [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return len(words), kept + words[at:]


def digest(text: bytes, spans: list[tuple[int, int]] | None) -> tuple[int, int, str]:
    n, kept = kept_words(text, spans)
    return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    return removed(docs, id_column, text_column, WORDS, repeated_in, digest, "n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the words kept, joined by one space."""
    return removed(docs, id_column, text_column, WORDS, repeated_in, lambda t, s: (b" ".join(kept_words(t, s)[1]).decode(),), "kept string")
