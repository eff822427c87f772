"""Licence scans by sentence rules.

A text is cut into fragments at line ends and sentence ends. Fragments are
normalised to lower-case words and joined, over wrapped lines too, into known
sentences, each with an identifier. Identifier sequences are then matched against
ordered rules, longest first; a rule may skip a few unknown sentences between its
own. Unknown fragments are joined into sentences too, so wrapping changes no gap.

Defined results: NULL and empty texts have no rows, nor have texts without a known
sentence; a licence named twice has two rows; equal rows are scanned one by one;
texts of any length are read whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

#: Sentences of well-known licences and notices.
SENTENCES = {
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "apache-named": "Licensed under the Apache License, Version 2.0.",
    "apache-head": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit-named": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "mpl-head": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "rights": "All rights reserved.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
}

#: Sentence identifiers in order, and the licence they stand for.
RULES = (
    ("Apache-2.0", ("apache-head", "apache-comply", "apache-copy")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-names")),
    ("Apache-2.0", ("apache-head",)),
    ("Apache-2.0", ("apache-named",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("spdx-mit",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-2.0-only", ("gpl2-work",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-or-later", ("spdx-gpl3",)),
    ("BSD-2-Clause", ("bsd-grant",)),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0",)),
    ("CC-BY-4.0", ("cc-by-4.0",)),
    ("CC-BY-4.0", ("cc-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0",)),
    ("MPL-2.0", ("mpl-head",)),
    ("Unlicense", ("unlicense",)),
    ("ISC", ("isc-grant",)),
    ("all-rights-reserved", ("rights",)),
)

#: Sentences between two sentences of a rule that may be unknown; the clauses of BSD-3-Clause have five with their numbers.
GAP = 8
#: Every sentence holds one of these; texts without any are not cut up.
TRIGGERS = (b"licen", b"permission", b"redistribut", b"warranty", b"public domain", b"rights reserved", b"copyright")

FRAGMENT = re.compile(r"(?:[^\n.!?:;]|[.!?:;](?!\s|$))+[.!?:;]*")
WORD = re.compile(r"[^\W_]+")


def normalised(text: str) -> tuple[str, ...]:
    return tuple(WORD.findall(text.lower()))


def continues(text: str, end: int, start: int) -> bool:
    """Whether the sentence of a fragment ending at ``end`` goes on in the next, which begins at ``start``."""
    return text[end - 1] not in ".!?:;" and text.count("\n", end, start) < 2


class SentenceBook:
    """Known sentences by their words, and all beginnings of these."""

    def __init__(self, sentences: dict[str, str]):
        self.ids = {normalised(text): name for name, text in sentences.items()}
        self.beginnings = {words[:i] for words in self.ids for i in range(1, len(words) + 1)}

    def identifiers(self, text: str) -> list[tuple[str | None, int, int]]:
        """(sentence id or None, start, end) in turn, in code points; sentences may span fragments.

        An unknown sentence goes on over line ends up to its end mark, a line without
        words or a known sentence.
        """
        pieces = [(normalised(m[0]), *m.span()) for m in FRAGMENT.finditer(text)]
        pieces = [p for p in pieces if p[0]]
        out, i = [], 0
        while i < len(pieces):
            words, start, end = pieces[i]
            best, j = (None, i + 1, end), i + 1
            while words in self.beginnings:
                if words in self.ids:
                    best = (self.ids[words], j, end)
                if j == len(pieces):
                    break
                words, end, j = words + pieces[j][0], pieces[j][2], j + 1
            if best[0] is None and out and out[-1][0] is None and continues(text, out[-1][2], start):
                out[-1] = (None, out[-1][1], best[2])
            else:
                out.append((best[0], start, best[2]))
            i = best[1]
        return out


def match_rules(found: list[tuple[str | None, int, int]], rules=RULES, gap: int = GAP) -> list[tuple[str, int, int, int]]:
    """(licence, sentences, start, end): at each place the longest rule that fits, no sentence used twice."""
    order = sorted(range(len(rules)), key=lambda r: (-len(rules[r][1]), r))
    used: set[int] = set()
    out = []
    known = [i for i, (name, _, _) in enumerate(found) if name]
    for place, i in enumerate(known):
        if i in used:
            continue
        for r in order:
            licence, wanted = rules[r]
            if found[i][0] != wanted[0]:
                continue
            hits, at = [i], place
            for name in wanted[1:]:
                nxt = next((k for k in range(at + 1, len(known)) if known[k] - hits[-1] - 1 > gap or found[known[k]][0] == name), None)
                if nxt is None or known[nxt] - hits[-1] - 1 > gap or known[nxt] in used:
                    break
                hits.append(known[nxt])
                at = nxt
            if len(hits) == len(wanted):
                used.update(hits)
                out.append((licence, len(hits), found[i][1], found[hits[-1]][2]))
                break
    return out


def scan_licenses(
    docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row for each licence found: doc_id, licence, n_sentences, start and end in code points, end exclusive.

    Own ``sentences`` must each hold one of ``TRIGGERS``.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    known = sentences or SENTENCES
    kind = source.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        book = SentenceBook(known)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows, found = [], []
                for i, raw in enumerate(texts):
                    lower = raw.lower()
                    if any(t in lower for t in TRIGGERS):
                        matches = match_rules(book.identifiers(raw.decode()), rules)
                        rows += [i] * len(matches)
                        found += matches
                names, counts, starts, ends = zip(*found) if found else ([],) * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), *[pa.array(c, pa.int64()) for c in (counts, starts, ends)]],
                    ["doc_id", "licence", "n_sentences", "start", "end"],
                )

    return source.mapInArrow(scan, f"doc_id {kind}, licence string, n_sentences bigint, start bigint, end bigint")
