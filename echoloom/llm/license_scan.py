"""License scan by patience alignment.

Where a text's words are dense in a template's words, the stretch is aligned with the template:
words that are unique in both are anchors, the longest increasing subsequence of them is kept, and
the gaps between anchors are aligned the same way; a gap without unique words is aligned at its
equal ends.  Coverage is the share of the template's words that are aligned.  The words of a licence's
own name that its template has (its version, say), and those listed as needed, must be among them:
notices that differ in those words alone are different licences.

A stretch is aligned whenever SPAN times the template's number of words hold as many words of its
vocabulary as coverage asks for; an alignment of that coverage over such a span cannot be missed.
Of overlapping finds the one with the most aligned words stays, then that of the larger coverage, then
by name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import byte_batches, located_words, to_bytes

#: Least share of a template's words, in per cent, and words that a find may span for each of them.
COVERAGE = 80
SPAN = 1.5
FOUND = "doc_id long, license string, start_byte long, end_byte long, n_matched long, n_template long, coverage double"

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission."
)
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"


def _gnu(kind: str, thing: str, version: str) -> str:
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


#: The terms of the Creative Commons licences, short and in words.
COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
           "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: The notices that are looked for.
TEMPLATES = {
    "AGPL-3.0-notice": _gnu("Affero ", "program", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": f"{_BSD_TWO} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD_TWO} {_BSD_THIRD} {_BSD_END}",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": _gnu("", "program", "2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": _gnu("", "program", "3"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1-notice": _gnu("Lesser ", "library", "2.1"),
    "LGPL-3.0-notice": _gnu("Lesser ", "library", "3"),
    "MIT": "Released under the MIT License.",
    "MIT-notice": _MIT_GRANT,
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:"
    ),
    **{f"CC-{short}-4.0": f"Licensed under CC {short} 4.0." for short in COMMONS},
    **{f"CC-{short}-4.0-notice": f"This work is licensed under the Creative Commons {words} 4.0 International License." for short, words in COMMONS.items()},
}
#: Words that tell one licence from another although its name does not hold them; the words of a name are needed as well.
NEEDED = {
    "AGPL-3.0-notice": "Affero 3", "LGPL-2.1-notice": "Lesser", "LGPL-3.0-notice": "Lesser", "BSL-1.0": "Boost", "BSD-3-Clause": "Neither endorse", "EPL-2.0": "Eclipse", "MPL-2.0": "Mozilla",
    "CC0-1.0": "waived rights", **{f"CC-{short}-4.0-notice": f"Creative Commons {words}" for short, words in COMMONS.items()},
}
#: ASCII punctuation and controls separate words here.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))


def words_of(texts: list[bytes]):
    """Hashes, each text's first word, and byte places of the words, punctuation apart."""
    return located_words([t.translate(_PLAIN) for t in texts])


def rising(places: list[int]) -> list[int]:
    """Indices of one longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(places)
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        if k == len(tops):
            tops.append(p)
            at.append(i)
        else:
            tops[k], at[k] = p, i
        back[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = _once(a, a0, a1), _once(b, b0, b1)
        shared = [(i, once_b[w]) for w, i in once_a.items() if w in once_b]
        shared.sort()
        anchors = [shared[k] for k in rising([j for _, j in shared])]
        if not anchors:
            continue
        out += anchors
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


def _once(words: list, start: int, end: int) -> dict:
    seen: dict = {}
    for i in range(start, end):
        seen[words[i]] = -1 if words[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def needed_words(name: str, needed: Mapping[str, str] = NEEDED) -> str:
    return re.sub("[^0-9A-Za-z]+", " ", f"{name} {needed.get(name, '')}").replace(" notice", "")


class Scanner:
    def __init__(self, templates: Mapping[str, str], percent: int = COVERAGE) -> None:
        self.percent = percent
        self.names = sorted(templates)
        hashes, first, _, _ = words_of([to_bytes(templates[n]) for n in self.names])
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        marks, first, _, _ = words_of([to_bytes(needed_words(n)) for n in self.names])
        self.needed = {n: set(marks[a:b].tolist()) & set(w.tolist()) for n, w, a, b in zip(self.names, self.words, first[:-1], first[1:])}

    def scan(self, texts: list[bytes]) -> list[tuple[int, str, int, int, int, int]]:
        """(text, license, first byte, end byte, matched, words of the template), settled."""
        hashes, first, start, end = words_of(texts)
        finds: list[tuple] = []
        everything = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, dtype=np.uint64)
        if not len(hashes) or not len(everything):
            return []
        slot = np.minimum(np.searchsorted(everything, hashes), len(everything) - 1)
        some = np.flatnonzero(everything[slot] == hashes)  # words of any template: all others cannot be aligned
        text = np.searchsorted(first, some, side="right") - 1
        for name, words in zip(self.names, self.words):
            if not len(words):
                continue
            own = some[np.isin(hashes[some], words)]
            of = np.searchsorted(first, own, side="right") - 1
            least = -(-len(words) * self.percent // 100)
            width = max(len(words), int(np.ceil(len(words) * SPAN)))
            if len(own) < least:
                continue
            dense = own[least - 1 :] - own[: len(own) - least + 1] < width
            dense &= of[least - 1 :] == of[: len(own) - least + 1]
            # Places that are in a dense run; runs that touch are one stretch.
            a = own[: len(own) - least + 1][dense]
            if not len(a):
                continue
            t = of[: len(own) - least + 1][dense]
            new = np.ones(len(a), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (a[1:] >= a[:-1] + width)
            lows, highs = a[new], np.minimum(a[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)] + width, first[t[new] + 1])
            for low, high, doc in zip(lows.tolist(), highs.tolist(), t[new].tolist()):
                finds += self._align(name, words.tolist(), hashes, low, high, width, least, doc)
        finds.sort(key=lambda f: (f[0], -f[4], -f[4] / f[5], f[1], f[2]))
        kept: list[tuple] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for f in finds:
            if all(f[3] <= a or f[2] >= b for a, b in taken.setdefault(f[0], [])):
                taken[f[0]].append((f[2], f[3]))
                kept.append((f[0], f[1], int(start[f[2]]), int(end[f[3] - 1]), f[4], f[5]))
        return sorted(kept)

    def _align(self, name, words, hashes, low, high, width, least, doc) -> Iterator[tuple]:
        """The finds of one template in a stretch: windows from the left, going on after each find."""
        inside = set(words)
        at = low
        while at < high:
            if int(hashes[at]) not in inside:
                at += 1
                continue
            stop = min(high, at + width)
            pairs = patience(hashes[at:stop].tolist(), words)
            if len(pairs) >= least and self.needed[name] <= {words[j] for _, j in pairs}:
                # A later start may do better as long as it is inside this find.
                best, place = pairs, at
                for later in range(at + 1, min(high, at + len(words) // 2 + 1)):
                    if int(hashes[later]) in inside:
                        more = patience(hashes[later : min(high, later + width)].tolist(), words)
                        if len(more) > len(best) and self.needed[name] <= {words[j] for _, j in more}:
                            best, place = more, later
                first, last = place + best[0][0], place + best[-1][0] + 1
                yield (doc, name, first, last, len(best), len(words))
                at = last
            else:
                at += 1


def _scan(templates: Mapping[str, str], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, percent)
        names = [f.split()[0] for f in FOUND.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (to_bytes(t.as_py()) for t in batch.column(1)))
            for part in byte_batches(rows):
                found = [(part[t][0], *rest, rest[-2] / rest[-1]) for t, *rest in scanner.scan([text for _, text in part])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return run


def scan_documents(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = COVERAGE) -> DataFrame:
    """A row for each license find in (doc_id, text): where, how many template words, coverage.

    One narrow pass.  Null and empty texts have no finds; a null id stays null; repeated rows each get
    theirs; other columns are not looked at.  `templates` may hold any texts, whole licences included.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan(dict(templates), percent), FOUND)
