"""Licence scan: a trained classifier predicts the licence families of paragraphs, a template or name confirms them.

A softmax regression on word n-grams gives every paragraph a probability for each licence family and for
*unknown*; a temperature, set on templates and names held out from the fit, calibrates them.  Consecutive
lines are paragraphs too, so a statement may be wrapped.  A family that is likelier than unknown is confirmed
where most word pairs of one of its templates stand close together, or its licence is named after a
lead (*released under the*), before *licensed* or as a heading.
"""

from __future__ import annotations

import random
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, raw_texts, slices

#: Sentences by which texts state their licence, by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache License 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under the GNU General Public License, version 2.",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        *(f"{x} the public domain" for x in ("released into", "released to", "dedicated to", "placed in", "placed into", "is in", "are in")),
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "This software is proprietary and confidential.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "may be reproduced in any form without permission",
        "Confidential and proprietary information",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
#: Names of licences: what a heading consists of, or what follows a lead.  No family is of no concern here, but its
#: names hide those of others that they contain.
NAMES = {
    "apache": ["Apache License", "Apache Software License", "Apache Public License", "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Licensed under Apache", "License: Apache", "apache.org/licenses"],
    "mit": ["MIT License", "MIT License (MIT)", "Expat License", "MIT/X11 License", "MIT-style License", "opensource.org/licenses/MIT"],
    "gpl": ["GNU General Public License", "GNU GPL", "General Public License", "GNU General Public License v2.0", "GNU General Public License, version 3", "GPL License", "gnu.org/licenses/gpl"],
    "lgpl": ["GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "Lesser General Public License", "Lesser GPL", "LGPL License", "GNU Lesser General Public License v2.1", "gnu.org/licenses/lgpl"],
    "bsd": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "New BSD License", "Modified BSD License", "Simplified BSD License", "Revised BSD License", "2-Clause BSD License", "3-Clause BSD License", "BSD-style License", "opensource.org/licenses/BSD"],
    "mpl": ["Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL License", "mozilla.org/MPL"],
    "cc-by": ["Creative Commons Attribution", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution License", "CC Attribution", "CC BY 4.0", "CC BY 3.0", "creativecommons.org/licenses/by"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike", "Creative Commons Attribution Share Alike", "CC Attribution-ShareAlike", "CC BY-SA", "Creative Commons BY-SA", "creativecommons.org/licenses/by-sa"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial", "Creative Commons Attribution Non Commercial", "CC Attribution-NonCommercial", "CC BY-NC", "Creative Commons BY-NC", "creativecommons.org/licenses/by-nc"],
    "public-domain": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Public Domain Dedication", "Unlicense", "creativecommons.org/publicdomain/zero"],
    "": ["GNU Affero General Public License", "Affero General Public License", "GNU AGPL", "AGPL 3.0", "Creative Commons Attribution-NoDerivatives", "Creative Commons Attribution-NoDerivs", "CC BY-ND", "creativecommons.org/licenses/by-nd", "gnu.org/licenses/agpl"],
}
#: Names so short that they count after a lead only.
SHORT_NAMES = {
    "apache": ["Apache 2.0", "Apache-2.0", "Apache 2", "Apache v2", "ASL 2.0"],
    "mit": ["MIT", "Expat", "MIT/X11", "X11"],
    "gpl": ["GPL", "GPLv2", "GPLv3", "GPL v2", "GPL v3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL 2", "GPL 3", "GPLv2+", "GPLv3+"],
    "lgpl": ["LGPL", "LGPLv2", "LGPLv2.1", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-only", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "bsd": ["BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD 2-Clause", "BSD 3-Clause", "2-Clause BSD", "3-Clause BSD", "0BSD"],
    "mpl": ["MPL", "MPL 2.0", "MPL-2.0", "MPLv2", "MPL 1.1"],
    "cc-by": ["CC BY", "CC-BY-4.0", "CC-BY-3.0", "Creative Commons BY"],
    "public-domain": ["CC0", "CC0-1.0"],
    "": ["AGPL", "AGPLv3", "AGPL-3.0"],
}
#: Words that lead to a licence's name, and those that may stand between.
LEADS = [
    *(f"{x} under" for x in "licensed released distributed available published provided offered shared issued used covered made".split()),
    "use under", "under the terms of", "under terms of", "subject to", "governed by", "covered by", "licensed as", "license", "licenses",
    "license is", "license identifier", "licensed", "licensed with",
]
#: Those that count before names that aren't short, or that *license* follows.
LONG_LEADS = ["under", "permitted by", "allowed by", "terms as"]
BETWEEN = {w.encode() for w in "the a an terms of conditions either both any and or version v license s standard permissive open source free http https www see at 0 1 2 3 4".split()}
#: Words of a heading's line at most that are neither a name's nor among those.
HEADING = 3
#: Sentences that speak of licences without stating one.
OTHERS = [
    "He renewed his driving license in the general office under the bridge.",
    "The version of the story that was released in public is free.",
    "A fishing license is required in this part of the state.",
    "The apache helicopter was released from work at the institute.",
    "Permission to use the hall is granted by the council on request.",
    "All seats are reserved and the rights of way are public.",
    "The library is open to the general public without a charge.",
    "The history of the Apache License and of the GNU General Public License was the subject of the talk.",
    "She read the MIT License before the course and had a question on the BSD License.",
    "The Mozilla Public License was written by a lawyer, and Creative Commons Attribution came later.",
    "Copyright law and the terms of a license were the topic of the work.",
    "This program of the theatre is distributed free of charge.",
    "Students at MIT released a new version of the software.",
]
UNKNOWN = "unknown"
#: Least share of a template's word pairs that a passage must hold.
LEAST_CONTAINED = 0.8
#: Words that a passage spans at most: so many times its template's, and so many more.
REACH_TIMES, REACH_MORE = 2, 16
#: Words of a paragraph that is judged at once.
PARAGRAPH = 60
#: Bytes of texts whose words are held, and paragraphs whose n-grams are looked at, at once.
BLOCK_BYTES, AT_ONCE = 1 << 19, 2048
#: Words that mark a comment at the head of a line; marks without letters are no words.
COMMENT = {b"rem", b"dnl"}
#: Paragraphs of the corpus that the unknown class is learned from, and characters of each.
SAMPLE, SAMPLE_CHARS = 2000, 1000
STEPS, L2, RATE = 250, 1e-4, 0.5
_WORD = bytes(c if 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words(paragraph: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII; *licence* becomes *license*."""
    return paragraph.translate(_WORD).replace(b"licence", b"license").split()


def grams(own: list[bytes], known: dict[bytes, int] | None = None) -> set:
    """The words, word pairs and word triples of a paragraph; the numbers of those that are known, if given."""
    two = map(b" ".join, zip(own, own[1:], strict=False))
    three = map(b" ".join, zip(own, own[1:], own[2:], strict=False))
    if known is None:
        return {*own, *two, *three}
    # A pair or triple is known only if its words are.
    if not any(w in known for w in own):
        return set()
    return {known[g] for g in (*own, *two, *three) if g in known}


def pairs(own: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(own, own[1:], strict=False))


@dataclass
class Passage:
    """Where a block of words holds a family's template: first and last word, and the share of its pairs."""

    family: str
    first: int
    last: int
    share: float


class Template:
    """The word pairs of a statement, those that a passage must hold, and the words that it may span."""

    def __init__(self, family: str, own: list[bytes]) -> None:
        self.family, self.pairs = family, pairs(own)
        if not self.pairs:
            raise ValueError(f"a template of {family!r} has less than two words")
        self.least = max(1, int(np.ceil(LEAST_CONTAINED * len(self.pairs) - 1e-9)))
        self.reach = REACH_TIMES * len(own) + REACH_MORE

    def passages(self, hits: list[tuple[int, tuple[bytes, bytes]]]) -> Iterator[Passage]:
        """The passages among the places of this template's pairs, in order; none overlaps the next."""
        window: deque = deque()
        times: Counter = Counter()
        for k, (at, pair) in enumerate(hits):
            window.append((at, pair))
            times[pair] += 1
            # Pairs out of reach go, and those at the front that come again.
            while at + 2 - window[0][0] > self.reach or times[window[0][1]] > 1:
                gone = window.popleft()[1]
                times[gone] -= 1
                if not times[gone]:
                    del times[gone]
            if len(times) < self.least:
                continue
            after = hits[k + 1] if k + 1 < len(hits) else None
            if after and after[1] not in times and after[0] + 2 - window[0][0] <= self.reach:
                continue  # the passage goes on
            yield Passage(self.family, window[0][0], at + 1, len(times) / len(self.pairs))
            window.clear()
            times.clear()


def _by_word(phrases: list[tuple[str, str, bool]], at: int) -> dict[bytes, list[tuple[list[bytes], str, bool]]]:
    """Phrases, as words, by their first or last word; longer ones first."""
    out: dict[bytes, list] = {}
    for phrase, family, is_long in phrases:
        own = words(phrase.encode())
        out.setdefault(own[at], []).append((own, family, is_long))
    return {w: sorted(of, key=lambda x: -len(x[0])) for w, of in out.items()}


_NAMED = _by_word([(n, f, long) for long, of in ((True, NAMES), (False, SHORT_NAMES)) for f, own in of.items() for n in own], 0)
_LEADS = _by_word([(x, "", x in LONG_LEADS) for x in [*LEADS, *LONG_LEADS]], -1)


@dataclass
class Name:
    """A licence's name in a block: first word, the one after the last, family, and whether it may be a heading."""

    first: int
    end: int
    family: str
    is_long: bool


def names(own: list[bytes]) -> list[Name]:
    """The names in the words of a block, in order, the longest at each place; none overlaps the next."""
    out, end = [], 0
    for k in [k for k, w in enumerate(own) if w in _NAMED]:
        of = next((x for x in _NAMED[own[k]] if own[k : k + len(x[0])] == x[0]), None) if k >= end else None
        if of:
            end = k + len(of[0])
            out.append(Name(k, end, *of[1:]))
    return out


def _lead(own: list[bytes], end: int, is_long: bool) -> int:
    """The words of the lead to a name that ends before a place; 0 if none does."""
    of = _LEADS.get(own[end - 1], ()) if end else ()
    return next((len(x) for x, _, for_long in of if is_long >= for_long and own[max(0, end - len(x)) : end] == x), 0)


def stated(own: list[bytes], starts: list[int], found: list[Name]) -> Iterator[Passage]:
    """The names that stand after a lead, before *licensed*, or as a heading.  ``starts`` has the first word of each line, and the end."""
    covered = {k for name in found for k in range(name.first, name.end)}
    for name in found:
        is_long = name.is_long or own[name.end : name.end + 1] == [b"license"]
        at = name.first
        while not (lead := _lead(own, at, is_long)) and at and (own[at - 1] in BETWEEN or at - 1 in covered):
            at -= 1
        after = name.end
        while after < len(own) and own[after] in BETWEEN:
            after += 1
        end = after + 1 if own[after : after + 1] == [b"licensed"] else name.end
        line = bisect_right(starts, name.first) - 1
        more = sum(k not in covered and own[k] not in BETWEEN for k in range(starts[line], starts[line + 1]))
        if name.family and (lead or end > name.end or is_long and more <= HEADING):
            yield Passage(name.family, at - lead if lead else name.first, end - 1, 1.0)


class Lookup:
    """The numbers of codes, for whole arrays at once."""

    def __init__(self, numbers: dict[int, int]) -> None:
        self.codes = np.array(sorted(numbers), np.int64)
        self.numbers = np.array([numbers[c] for c in sorted(numbers)], np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The number of each code; -1 for those without."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.numbers[at], -1)


@dataclass
class Model:
    """Families (unknown first), number of each known n-gram, weights, templates, and the templates of each word pair."""

    families: list[str]
    known: dict[bytes, int]
    weights: np.ndarray
    bias: np.ndarray
    templates: list[Template]
    places: dict[tuple[bytes, bytes], list[int]]
    temperature: float = 1.0

    def __post_init__(self) -> None:
        # A pair is coded by the numbers of its words, a triple by those of its first pair and its last word; an n-gram is
        # in as many examples as make it known only if its parts are.
        pair, triple = {}, {}
        for gram, k in self.known.items():
            own = gram.split(b" ")
            if len(own) == 2:
                pair[self._code(self.known[own[0]], self.known[own[1]])] = k
            elif len(own) == 3:
                triple[self._code(self.known[b" ".join(own[:2])], self.known[own[2]])] = k
        self.of_pair, self.of_triple = Lookup(pair), Lookup(triple)

    def _code(self, first, last):
        return first * len(self.known) + last

    def probabilities(self, own: list[bytes]) -> np.ndarray:
        """Those of one paragraph."""
        return self.of_paragraphs(own, [range(len(own))])[0]

    def _numbers(self, own: list[bytes]) -> list[np.ndarray]:
        """The numbers of the known words, pairs and triples that begin at each word; -1 for others."""
        one = np.fromiter((self.known.get(w, -1) for w in own), np.int64, len(own))
        two = np.where((one[:-1] < 0) | (one[1:] < 0), -1, self.of_pair.of(self._code(one[:-1], one[1:])))
        three = np.where((two[:-1] < 0) | (one[2:] < 0), -1, self.of_triple.of(self._code(two[:-1], one[2:])))
        return [one, two, three]

    def of_paragraphs(self, own: list[bytes], found: list[range]) -> np.ndarray:
        """The probabilities of paragraphs, given as ranges of words: a row each.  An n-gram counts once a paragraph."""
        first, end = (np.array([getattr(at, x) for at in found], np.int64) for x in ("start", "stop"))
        z = np.tile(self.bias, (len(found), 1))
        for more, numbers in enumerate(self._numbers(own)):
            places = np.flatnonzero(numbers >= 0)
            numbers = numbers[places]
            order = np.argsort(numbers, kind="stable")
            again = numbers[order[1:]] == numbers[order[:-1]]
            before = np.full(len(numbers), -1)
            before[order[1:][again]] = order[:-1][again]
            low = np.searchsorted(places, first)
            n = np.maximum(np.searchsorted(places, end - more) - low, 0)
            for k in range(0, len(found), AT_ONCE):
                self._add(z[k : k + AT_ONCE], numbers, before, low[k : k + AT_ONCE], n[k : k + AT_ONCE])
        z /= self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def _add(self, z: np.ndarray, numbers: np.ndarray, before: np.ndarray, low: np.ndarray, n: np.ndarray) -> None:
        """Add the weights of the ``n`` numbers from each ``low`` on, but of those that came ``before`` there."""
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(row)) + np.repeat(low - np.cumsum(n) + n, n)
        new = before[at] < low[row]
        n = np.bincount(row[new], minlength=len(n))
        some = n > 0
        if some.any():
            z[some] += np.add.reduceat(self.weights[numbers[at[new]]], (np.cumsum(n) - n)[some])

    def passages(self, own: list[bytes]) -> list[Passage]:
        """Where the words of a block hold a template."""
        hits: dict[int, list] = {}
        for at, pair in [x for x in enumerate(zip(own, own[1:], strict=False)) if x[1] in self.places]:
            for t in self.places[pair]:
                hits.setdefault(t, []).append((at, pair))
        return [p for t, of in hits.items() if len(of) >= self.templates[t].least for p in self.templates[t].passages(of)]

    def judge(self, own: list[bytes], starts: list[int], by_family: dict[str, list[tuple[range, float]]]) -> list[tuple[str, float, range]]:
        """The statements of a block, given as its words and the first ones of its lines: family, probability, and lines.

        What the classifier predicts for the paragraphs is confirmed by a template of its family, or
        the name of a licence of it where one is stated, that stands for the greater part inside the paragraph.
        """
        found = names(own)
        held = [p for p in self.passages(own) if self._own_name(p, found)]
        out = []
        for passage in [*held, *stated(own, starts, found)]:
            most = (passage.last + 1 - passage.first) / 2
            inside = [p for at, p in by_family.get(passage.family, ()) if min(at.stop, passage.last + 1) - max(at.start, passage.first) > most]
            if inside:
                first, last = bisect_right(starts, passage.first) - 1, bisect_right(starts, passage.last) - 1
                out.append((passage.family, max(inside), range(first, last + 1)))
        return out

    @staticmethod
    def _own_name(passage: Passage, found: list[Name]) -> bool:
        """Whether a passage names its own family's licence, or none."""
        inside = {n.family for n in found if n.first <= passage.last and n.end > passage.first}
        return not inside or passage.family in inside

    def predicted(self, texts: list[list[list[list[bytes]]]]) -> Iterator[list[dict[str, list[tuple[range, float]]]]]:
        """The families that the classifier sees in each block of each text: the words of their paragraphs, and its probability.

        Families that are stated side by side share the probability: each needs more than unknown has.
        """
        own: list[bytes] = []
        found: list[range] = []
        starts_of, ends = [], []
        for block in (block for text in texts for block in text):
            starts_of.append(len(own))
            found += [range(at.start + len(own), at.stop + len(own)) for at in paragraphs(_starts(block))]
            own += [w for line in block for w in line]
            ends.append(len(found))
        p = self.of_paragraphs(own, found)
        likely = np.argwhere(p > p[:, :1])
        out: list[dict] = [{} for _ in ends]
        for (k, family), b in zip(likely.tolist(), np.searchsorted(ends, likely[:, 0], side="right").tolist(), strict=True):
            at = range(found[k].start - starts_of[b], found[k].stop - starts_of[b])
            out[b].setdefault(self.families[family], []).append((at, float(p[k, family])))
        rest = iter(out)
        for text in texts:
            yield [next(rest) for _ in text]

    def scan(self, lines: list[bytes]) -> tuple[set[str], int, float | None]:
        """What ``scans`` says of a text."""
        return next(self.scans([lines]))

    def scans(self, texts: list[list[bytes]]) -> Iterator[tuple[set[str], int, float | None]]:
        """Of texts, as lines: the confirmed families, on how many lines their statements stand, and the largest probability."""
        of_texts = [list(blocks(lines)) for lines in texts]
        for text, seen in zip(of_texts, self.predicted(of_texts), strict=True):
            families, n, most = set(), 0, None
            for block, by_family in zip(text, seen, strict=True):
                found = self.judge([w for line in block for w in line], _starts(block), by_family) if by_family else []
                families |= {f for f, _, _ in found}
                n += len({k for _, _, at in found for k in at})
                most = max([p for _, p, _ in found] + ([] if most is None else [most]), default=None)
            yield families, n, most


def _starts(block: list[list[bytes]]) -> list[int]:
    """The first word of each line of a block, and its end."""
    return [0, *accumulate(map(len, block))]


def blocks(lines: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of consecutive lines that have words, without those that mark a comment."""
    block = []
    for line in lines:
        own = words(line)
        own = own[1:] if own and own[0] in COMMENT else own
        if own:
            block.append(own)
        elif block:
            yield block
            block = []
    if block:
        yield block


def paragraphs(starts: list[int]) -> Iterator[range]:
    """What of a block the classifier judges, as ranges of words: every line, the lines from each one on as far as
    ``PARAGRAPH`` words go, and longer lines in pieces of so many, half of each in the next."""
    for k, (first, end) in enumerate(zip(starts, starts[1:], strict=False)):
        for at in range(first, max(first + 1, end - PARAGRAPH // 2), PARAGRAPH // 2):
            yield range(at, min(at + PARAGRAPH, end))
        last = bisect_right(starts, first + PARAGRAPH) - 1
        if last > k + 1:
            yield range(first, starts[last])


def _examples(corpus: list[bytes], templates: dict[str, list[str]]) -> list[tuple[list[bytes], str, tuple]]:
    """Training paragraphs, their families and what they come from: templates and names, plain, damaged and amid
    running text; corpus paragraphs without a template."""
    draw = random.Random(11)
    plain = [words(p) for p in corpus]
    filler = [p for p in plain if len(p) >= 4] or [[b"text"] * 8]
    shapes = {family: [pairs(words(t.encode())) for t in own] for family, own in templates.items()}
    out = []
    for family, own in templates.items():
        for template in own:
            base = words(template.encode())
            for k in range(24):
                kept = [w for w in base if k < 8 or draw.random() > 0.08] or base
                around = draw.choice(filler)
                cut = draw.randrange(len(around))
                if k % 3 == 1:
                    kept = [*around[:cut][-30:], *kept]
                elif k % 3 == 2:
                    kept = [*kept, *around[cut:][:30]]
                out.append((kept, family, tuple(base)))
    for is_long, of in ((True, NAMES), (False, SHORT_NAMES)):
        for family, own in of.items():
            for base in [words(n.encode()) for n in own for _ in range(12)] if not family or family in templates else []:
                lead = [] if is_long and draw.random() < 0.3 else words(f"{draw.choice(LEADS)} {draw.choice(['', 'the'])}".encode())
                before, after = (draw.choice(filler)[: draw.choice([0, 0, 4, 30])] for _ in range(2))
                out.append(([*before, *lead, *base, *after], family or UNKNOWN, tuple(base)))
    for own in [*plain, *(words(x.encode()) for x in OTHERS for _ in range(12))]:
        have = pairs(own)
        if not any(len(t & have) >= 0.5 * len(t) for shape in shapes.values() for t in shape):
            out.append((own, UNKNOWN, tuple(own)))
    draw.shuffle(out)
    return out


def fit(corpus: list[bytes], templates: dict[str, list[str]] | None = None) -> Model:
    """A model from templates and a sample of the corpus's paragraphs.

    The temperature is that of a trial model, on a quarter of the templates, names and paragraphs that the trial is
    not fitted on in any form.
    """
    templates = templates or TEMPLATES
    examples = _examples(corpus, templates)
    sources = sorted({source for _, _, source in examples})
    held = set(random.Random(12).sample(sources, len(sources) // 4))
    trial = _fitted([x for x in examples if x[2] not in held], templates)
    model = _fitted(examples, templates)
    model.temperature = _temperature(trial, [(own, family) for own, family, source in examples if source in held])
    return model


def _fitted(examples: list[tuple[list[bytes], str, tuple]], templates: dict[str, list[str]]) -> Model:
    fitted = [(own, family) for own, family, _ in examples]
    families = [UNKNOWN, *templates]
    seen: dict[bytes, set[int]] = {}
    for k, (own, _) in enumerate(fitted):
        for g in grams(own):
            seen.setdefault(g, set()).add(k)
    often = sorted(g for g, of in seen.items() if len(of) >= 3)
    # A pair or triple whose words are all unknown would never be looked up.
    singles = {g for g in often if b" " not in g}
    known = {g: k for k, g in enumerate(g for g in often if b" " not in g or singles.intersection(g.split(b" ")))}
    at = [sorted(grams(own, known)) for own, _ in fitted]
    row = np.repeat(np.arange(len(at)), [len(x) for x in at])
    col = np.array([k for x in at for k in x], np.int64)
    n = len(families)
    truth = np.array([families.index(f) for _, f in fitted])
    goal = np.eye(n)[truth]
    weight = (1 / np.maximum(np.bincount(truth, minlength=n), 1))[truth]
    weight /= weight.sum()
    w, bias, sum_w, sum_b = np.zeros((len(known), n)), np.zeros(n), np.full((len(known), n), 1e-8), np.full(n, 1e-8)
    for _ in range(STEPS):
        z = np.column_stack([np.bincount(row, w[col, k], len(at)) for k in range(n)]) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = weight[:, None] * (p / p.sum(axis=1, keepdims=True) - goal)
        by_w = np.column_stack([np.bincount(col, slope[row, k], len(known)) for k in range(n)]) + L2 * w
        by_b = slope.sum(axis=0)
        sum_w += by_w**2
        sum_b += by_b**2
        w -= RATE / np.sqrt(sum_w) * by_w
        bias -= RATE / np.sqrt(sum_b) * by_b
    shapes = [Template(f, words(t.encode())) for f, own in templates.items() for t in own]
    places: dict[tuple[bytes, bytes], list[int]] = {}
    for k, shape in enumerate(shapes):
        for pair in shape.pairs:
            places.setdefault(pair, []).append(k)
    return Model(families, known, w, bias, shapes, places)


def _temperature(model: Model, held_out: list[tuple[list[bytes], str]]) -> float:
    """The temperature under which held-out paragraphs are likeliest."""

    def loss(t: float) -> float:
        model.temperature = t
        return -sum(np.log(model.probabilities(own)[model.families.index(f)] + 1e-12) for own, f in held_out)

    return min(np.geomspace(0.25, 8, 11), key=loss)


def learned(docs: DataFrame, sample: int = SAMPLE, text_column: str = "text") -> Model:
    """A model whose unknown class is learned from a bounded sample: about ``sample`` documents drawn by a hash of
    the text, and of each one paragraph of at most ``SAMPLE_CHARS`` characters."""
    rows = docs.select(column(text_column).alias("text")).where("text IS NOT NULL")
    n = rows.count()
    if not n:
        return fit([])
    drawn = rows.where(F.pmod(F.xxhash64("text", F.lit("licence")), F.lit(1 << 30)) < min(1.0, sample / n) * (1 << 30))
    lines = F.split("text", "\n")
    line = F.get(lines, F.pmod(F.xxhash64("text"), F.size(lines)).cast("int"))
    # Copies of one text are drawn together: one of them is enough, and keeps the sample bounded.
    some = drawn.select(F.substring(line, 1, SAMPLE_CHARS).alias("p")).distinct().orderBy(F.xxhash64("p"), "p").limit(sample)
    return fit([r["p"].encode() for r in some.collect()])


def scanned(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``licences`` (confirmed families, sorted, comma-joined; null if none),
    ``n_paragraphs``, ``n_licensed`` and ``confidence`` (the largest probability of a confirmed family; null if none).

    Paragraphs are lines that aren't blank, whole; null and empty texts have none.  Licensed are those that a confirmed
    statement stands on; it may go on over lines up to the next one without words.  The model (bounded by its
    sample) is broadcast; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, BLOCK_BYTES):
            texts = [(text or b"").split(b"\n") for text in raw_texts(batch)]
            rows = [
                (",".join(sorted(families)) or None, sum(1 for x in lines if x.strip()), n_licensed, confidence)
                for lines, (families, n_licensed, confidence) in zip(texts, model.scans(texts), strict=True)
            ]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64()]
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "licences", "n_paragraphs", "n_licensed", "confidence"])

    rows = docs.select(column(id_column).alias("doc_id"), column(text_column).alias("text"))
    return in_tasks(rows, run, f"doc_id {kind}, licences string, n_paragraphs bigint, n_licensed bigint, confidence double")
