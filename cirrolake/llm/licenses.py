"""License scans by conditional compression.

A quotation compresses to much less when zstandard may refer to the license it quotes. Texts that speak of licenses are
searched whole, however their lines are wrapped: runs of words that any template holds lead to the candidate blocks. Each
block is compressed alone and with every template as a raw dictionary, the templates are ranked by the bytes they save,
and the best one whose wording is confirmed, its words laid beside the block's and the exact differences named, wins the
block. Of quotations that overlap, the one on which its template saves most bytes stays. Rows are independent, so
nothing is shuffled; the templates, a stated few, travel with the code.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cirrolake.llm.common import keyed_texts, pieces

# Notices of public licenses, in their own words; those of one family share what they have in common.
GNU = (
    "This {work} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {name}General Public "
    "License as published by the Free Software Foundation{mark} either version {version} of the License, or (at your option) any "
    "later version."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the copyright holder."
)
BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": GNU.format(work="program", stop=":", mark=",", name="", version="3"),
    "GPL-2.0-header": GNU.format(work="program", stop=";", mark=";", name="", version="2"),
    "LGPL-3.0-header": GNU.format(work="library", stop=":", mark=",", name="Lesser ", version="3"),
    "LGPL-2.1-header": GNU.format(work="library", stop=";", mark=";", name="Lesser ", version="2.1"),
    "LGPL-2.0-header": GNU.format(work="library", stop=";", mark=";", name="Library ", version="2"),
    "AGPL-3.0-header": GNU.format(work="program", stop=":", mark=",", name="Affero ", version="3"),
    "BSD-2-Clause": f"{BSD} {BSD_WARRANTY}",
    "BSD-3-Clause": f"{BSD} {BSD_NAMES} {BSD_WARRANTY}",
    "BSD-4-Clause": f"{BSD} {BSD_ADVERTISING} {BSD_NAMES} {BSD_WARRANTY}",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "reserved": "All rights reserved.",
}

#: Words by which a text is a candidate; every template holds one of them.
HINT = re.compile(r"licen[cs]e|copyright|permission|redistribut|free\s+software|unencumbered\s+software|reserved|creative\s+commons|mozilla|cc\s+by", re.I)
WORD = re.compile(r"[\w.+-]+")
#: One of so many words of a template may be missing or of a quotation be added; share of its size that a template saves.
WORDS_A_SLIP, SAVED = 20, 0.3
#: Words that tell licenses of one family apart. A quotation that differs in one is of another license; numbers, which
#: name versions, do so where the template has one.
DECIDING = frozenset("lesser affero library neither endorse promote advertising acknowledgement".split())
#: What the licensed work is called tells nothing.
SAME_WORK = {"-program +library", "-library +program"}
NUMBER = re.compile(r"\d+(\.\d+)*")
#: Words in a row by which a quotation is found. With so few slips every quotation has a run of them.
SEED = 5
#: Words that are scanned at a time; parts overlap by the longest template with its slips.
PART = 20_000
#: Blocks whose winner a worker remembers; none is longer than the longest template with its slips.
KNOWN_BLOCKS = 20_000


def words(text: str) -> list[str]:
    return [w.strip(".-+") for w in WORD.findall(text.lower()) if w.strip(".-+")]


def placed(text: str) -> Iterator[tuple[str, int]]:
    """(word, where it begins) for each word of a text, as `words` cuts it."""
    for m in WORD.finditer(text):
        word = m.group().lower().strip(".-+")
        if word:
            yield word, m.start()


class Scanner:
    """Templates with their compressors and seeds, each built once."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: words(text) for name, text in templates.items()}
        self.slips = {name: len(w) // WORDS_A_SLIP for name, w in self.words.items()}
        self.numbered = {name for name, w in self.words.items() if any(map(NUMBER.fullmatch, w))}
        self.longest = max((len(w) + 2 * self.slips[name] for name, w in self.words.items()), default=0)
        self.plain = zstandard.ZstdCompressor(level=3)
        self.primed = {
            name: zstandard.ZstdCompressor(
                level=3,
                dict_data=zstandard.ZstdCompressionDict(" ".join(self.words[name]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for name in templates
        }
        self.seeds: dict[int, dict[tuple, list[tuple[str, int]]]] = {}
        for name, expected in self.words.items():
            width = min(SEED, len(expected))
            for at in range(len(expected) - width + 1 if width else 0):
                self.seeds.setdefault(width, {}).setdefault(tuple(expected[at : at + width]), []).append((name, at))
        self.bags = {name: Counter(w) for name, w in self.words.items()}
        self.known: dict[tuple, tuple | None] = {}

    def reductions(self, block: list[str]) -> tuple[int, list[tuple[int, str]]]:
        """(compressed size of a block, [(bytes that a template saves on it, template)]), most bytes first, then by name."""
        raw = " ".join(block).encode()
        alone = len(self.plain.compress(raw))
        every = ((alone - len(primed.compress(raw)), name) for name, primed in self.primed.items())
        return alone, sorted(every, key=lambda x: (-x[0], x[1]))

    def saved(self, name: str, found: list[str]) -> tuple[int, float]:
        """Bytes, and the share of the compressed size of a quotation, that the template saves."""
        raw = " ".join(found).encode()
        alone = len(self.plain.compress(raw))
        less = alone - len(self.primed[name].compress(raw))
        return less, less / alone

    def decides(self, name: str, word: str) -> bool:
        return word in DECIDING or (name in self.numbered and bool(NUMBER.fullmatch(word)))

    def differences(self, name: str, found: list[str]) -> tuple[float, int, int, int, list[str]]:
        """(covered, first word, end, words of the template that fit, differences) of a template within some words."""
        expected = self.words[name]
        matcher = SequenceMatcher(None, expected, found, autojunk=False)
        same = [m for m in matcher.get_matching_blocks() if m.size]
        if not same:
            return 0.0, 0, 0, 0, []
        start, end = same[0].b, same[-1].b + same[-1].size
        said = []
        for kind, a, b, c, d in SequenceMatcher(None, expected, found[start:end], autojunk=False).get_opcodes():
            if kind != "equal":
                said.append(f"-{' '.join(expected[a:b])} +{' '.join(found[start + c : start + d])}")
        fit = sum(m.size for m in same)
        return fit / len(expected), start, end, fit, said

    def blocks(self, found: list[str]) -> set[tuple[int, int]]:
        """(first word, end) of each stretch of `found` in which as many seeds lie as a quotation of their template has."""
        stretches = set()
        begins: dict[str, list[int]] = {}
        for width, seeds in self.seeds.items():
            for at in range(len(found) - width + 1):
                for name, into in seeds.get(tuple(found[at : at + width]), ()):
                    begins.setdefault(name, []).append(at - into)
        for name, at in begins.items():
            expected, slips = len(self.words[name]), self.slips[name]
            width = min(SEED, expected)
            # A slip, a word missing or added, breaks at most `width` seeds and moves those behind it by one.
            least = max(1, expected - width + 1 - 2 * slips * width)
            at.sort()
            low, done = 0, None
            for high, begin in enumerate(at):
                while at[low] < begin - 2 * slips:
                    low += 1
                if high - low + 1 >= least and (done is None or at[low] > done):
                    stretches.add((max(0, at[low] - slips), min(len(found), at[low] + expected + 3 * slips)))
                    done = at[low] + 2 * slips
        return stretches

    def confirmed(self, name: str, found: list[str]) -> tuple | None:
        """(bytes saved, covered, share saved, first word, end, differences) if a block quotes a template with few slips."""
        expected = self.words[name]
        if (self.bags[name] & Counter(found)).total() < len(expected) - self.slips[name]:
            return None
        covered, start, end, fit, said = self.differences(name, found)
        if len(expected) - fit > self.slips[name] or end - start - fit > self.slips[name]:
            return None
        if any(self.decides(name, w.lstrip("-+")) for x in said if x not in SAME_WORK for w in x.split()):
            return None
        less, share = self.saved(name, found[start:end])
        return (less, covered, share, start, end, said) if share >= SAVED else None

    def winner(self, block: list[str]) -> tuple | None:
        """(template, *confirmed) of the template that saves most on a block among those its wording confirms."""
        _, ranked = self.reductions(block)
        for less, name in ranked:
            if less <= 0:
                return None
            if row := self.confirmed(name, block):
                return (name, *row)
        return None

    def parts(self, text: str) -> Iterator[tuple[int, list[str], list[int]]]:
        """(number of the first word, words, where they begin) of each part of a text; parts overlap by a template."""
        every, first = placed(text), 0
        found: list[str] = []
        places: list[int] = []
        while True:
            more = list(islice(every, PART))
            found += [w for w, _ in more]
            places += [p for _, p in more]
            yield first, found, places
            if len(more) < PART:
                return
            gone = max(0, len(found) - 2 * self.longest)
            found, places, first = found[gone:], places[gone:], first + gone

    def of(self, text: str) -> list[tuple[int, str, float, float, list[str]]]:
        """(line, license, saved, covered, differences) for each license that a text quotes, each word for one only."""
        if not HINT.search(text):
            return []
        quoted = {}
        for first, found, places in self.parts(text):
            for low, high in self.blocks(found):
                block = tuple(found[low:high])
                if block not in self.known:
                    if len(self.known) > KNOWN_BLOCKS:
                        self.known.clear()
                    self.known[block] = self.winner(list(block))
                if row := self.known[block]:
                    name, less, covered, share, start, end, said = row
                    # The overlap of two parts gives a quotation twice, once perhaps cut: the fuller one stays.
                    order = (-less, -covered, -share, name, first + low + start, first + low + end)
                    quoted[order] = (places[low + start], said)
        result, starts, ends = [], [], []
        for order in sorted(quoted):
            _, covered, share, name, start, end = order
            near = bisect(starts, start)
            if (near == 0 or ends[near - 1] <= start) and (near == len(starts) or end <= starts[near]):
                starts.insert(near, start)
                ends.insert(near, end)
                place, said = quoted[order]
                result.append((place, name, -share, -covered, said))
        rows, line, at = [], 0, 0
        for place, *row in sorted(result):
            line, at = line + text.count("\n", at, place), place
            rows.append((line, *row))
        return rows


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line, license, saved, covered, differences) for each license quoted in each row's whole text.

    line is where the quotation begins, from 0; saved the share of its compressed size that the template saves;
    covered the share of the template's words found in order; differences the words that are missing (-) or added (+).
    Null and empty texts quote none. Repeated rows give repeated results, an empty table none. Templates that save
    equally much on a block rank by name; of overlapping quotations on which equally much is saved the better covered
    stays, then the first by name and place. Other columns of `docs` can have any name.
    """
    chosen = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in pieces(batches):
            rows = [(at, *row) for at, t in enumerate(batch.column("text").to_pylist()) for row in scanner.of(t)]
            columns = list(zip(*rows)) or [()] * 6
            types = (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.string()))
            ids = batch.column("doc_id").take(pa.array(columns[0], pa.int64()))
            arrays = [ids, *(pa.array(c, t) for c, t in zip(columns[1:], types))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "line", "license", "saved", "covered", "differences"])

    schema = "doc_id bigint, line int, license string, saved double, covered double, differences array<string>"
    return keyed_texts(docs, doc_id, text).mapInArrow(run, schema)
