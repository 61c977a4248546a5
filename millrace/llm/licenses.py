"""License scans by conditional compression.

Cue words are chosen from the templates: of each so many that a place with all of them missing could not be confirmed. A text's
candidate blocks are the words around cue words, as far as a place of the longest template reaches in both directions; blocks that touch
are one, and a long block is cut into parts that overlap by more than such a place. A block is compressed on its own and once with each template as a raw
zstandard dictionary. The bytes that a template saves rank the templates. From the first on, a template is confirmed if its words stand in
the block nearly whole and in order: all but ``MISSING`` of them, with few others between. Every common run that is long enough
for that is tried, the longest first, so a fragment of a template does not hide a whole one beside it. What is missing and added is
reported word by word, and the place is taken before the next template is looked at.

Texts without cue words are left out by a built-in filter before any Python runs.

Defined results: one row per finding; a text without findings, NULL or empty has none. Repeated rows each give theirs. Of two
templates on the same words the one that saves more counts, then the smaller name. Starts and ends are in code points. Extra columns
are ignored. The templates are parameters; those below are the texts and usual notices of common licenses.
"""

from __future__ import annotations

import difflib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, per_worker, table

TELLING = r"licen[cs]e|copyright|permission|redistribut|warrant|spdx|^cc"  # words that are chosen as cues first
WORD = r"[^\W_]+(?:[.+-][^\W_]+)*"
MISSING, LIKENESS = 0.1, 0.85
PART, OVERLAP = 1_200, 400  # words, at least
LEAST_SAVED = 4

#: The texts of the licenses and their usual notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = _BSD_2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (_APACHE, "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "BSD-2-Clause": (_BSD_2, "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (_BSD_3, "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"),
    "GPL-3.0": (_GPL, "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "ISC": (_ISC, "SPDX-License-Identifier: ISC"),
    "MIT": (_MIT, "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
}


def cue_pattern(templates: dict[str, tuple[str, ...]]) -> str:
    """A pattern that every text with a confirmed place of a template has: the beginnings of words of which each place has one."""
    cues: set[str] = set()
    for variant in (v for variants in templates.values() for v in variants):
        words = re.findall(WORD, " ".join(variant.split()).lower())
        order = sorted(set(words), key=lambda w: (not re.search(TELLING, w), -len(w), w))
        cues.update(order[: math.floor(MISSING * len(words) + 1e-9) + 1])
    return r"(?i)(?<![A-Za-z0-9])(?:" + "|".join(sorted(map(re.escape, cues))) + ")" if cues else r"(?!)"


class Scanner:
    """Compressors for the templates, and the search in one text."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=6, write_content_size=False)
        self.cue, self.word = re.compile(cue_pattern(templates)), re.compile(WORD)
        self.templates = []
        for name, variants in sorted(templates.items()):
            for variant in variants:
                text = " ".join(variant.split())
                raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=6, dict_data=raw, write_content_size=False, write_dict_id=False)
                self.templates.append((name, self.word.findall(text.lower()), packer))
        longest = max((len(words) for _, words, _ in self.templates), default=0)
        self.reach = math.floor(longest * (2 / LIKENESS - 1)) + 1  # the words of a place, at most
        self.overlap = max(OVERLAP, self.reach + longest // 5 + 2)
        self.part = max(PART, 3 * self.overlap)

    def blocks(self, text: str):
        """Words of each block as (word, start, end)."""
        words = [(m[0].lower(), m.start(), m.end()) for m in self.word.finditer(text)]
        if not words:
            return
        starts = [w[1] for w in words]
        spans: list[list[int]] = []
        at = 0
        for cue in self.cue.finditer(text):
            while at + 1 < len(starts) and starts[at + 1] <= cue.start():
                at += 1
            low, high = max(0, at - self.reach), min(len(words), at + self.reach)
            if spans and low <= spans[-1][1]:
                spans[-1][1] = high
            else:
                spans.append([low, high])
        for low, high in spans:
            while True:
                yield words[low : min(high, low + self.part)]
                if low + self.part >= high:
                    break
                low += self.part - self.overlap

    def scan(self, text: str) -> list[tuple]:
        """(license, start, end, plain bytes, bytes saved, missing, added) of each finding, by place."""
        found: dict[tuple, tuple] = {}
        for block in self.blocks(text):
            raw = " ".join(w for w, _, _ in block).encode("utf-8", "replace")
            plain = len(self.plain.compress(raw))
            saved = sorted(((plain - len(packer.compress(raw)), name, words) for name, words, packer in self.templates), key=lambda s: (-s[0], s[1], -len(s[2])))
            open_words: list[str | None] = [w for w, _, _ in block]
            for gain, name, words in saved:
                if gain < LEAST_SAVED:
                    break
                while (place := self.confirm(words, open_words)) is not None:
                    first, last, missing, added = place
                    row = (name, block[first][1], block[last - 1][2], plain, gain, missing, added)
                    found.setdefault(row[:3], row)
                    open_words[first:last] = [None] * (last - first)
        # a part's edge may show a template that the next part has whole
        rows, reached = [], -1
        for row in sorted(found.values(), key=lambda r: (r[1], -r[2], r[0])):
            if row[2] > reached:
                rows.append(row)
                reached = row[2]
        return rows

    def confirm(self, words: list[str], block: list[str | None]) -> tuple[int, int, str, str] | None:
        """Where a template's words stand in order: first and last word, what is missing and what is added.

        All common runs are anchors, the longest first; where a place fails, the next is looked at.
        """
        masks: dict[str, int] = {}
        for at, word in enumerate(block):
            if word is not None:
                masks[word] = masks.get(word, 0) | 1 << at
        needed = (1 - MISSING) * len(words)
        if sum(w in masks for w in words) < needed:
            return None
        slack = len(words) // 5 + 2
        looked = set()
        for size, a, b in anchors(words, block):
            low, high = max(0, b - a - slack), min(len(block), b - a + len(words) + slack)
            # words that are taken already end the place
            low = next((i + 1 for i in range(b - 1, low - 1, -1) if block[i] is None), low)
            high = next((i for i in range(b + size, high) if block[i] is None), high)
            if (low, high) in looked:
                continue
            looked.add((low, high))
            if common(words, masks, low, high) < needed:
                continue
            part = block[low:high]
            pairs = [(r.a + i, r.b + i) for r in difflib.SequenceMatcher(None, words, part, autojunk=False).get_matching_blocks() for i in range(r.size)]
            # longest runs first may take words of a fragment beside the place
            for aligned in (lambda: pairs, lambda: fitted(words, part)):
                place = self.judged(words, block, [(i, low + j) for i, j in aligned()])
                if place is not None:
                    return place
        return None

    def judged(self, words: list[str], block: list[str | None], pairs: list[tuple[int, int]]) -> tuple[int, int, str, str] | None:
        if not pairs or len(pairs) < (1 - MISSING) * len(words):
            return None
        first, last = pairs[0][1], pairs[-1][1] + 1
        if 2 * len(pairs) < LIKENESS * (len(words) + last - first):
            return None
        there, here = {i for i, _ in pairs}, {j for _, j in pairs}
        missing = " ".join(w for i, w in enumerate(words) if i not in there)
        added = " ".join(block[i] for i in range(first, last) if i not in here)
        return first, last, missing, added


def least_run(size: int) -> int:
    """The length that the longest run of a confirmed template of ``size`` words has at least."""
    least = size
    for matched in range(math.ceil((1 - MISSING) * size - 1e-9), size + 1):
        breaks = size - matched + max(0, math.floor(2 * matched / LIKENESS - size + 1e-9) - matched)
        least = min(least, -(-matched // (breaks + 1)))
    return max(1, least)


def anchors(words: list[str], block: list[str | None]) -> list[tuple[int, int, int]]:
    """(size, place in the words, place in the block) of the longest common runs along each shift, longest first."""
    places: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(word, []).append(i)
    runs, open_runs = [], {}
    for j, word in enumerate(block):
        going = {i: open_runs.get(i - 1, 0) + 1 for i in places.get(word, ())}
        runs += [(size, i - size + 1, j - size) for i, size in open_runs.items() if i + 1 not in going]
        open_runs = going
    runs += [(size, i - size + 1, len(block) - size) for i, size in open_runs.items()]
    least = least_run(len(words))
    return sorted((r for r in runs if r[0] >= least), key=lambda r: (-r[0], r[1], r[2]))


def common(words: list[str], masks: dict[str, int], low: int, high: int) -> int:
    """Length of the longest common subsequence with a part of the block, given the places of the block's words as bits."""
    whole = (1 << (high - low)) - 1
    rest = whole
    for word in words:
        hit = rest & (masks.get(word, 0) >> low)
        rest = ((rest + hit) | (rest - hit)) & whole
    return high - low - rest.bit_count()


def fitted(words: list[str], part: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal words in order with the fewest words missing and added, whatever stands around."""
    rows = [[0] * (len(part) + 1)]
    for word in words:
        above, row = rows[-1], [rows[-1][0] + 1]
        for j, other in enumerate(part):
            cost = min(above[j + 1], row[j]) + 1
            row.append(above[j] if word == other and above[j] <= cost else cost)
        rows.append(row)
    i, j = len(words), min(range(len(part) + 1), key=rows[-1].__getitem__)
    pairs = []
    while i and j:
        if words[i - 1] == part[j - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def find(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per finding: doc_id, license, start, end, plain_bytes, saved_bytes, missing, added, exact."""
    chosen = TEMPLATES if templates is None else templates
    names = ("doc_id", "license", "start", "end", "plain_bytes", "saved_bytes", "missing", "added", "exact")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())

    def scan(batches):
        scanner = per_worker(("licenses", tuple(sorted(chosen.items()))), lambda: Scanner(chosen))
        for batch in batches:
            rows = [
                (number, *row, not row[5] and not row[6])
                for number, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for row in scanner.scan(value)
            ]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(F.col("text").rlike(cue_pattern(chosen)))
    schema = "doc_id long, license string, start long, end long, plain_bytes long, saved_bytes long, missing string, added string, exact boolean"
    return map_batches(rows, scan, schema)


def op6_licenses(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"))
