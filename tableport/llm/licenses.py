"""License notices in documents, by conditional compression.

A word that notices use is looked up in the license templates. Where a template has it too, the words around it that
the template would cover form a candidate block, which is compressed alone and with the template as zstandard raw
dictionary; the better the template foretells the block, the more its size falls. What is left is confirmed by the
exact differences in wording. Blocks are of the template's own length, so the text around a notice cannot hide it.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from .common import quoted, sub_batches, with_fields, without

# Words that candidate blocks lie around, and the wording of well-known public notices.
CUES = ("licens", "licenc", "copyright", "permission", "redistribut", "rights reserved", "warrant", "public domain",
        "creative commons", "spdx")

TEMPLATES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
     "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
     "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software without specific prior written "
     "permission."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)

_RUN = re.compile(r"[\w.\-/:]+")


def words_of(text: str) -> list[str]:
    return [w for w in (run.rstrip(".-/:") for run in _RUN.findall(text.lower())) if w]


def cue_places(words: list[str]) -> dict[str, list[int]]:
    """{cue: numbers of the words in which it begins}."""
    joined, starts = " ".join(words), list(accumulate((len(w) + 1 for w in words), initial=0))
    found = {}
    for cue in CUES:
        at = joined.find(cue)
        while at >= 0:
            found.setdefault(cue, {})[bisect_right(starts, at) - 1] = None
            at = joined.find(cue, at + 1)
    return {cue: list(places) for cue, places in found.items()}


def compared(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """(differences, first word, word after the last) of ``template`` in ``block``.

    Differences are words of ``template`` that ``block`` lacks, and words of ``block`` in between that ``template``
    lacks. What stands before or after the notice in its block does not count.
    """
    steps = difflib.SequenceMatcher(None, template, block, autojunk=False).get_opcodes()
    count, equal = 0, []
    for n, (kind, a, b, c, d) in enumerate(steps):
        if kind != "equal":
            outside = n in (0, len(steps) - 1)
            count += b - a if outside else max(b - a, d - c)
        else:
            equal += c, d
    return count, min(equal, default=0), max(equal, default=0)


def differences(template: list[str], block: list[str]) -> int:
    return compared(template, block)[0]


class Scanner:
    """Compressors for the templates, and the verdicts on blocks already seen. ``gap`` has no effect."""

    def __init__(self, templates, min_reduction: float, max_differences: float, gap: int):
        import zstandard

        self.alone = zstandard.ZstdCompressor(level=3)
        self.templates = [(name, words_of(text), zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))) for name, text in templates]
        self.bags = [Counter(wording) for _, wording, _ in self.templates]
        self.places = {}                                 # cue: (template, number of its word with the cue)
        for n, (_, wording, _) in enumerate(self.templates):
            for cue, places in cue_places(wording).items():
                self.places.setdefault(cue, []).extend((n, place) for place in places)
        self.min_reduction, self.max_differences, self.seen = min_reduction, max_differences, {}

    def judge(self, n: int, block: list[str]):
        """(reduction, differences, first word, word after the last) if the block holds template ``n``, or None."""
        key = n, " ".join(block)
        if key not in self.seen:
            if len(self.seen) >= 20_000:                 # the verdict of a block does not depend on the others
                self.seen.clear()
            self.seen[key] = self._judge(n, block, key[1].encode())
        return self.seen[key]

    def _judge(self, n: int, block: list[str], data: bytes):
        _, wording, compressor = self.templates[n]
        most = int(self.max_differences * len(wording))
        if (self.bags[n] - Counter(block)).total() > most:
            return None                                  # more words are missing in any order
        size = len(self.alone.compress(data))
        reduction = (size - len(compressor.compress(data))) / size
        if reduction < self.min_reduction:
            return None
        off, first, end = compared(wording, block)
        return (round(reduction, 6), off, first, end) if off <= most else None

    def candidates(self, words: list[str]):
        """(words in common less differences, reduction, -template, first word, word after the last, differences)."""
        met = set()
        for cue, places in cue_places(words).items():
            for place in places:
                for n, own in self.places.get(cue, ()):
                    if (n, place - own) in met:
                        continue
                    met.add((n, place - own))
                    size = len(self.templates[n][1])
                    # words that are missing or mixed in move the ends of the notice by as many
                    most = int(self.max_differences * size)
                    begin = max(0, place - own - most)
                    found = self.judge(n, words[begin:max(0, place - own + size + most)])
                    if found:
                        reduction, off, first, end = found
                        yield size - 2 * off, reduction, -n, begin + first, begin + end, off

    def scan(self, text: str | None):
        """(license, first line, last line, reduction, differences) of each notice, lines counted from 0."""
        low = (text or "").lower()
        if not any(cue.split()[0] in low for cue in CUES):
            return
        words, line_of = [], []
        for i, line in enumerate(text.split("\n")):
            own = words_of(line)
            words += own
            line_of += [i] * len(own)
        taken, notices = bytearray(len(words)), []
        for _, reduction, n, first, end, off in sorted(self.candidates(words), reverse=True):
            if not any(taken[first:end]):
                taken[first:end] = b"\1" * (end - first)
                notices.append((first, end, n, reduction, off))
        for first, end, n, reduction, off in sorted(notices):
            yield self.templates[-n][0], line_of[first], line_of[end - 1], reduction, off

def scan_licenses(docs: DataFrame, templates=TEMPLATES, min_reduction: float = 0.15, max_differences: float = 0.1,
                  gap: int = 6, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, one row per notice: ``license``, ``first_line``, ``last_line``, ``reduction``,
    ``differences``.

    ``templates`` are (name, wording) pairs, several per license if need be. A template is considered where it shares
    a cue word with the text and if it lowers the compressed size of the words it would cover there by
    ``min_reduction``, and confirmed if at most ``max_differences`` of its words are missing, replaced or mixed with
    others. Line breaks and the text before and after do not matter. Each notice gives a row; where confirmed templates overlap,
    the one with the most words in common less differences is the notice. ``gap`` has no effect and is kept for callers.
    Null, empty and unlicensed texts give no row; repeated rows repeat their notices; columns named like a new one are
    replaced. Nothing is shuffled, so a notice on a third of all documents makes no hot task.
    """
    new = (("license", "string"), ("first_line", "int"), ("last_line", "int"), ("reduction", "double"), ("differences", "int"))
    docs = without(docs, *[n for n, _ in new])
    kept = without(docs, text)
    schema, own_columns = with_fields(kept.schema, *new), kept.columns

    def scan(batches):
        import pyarrow as pa

        scanner, kinds = Scanner(templates, min_reduction, max_differences, gap), (
            pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
        for whole in batches:
            for batch in sub_batches(whole, text, 16_000_000):
                rows, found = [], []
                for i, value in enumerate(batch.column(text).to_pylist()):
                    for notice in scanner.scan(value):
                        rows.append(i)
                        found.append(notice)
                if rows:
                    own = batch.take(pa.array(rows))
                    columns = [own.column(batch.schema.get_field_index(c)) for c in own_columns]
                    added = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([*columns, *added], names=[f.name for f in schema])

    return docs.select(*[F.col(quoted(c)) for c in docs.columns]).mapInArrow(scan, schema)
