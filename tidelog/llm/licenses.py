"""License scans by conditional compression: how much smaller is a passage for a compressor that knows the license?"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidelog.llm.texts import map_texts

LEVEL = 9
LEAST_REDUCTION = 0.3  # of a block's compressed size, or of a template's if smaller, for a template to be named at all
LEAST_SAVED = 0.05  # of a template's compressed size, by a window whose wording is compared; places save 0.18 at the least
SEED = 5  # words in a row, from which the places of a template are looked for
MOST_DIFFERENCES = 0.1  # of a template's words, for it to be confirmed
LINE_CHARS = 2000  # a longer line is cut around its cues
GAP_LINES = 2  # between lines with cues that are one block
AROUND_CHARS = 400  # looked at on both sides of a block when its wording is compared

# Words of license texts, and the texts themselves.
CUES = r"(?i)licen[cs]|copyright|permission|warrant|liab|redistribut|as is|free software|public domain|merchantab|dedicat|creative commons|\bCC[ -]BY\b"
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means.""",
    "MIT (notice)": "Released under the MIT License.",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0 (notice)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (notice)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 (notice)": "Licensed under CC BY-NC 4.0.",
}

# The notices of the GNU licenses share one wording.
GNU = """This {work} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation, {version}.
This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."""
LATER, ONLY = "either version {} of the License, or (at your option) any later version", "version {} of the License"
TEMPLATES |= {
    "GPL-2.0-only": GNU.format(work="program", stop=";", kind="", version=ONLY.format("2")),
    "GPL-2.0-or-later": GNU.format(work="program", stop=";", kind="", version=LATER.format("2")),
    "GPL-3.0-only": GNU.format(work="program", stop=":", kind="", version=ONLY.format("3")),
    "GPL-3.0-or-later": GNU.format(work="program", stop=":", kind="", version=LATER.format("3")),
    "LGPL-2.1-or-later": GNU.format(work="library", stop=";", kind="Lesser ", version=LATER.format("2.1")),
    "LGPL-3.0-or-later": GNU.format(work="program", stop=":", kind="Lesser ", version=LATER.format("3")),
    "AGPL-3.0-or-later": GNU.format(work="program", stop=":", kind="Affero ", version=LATER.format("3")),
}
# So do the BSD licenses, but for the third clause.
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. {third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES |= {
    "BSD-2-Clause": BSD.format(third=""),
    "BSD-3-Clause": BSD.format(
        third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
}
#: Words that name another license where a template does not have them.
TELLING = frozenset("lesser library affero neither noncommercial nc sa nd".split())
RELATED = 0.6  # of their words, from which two templates are told apart by those they do not share

FINDING = StructType(
    [
        StructField("start", LongType()),
        StructField("license", StringType()),
        StructField("reduction", DoubleType()),
        StructField("missing", IntegerType()),
        StructField("added", IntegerType()),
        StructField("confirmed", BooleanType()),
    ]
)


def cue_spans(text: str) -> list[list[int]]:
    """[start, end] of the passages with cues: lines, joined where at most GAP_LINES lie between; long lines are cut around cues."""
    spans: list[list[int]] = []
    for cue in re.finditer(CUES, text):
        start = text.rfind("\n", max(0, cue.start() - LINE_CHARS), cue.start()) + 1 or max(0, cue.start() - LINE_CHARS)
        end = text.find("\n", cue.end(), cue.end() + LINE_CHARS)
        end = min(len(text), cue.end() + LINE_CHARS) if end < 0 else end
        if spans and (start <= spans[-1][1] or text.count("\n", spans[-1][1], start) <= GAP_LINES + 1 and start - spans[-1][1] < LINE_CHARS):
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return spans


def candidate_blocks(text: str) -> list[tuple[int, str, str]]:
    """(start, text, text with what is around) of the passages with cues, in parts."""
    out = []
    for start, end in cue_spans(text):
        # a passage of many cues is looked at in parts, each of which overlaps the next one
        for begin in range(start, max(end - LINE_CHARS, start + 1), 2 * LINE_CHARS):
            stop = min(end, begin + 3 * LINE_CHARS)
            out.append((begin, text[begin:stop], text[max(0, begin - AROUND_CHARS) : stop + AROUND_CHARS]))
    return out


def surroundings(text: str) -> list[list[int]]:
    """[start, end] of the passages with cues and what is around them, joined where they touch."""
    out: list[list[int]] = []
    for start, end in cue_spans(text):
        start, end = max(0, start - AROUND_CHARS), min(len(text), end + AROUND_CHARS)
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return out


WORD = r"[a-z0-9]+(?:[.][0-9]+)*"


def wording(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def placed_wording(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text, and where in it each of them starts and ends."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower()[0] for c in text)
    found = list(re.finditer(WORD, lower))
    return [m.group() for m in found], [m.span() for m in found]


def matches(template: list[str], block: list[str]) -> list:
    """The runs of words that a template and a block have in common, in order."""
    parts = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
    # a word that only happens to stand far from all others does not count as matched
    return [m for m in parts if m.size > 1 or len(template) < 3] or parts


def counted(template: list[str], parts: list) -> tuple[int, int]:
    if not parts:
        return len(template), 0
    matched = sum(m.size for m in parts)
    return len(template) - matched, parts[-1].a + parts[-1].size - parts[0].a - matched


def differences(template: list[str], block: list[str]) -> tuple[int, int]:
    """How many words of the template the block lacks, and how many others it has between those that it has."""
    return counted(template, matches(template, block))


class Scanner:
    """The templates as dictionaries of a compressor. Words that a related template has not got are required of a place of one."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: wording(t) for name, t in templates.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.known, self.sizes = {}, {}
        # of each template all runs of SEED words (all its words, if none may differ), by their first word
        self.seeds: dict[str, dict[str, list[tuple[tuple[str, ...], list[int]]]]] = {}
        self.classes: dict[int, list[str]] = {}  # templates by the power of two of words that holds them
        for name, words in self.words.items():
            data = " ".join(words).encode()
            known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.known[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
            self.sizes[name] = len(self.plain.compress(data))
            self.classes.setdefault(1 << max(len(words) - 1, 1).bit_length(), []).append(name)
            runs: dict[tuple[str, ...], list[int]] = {}
            for i in range(len(words) - self.seed(name) + 1 if words else 0):
                runs.setdefault(tuple(words[i : i + self.seed(name)]), []).append(i)
            by_first = self.seeds.setdefault(name, {})
            for run, starts in runs.items():
                by_first.setdefault(run[0], []).append((run, starts))
        self.required, self.foreign = {}, {}
        for name, words in self.words.items():
            self.required[name], foreign = set(), set(TELLING)
            for other, theirs in self.words.items():
                same = SequenceMatcher(None, theirs, words, autojunk=False)
                if other == name or min(len(words), len(theirs)) < 4 * SEED or same.ratio() < RELATED:
                    continue
                shared = {k for m in same.get_matching_blocks() for k in range(m.b, m.b + m.size)}
                self.required[name] |= set(range(len(words))) - shared
                foreign |= set(theirs)
            self.foreign[name] = frozenset(foreign - set(words))

    def most(self, name: str) -> int:
        """How many words may differ."""
        return int(MOST_DIFFERENCES * len(self.words[name]))

    def seed(self, name: str) -> int:
        """Words in a row that any text has that is confirmed: d differences cut the words of a template in d + 1 runs at most."""
        n, d = len(self.words[name]), self.most(name)
        return min(SEED, -(-(n - d) // (d + 1)))

    def reductions(self, block: str) -> list[tuple[float, str]]:
        """By how much of its compressed size, or of the template's if that is smaller, each template makes the block smaller, largest first."""
        data = " ".join(wording(block)).encode()
        size = len(self.plain.compress(data))
        return sorted(((size - len(c.compress(data))) / min(size, self.sizes[name]), name) for name, c in self.known.items())[::-1]

    def ranked(self, said: list[str]) -> list[tuple[float, str, int, int]]:
        """(reduction, template, first word, behind the last word): windows of about a template's length that it makes
        smaller by at least LEAST_SAVED of its own compressed size, most first.

        Templates of about a length share windows; these overlap, so that a place of a template that is longer by what may
        differ lies whole in one of them.
        """
        found = []
        for step, names in self.classes.items():
            for first in range(0, max(len(said) - step, 0) + 1, step):
                window = said[first : first + 9 * step // 4]
                data = " ".join(window).encode()
                size = len(self.plain.compress(data))
                for name in names:
                    saved = (size - len(self.known[name].compress(data))) / self.sizes[name]
                    if saved >= LEAST_SAVED:
                        found.append((saved, name, first, first + len(window)))
        return sorted(found, key=lambda f: (-f[0], f[1], f[2]))

    def places(self, name: str, said: list[str]) -> list[tuple[list[int], int, int]]:
        """(words, missing, added) of all places of a template in a window that differ in few words and in none that tells it from others."""
        words, most, seed = self.words[name], self.most(name), self.seed(name)
        shifts = []
        for i, word in enumerate(said):
            for run, starts in self.seeds[name].get(word, ()):
                if tuple(said[i : i + seed]) == run:
                    shifts += [i - place for place in starts]
        shifts.sort()
        # the words that do not differ have so many seeds, all shifted by nearly the same number of words
        least = max(1, len(words) - most - (seed - 1) * (most + 1))
        out: list[tuple[list[int], int, int]] = []
        for shift in sorted(set(shifts)):
            if bisect_right(shifts, shift + most) - bisect_left(shifts, shift - most) < least:
                continue
            low = max(0, shift - most)
            parts = matches(words, said[low : shift + len(words) + most])
            missing, added = counted(words, parts)
            if missing + added > most:
                continue
            taken = [low + k for m in parts for k in range(m.a, m.a + m.size)]
            had = {k for m in parts for k in range(m.b, m.b + m.size)}
            others = {said[k] for k in range(taken[0], taken[-1] + 1)} - {said[k] for k in taken}
            if self.required[name] <= had and not others & self.foreign[name] and (not out or out[-1][0] != taken):
                out.append((taken, missing, added))
        return out

    def confirmed(self, text: str, start: int = 0, end: int | None = None) -> list[dict]:
        """All places between ``start`` and ``end`` whose wording is confirmed, in order: the windows that a template makes smaller are compared
        with its exact wording, most reduced first.

        What has the words of a longer template, or the same number with fewer differences, is no place of another one.
        """
        said, at = placed_wording(text[start:end])
        found: dict[tuple, tuple] = {}
        for reduction, name, first, last in self.ranked(said):
            for taken, missing, added in self.places(name, said[first:last]):
                taken = [first + k for k in taken]
                place = (-len(self.words[name]), missing + added, name, tuple(taken), missing, added)
                found.setdefault(place, reduction)
        used: set[int] = set()
        out = []
        for (_, _, name, taken, missing, added), reduction in sorted(found.items()):
            if used.isdisjoint(taken):
                used.update(taken)
                first, last = start + at[taken[0]][0], start + at[taken[-1]][1]
                out.append({"start": first, "end": last, "license": name, "reduction": reduction, "missing": missing, "added": added, "confirmed": True})
        return sorted(out, key=lambda f: (f["start"], f["license"]))

    def likely(self, block: str, around: str) -> dict | None:
        """The template, of those that reduce the block enough, whose wording differs least from it and what is around it."""
        words, found = wording(around), []
        for r, name in self.reductions(block):
            if r < LEAST_REDUCTION:
                break
            missing, added = differences(self.words[name], words)
            found.append(((missing + added) / max(1, len(self.words[name])), -r, name, missing, added))
        if not found:
            return None
        _, r, name, missing, added = min(found)
        return {"license": name, "reduction": -r, "missing": missing, "added": added, "confirmed": False}

    def best(self, block: str, around: str) -> dict | None:
        """Of a block and what is around it: the confirmed template with most words, or else the likely one."""
        confirmed = self.confirmed(around)
        return max(confirmed, key=lambda f: len(self.words[f["license"]])) if confirmed else self.likely(block, around)

    def findings(self, text: str) -> list[dict]:
        """All confirmed places of a text, and the likely template of each block that has none."""
        confirmed = [f for start, end in surroundings(text) for f in self.confirmed(text, start, end)]
        out = list(confirmed)
        for start, block, around in candidate_blocks(text):
            begin, end = start - min(start, AROUND_CHARS), start - min(start, AROUND_CHARS) + len(around)
            if not any(f["start"] < end and f["end"] > begin for f in confirmed) and (likely := self.likely(block, around)):
                out.append({"start": start} | likely)
        return [{k: v for k, v in f.items() if k != "end"} for f in sorted(out, key=lambda f: (f["start"], f["license"]))]


def scan(docs: DataFrame, text: str, keep: list[str], templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Columns ``row`` (of ``keep``), start, license, reduction, missing, added, confirmed: a row per license, and per passage like one.

    Passages with cue words are cut into windows of about a template's length, which are compressed with each template as
    a raw dictionary; those that save enough of a template's own size are ranked, and their exact wording is compared: a
    place is confirmed that differs in few words and in none by which related templates are told apart, with the numbers of words of the template
    that are missing and of others between them. Only where words belong to several templates the longest one has them. Of a passage
    without a confirmed place the template that saves enough and differs least is named, not confirmed. ``start`` is where the words of a confirmed
    template start, or the passage. Null and empty texts and those without cues give no row; equal rows give equal ones.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("license", pa.string()), ("reduction", pa.float64()), ("missing", pa.int32()), ("added", pa.int32()), ("confirmed", pa.bool_())]))

    worker: list[Scanner] = []  # one for each worker, kept over batches

    def compute(texts: pa.Array) -> list[pa.Array]:
        if not worker:
            worker.append(Scanner(templates))
        scanner = worker[0]
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        some = pc.fill_null(pc.match_substring_regex(texts, CUES), False)
        for i in pc.indices_nonzero(some).to_pylist():
            out[i] = scanner.findings(texts[i].as_py())
        return [pa.array(out, kind)]

    made = map_texts(docs, text, keep, [StructField("findings", ArrayType(FINDING))], compute)
    return made.select("row", F.inline("findings"))
