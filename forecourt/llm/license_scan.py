"""Licence notices in documents, by the Dice coefficient over word bigrams.

A document is looked at in units: the whole text, runs of lines that resemble licences, the paragraphs of a run and
the stretches of its lines that belong to one template, lines, and sentences of lines.
A unit's normalised words (lower case, without punctuation) give its set of bigrams, compared to each template's:
2 * common / (unit + template). To reach the threshold t, a unit with n bigrams needs a template that has between
n * t / (2 - t) and n * (2 - t) / t of them; other templates are not compared, and units with too few bigrams of any
template are not compared at all. The best template wins (ties: smaller name); of overlapping units the better one,
then the longer one, stays, and what it leaves of a run is looked at again.

Documents are scanned where they lie, without a shuffle; the templates are a fixed argument of bounded size.

Defined results: null and empty texts have no notice; a unit of one word has no bigram and matches nothing; repeated rows are
each scanned; other columns pass through, an existing column of the result's name is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import cache
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import documents, drop_names

THRESHOLD = 0.85

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
        " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
        " License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software."
    ),
    "all-rights-reserved": "All rights reserved.",
}

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
_BSD_3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
    " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF"
    " THIS SOFTWARE."
)


def _gnu(name: str, version: str) -> str:
    text = TEMPLATES["GPL-3.0-header"].replace("GNU General Public License", f"GNU {name}")
    text = text.replace("version 3", f"version {version}")
    return text if version == "3" else text.replace("free software: you", "free software; you").replace(", either", "; either")


_GNU = {
    "AGPL-3.0": ("Affero General Public License", "3"),
    "GPL-2.0": ("General Public License", "2"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
}
_MENTIONED = {
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "Apache-2.0": "Apache License 2.0",
    "Artistic-2.0": "Artistic License 2.0",
    "BSD": "BSD License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License 1.0",
    "CC0-1.0": "CC0 1.0 Universal License",
    "EPL-1.0": "Eclipse Public License 1.0",
    "EPL-2.0": "Eclipse Public License 2.0",
    "GFDL-1.3": "GNU Free Documentation License 1.3",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "ISC": "ISC License",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "MPL-1.1": "Mozilla Public License 1.1",
    "MPL-2.0": "Mozilla Public License 2.0",
    "Unlicense": "Unlicense",
    "Zlib": "zlib License",
}
for _name, _words in _MENTIONED.items():
    TEMPLATES[f"{_name}-licensed"] = f"Licensed under the {_words}."
    TEMPLATES[f"{_name}-released"] = f"Released under the {_words}."
    TEMPLATES[f"{_name}-work"] = f"This work is licensed under the {_words}."
del TEMPLATES["GPL-2.0-work"], TEMPLATES["GPL-3.0-work"]  # they are there as GPL-2.0 and GPL-3.0
TEMPLATES |= {f"{name}-header": _gnu(*of) for name, of in _GNU.items()}
TEMPLATES |= {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted." + _ISC_AS_IS
    ),
    "BSD-2-Clause": _BSD + _BSD_AS_IS,
    "BSD-2-Clause-conditions": _BSD,
    "BSD-3-Clause": _BSD + _BSD_3 + _BSD_AS_IS,
    "BSD-3-Clause-conditions": _BSD + _BSD_3,
    "BSL-1.0-header": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"
        " http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0-short": "Licensed under CC0 1.0.",
    "CC0-1.0-statement": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "ISC-text": TEMPLATES["ISC"] + _ISC_AS_IS,
    "MIT-as-is": _MIT_AS_IS.strip(),
    "MIT-text": TEMPLATES["MIT-permission"] + _MIT_AS_IS,
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors"
        " of this software dedicate any and all copyright interest in the software to the public domain. We make this"
        " dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this"
        " dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under"
        " copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"
        " THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
        " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"
        " for any damages arising from the use of this software. Permission is granted to anyone to use this software for any"
        " purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the"
        " original software. If you use this software in a product, an acknowledgment in the product documentation would be"
        " appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be"
        " misrepresented as being the original software. 3. This notice may not be removed or altered from any source"
        " distribution."
    ),
}


@cache
def full_texts() -> dict[str, str]:
    """The whole texts of licences, by file name."""
    found = sorted((file.name, file) for file in files("forecourt.llm").joinpath("licenses").iterdir())
    return {f"{name.removesuffix('.txt')}-text": file.read_text(encoding="utf-8").strip() for name, file in found if name.endswith(".txt")}


BRIDGE = 2  # lines without anything of a licence that a notice may have within, such as a page's footer
WIDER = 1.1  # so many times the bigrams of a part make a notice the whole of it
_WORD = re.compile(r"\w+")
NOTICES = "array<struct<license_id: string, dice: double, start: bigint, end: bigint>>"
_ARROW_NOTICES = pa.list_(
    pa.struct([("license_id", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
)


def bigrams(text: str) -> set[tuple[str, str]]:
    words = _WORD.findall(text.lower())
    return set(zip(words, words[1:], strict=False))


def sentences(line: str) -> Iterator[tuple[int, int]]:
    """Spans that end with a stop before white space."""
    start = 0
    for found in re.finditer(r"[.!?;]+(?=\s)", line):
        yield start, found.end()
        start = found.end()
    if start < len(line):
        yield start, len(line)


def gapless(weights: list[float]) -> Iterator[tuple[int, int]]:
    """Longest stretches of positive weights."""
    start = None
    for i, w in enumerate([*weights, 0.0]):
        if w > 0 and start is None:
            start = i
        elif w <= 0 and start is not None:
            yield start, i
            start = None


def joined(weights: list[float], drop: float) -> Iterator[tuple[int, int]]:
    """Stretches of the greatest sums, with no fall by more than ``drop`` within."""
    start, end, total, best = None, 0, 0.0, 0.0
    for i, w in enumerate(weights):
        if start is not None and (total + w <= 0 or best - total - w > drop):
            yield start, end
            start = None
        if start is None:
            if w <= 0:
                continue
            start, total, best = i, 0.0, 0.0
        total += w
        if total >= best:
            best, end = total, i + 1
    if start is not None:
        yield start, end


def uncovered(run: list[tuple[int, int, set, int, bool]], kept: list[tuple[str, float, int, int]]) -> Iterator[list]:
    """The stretches of a run's lines that no notice touches, if one touches the run; ``kept`` is in order."""
    starts = [a for _, _, a, _ in kept]
    part: list = []
    parts = [part]
    for line in run:
        i = bisect_left(starts, line[1])
        if i and kept[i - 1][3] > line[0]:
            part = []
            parts.append(part)
        else:
            part.append(line)
    if len(parts) > 1:
        yield from filter(None, parts)


class Matcher:
    def __init__(self, templates: Mapping[str, str], threshold: float):
        self.sets = {name: grams for name, text in sorted(templates.items()) if (grams := bigrams(text))}
        self.having: dict[tuple[str, str], list[str]] = {}
        for name, grams in self.sets.items():
            for gram in grams:
                self.having.setdefault(gram, []).append(name)
        self.threshold = threshold
        self.largest = max(map(len, self.sets.values()), default=0)

    def best(self, grams: set[tuple[str, str]]) -> tuple[str, float] | None:
        """The template most like a unit, if it reaches the threshold."""
        t, n = self.threshold, len(grams)
        known = [g for g in grams if g in self.having]
        if not known or len(known) * (2 - t) < n * t:
            return None
        common = Counter(
            name for g in known for name in self.having[g] if n * t <= len(self.sets[name]) * (2 - t) and len(self.sets[name]) * t <= n * (2 - t)
        )
        scored = [(-2 * c / (n + len(self.sets[name])), name) for name, c in common.items()]
        if scored and -min(scored)[0] >= t:
            return min(scored)[1], -min(scored)[0]
        return None

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, Dice coefficient, start, end) of the notices in a text, by start."""
        units: list[tuple[int, int, set]] = []
        runs: list[list[tuple[int, int, set, int, bool]]] = []
        # Start, end, bigrams and paragraph of lines that resemble licences, and whether a line is foreign to them.
        run: list[tuple[int, int, set, int, bool]] = []
        foreign: list[tuple[int, int, set, int, bool]] = []  # such lines after the run, part of it if it goes on
        whole: set | None = set()
        at, paragraph, before, n_known = 0, 0, "", 0
        for line in text.split("\n"):
            words = _WORD.findall(line.lower())
            grams = set(zip(words, words[1:], strict=False))
            known = sum(map(self.having.__contains__, grams))
            n_known += known + 1  # and one across the line feed
            end = at + len(line)
            if whole is not None:
                whole |= grams
                if len(whole) * self.threshold > self.largest * (2 - self.threshold):
                    whole = None  # larger than any template allows
            if known:
                if 2 * known >= len(grams):
                    units.append((at, end, grams))
                units += [(at + a, at + b, bigrams(line[a:b])) for a, b in sentences(line)]
            if not words:
                paragraph += 1
            elif 2 * known >= len(grams):  # a single word goes with the lines around it
                run += [*foreign, (at, end, grams | {(before, words[0])} if run else grams, paragraph, False)]
                foreign, before = [], words[-1]
            elif run and len(foreign) < BRIDGE:
                foreign.append((at, end, grams | {(before, words[0])}, paragraph, True))
                before = words[-1]
            elif run:
                runs.append(run)
                run, foreign = [], []
            at = end + 1
        runs.append(run)
        if whole and n_known * (2 - self.threshold) >= len(whole) * self.threshold:
            units.append((0, len(text), bigrams(text)))
        kept: list[tuple[str, float, int, int]] = []
        while units or runs:
            units += [unit for own in runs for unit in self.of_run(text, own)]
            kept, n = self.chosen(text, units, kept), len(kept)
            # What the notices found leave of a run is looked at by itself.
            units, runs = [], [part for own in runs for part in uncovered(own, kept)] if len(kept) > n else []
        return kept

    def of_run(self, text: str, run: list[tuple[int, int, set, int, bool]]) -> list[tuple[int, int, set]]:
        """The run, its paragraphs, and the stretches of its lines that belong to one template; of two lines at least."""
        if len(run) < 2:
            return []
        starts = [i for i in range(len(run)) if i == 0 or run[i][3] != run[i - 1][3]]
        own = gapless([-1.0 if line[4] else 1.0 for line in run])
        stretches = {(0, len(run)), *zip(starts, [*starts[1:], len(run)], strict=True), *own}
        for name, common in self.shared(run).items():
            # A unit with n bigrams, c of them the template's, matches if 2 * c - t * n is at least t * template.
            weights = [2 * common.get(i, 0) - self.threshold * len(line[2]) for i, line in enumerate(run)]
            size = len(self.sets[name])
            for a, b in {*gapless(weights), *joined(weights, 2 * (1 - self.threshold) * size)}:
                if sum(common.get(i, 0) for i in range(a, b)) * (2 - self.threshold) >= size * self.threshold:
                    stretches.add((a, b))
        return [(run[a][0], run[b - 1][1], bigrams(text[run[a][0] : run[b - 1][1]])) for a, b in sorted(stretches) if b - a > 1]

    def shared(self, run: list[tuple[int, int, set, int, bool]]) -> dict[str, dict[int, int]]:
        """For each template, how many bigrams the lines have in common with it; only those with enough in all."""
        out: dict[str, dict[int, int]] = {}
        for i, line in enumerate(run):
            for name, n in Counter(name for g in line[2] for name in self.having.get(g, ())).items():
                out.setdefault(name, {})[i] = n
        t = self.threshold
        return {name: own for name, own in out.items() if sum(own.values()) * (2 - t) >= len(self.sets[name]) * t}

    def chosen(self, text: str, units: list[tuple[int, int, set]], kept: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
        """``kept`` and the notices among the units beside them, by start.

        A notice within a larger one, which has clearly more of its template, is a part of that; otherwise the best comes first.
        """
        found: list[tuple[float, int, int, int, str]] = []
        common: list[float] = []
        for a, b, grams in units:
            if match := self.best(grams):
                a += len(text[a:b]) - len(text[a:b].lstrip())
                found.append((-match[1], a - b, a, a + len(text[a:b].rstrip()), match[0]))
                common.append(match[1] * (len(grams) + len(self.sets[match[0]])))
        kept, wider = [*kept], sorted(zip(common, found, strict=True), key=lambda hit: -hit[0])
        parts = set()
        for i, (n, (_, _, a, b, _)) in enumerate(wider):
            if any(m >= WIDER * n and x <= a and b <= y for m, (_, _, x, y, _) in wider[:i]):
                parts.add((a, b))
        for dice, _, a, b, name in sorted(hit for hit in found if hit[2:4] not in parts):
            if all(b <= x or y <= a for _, _, x, y in kept):
                kept.append((name, round(-dice, 6), a, b))
        return sorted(kept, key=lambda hit: hit[2])


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    out_col: str = "notices",
    templates: Mapping[str, str] | None = None,
    threshold: float = THRESHOLD,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the licence notices of each text: template, Dice coefficient, start, end (code points).

    Templates are by default notices and the whole texts of licences.
    """
    docs = drop_names(docs, out_col)
    at, templates = docs.columns.index(text_col), dict(TEMPLATES | full_texts() if templates is None else templates)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), *T._parse_datatype_string(f"`{out_col}` {NOTICES}").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch in batches:
            notices = [
                [dict(zip(("license_id", "dice", "start", "end"), hit, strict=True)) for hit in matcher.scan(text)] if text else []
                for text in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(notices, _ARROW_NOTICES)], schema.names
            )

    return docs.mapInArrow(scan, schema)


def q_license_scan(spark, sf_dir):
    """Every licence notice in every document."""
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", F.explode("notices").alias("notice")).select("doc_id", "notice.*")
