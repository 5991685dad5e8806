"""License scans: blocks compressed with each template as dictionary, winners confirmed by their wording."""

import difflib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

# Variants of one license family with their long names.
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

# Usual wordings of license notices, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Released under the terms of the MIT license."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as "
        "being the original software. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    *((f"CC-{v}-4.0", f"Licensed under CC {v} 4.0.") for v in _CC),
    *((f"CC-{v}-4.0", f"This work is licensed under a Creative Commons {long} 4.0 International License.") for v, long in _CC.items()),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "CC0-1.0", "BSL-1.0", "Zlib", "EPL-2.0")),
)

_CUE = re.compile(r"(?i)licen[cs]|copyright|permission|redistribut|spdx|public domain|free software|source code form|conditions|warrant(?:y|ies)|held liable|misrepresent")
# Parts of a text that a block is made of: sentences and lines.
_PART = re.compile(r"[^\n]+?(?:[.;:!?][\"')]*(?=[\x20\t]|\n|\Z)|(?=\n|\Z))")
_WORD = re.compile(r"[^\W_]+(?:[.][0-9]+)*")
_NUMBER = re.compile(r"[0-9]")

# Parts without a cue that may lie between two parts of one block, or behind the last.
_BRIDGE = 2
# Characters of the longest block; pieces of a longer one overlap by twice the longest template, and at least by this many.
_LONGEST_BLOCK, _OVERLAP = 8000, 2000
# Words of a template in which a text may have numbers of its own.
_LONG = 40
# Words that tell one license from another; a template and its place in a text have the same ones.
_NAMING = frozenset(
    "apache mit bsd gnu gpl lgpl agpl lesser library affero mozilla mpl isc cc cc0 by sa nc nd creative commons attribution sharealike noncommercial noderivatives zero universal boost zlib "
    "eclipse epl artistic unlicense bsl clause".split()
)


def blocks(text: str, overlap: int = _OVERLAP) -> Iterator[tuple[int, int]]:
    """Places of runs of parts with a cue, with up to two other parts between and after them.

    A very long run is given out as pieces that share ``overlap`` characters, more than any template is long.
    """
    if not _CUE.search(text):
        return
    start = end = last = -1
    for k, m in enumerate(_PART.finditer(text)):
        if _CUE.search(m[0]):
            start, end, last = m.start() if start < 0 else start, m.end(), k
        elif start >= 0 and k - last <= _BRIDGE:
            end = m.end()
        elif start >= 0:
            yield from _pieces(start, end, overlap)
            start = -1
    if start >= 0:
        yield from _pieces(start, end, overlap)


def _pieces(start: int, end: int, overlap: int) -> Iterator[tuple[int, int]]:
    longest = max(_LONGEST_BLOCK, 2 * overlap)
    while end - start > longest:
        yield start, start + longest
        start += longest - overlap
    yield start, end


def _telling(words: list[str]) -> tuple[list[str], list[str]]:
    """Naming words and numbers of a wording."""
    return sorted(_NAMING.intersection(words)), sorted(w for w in words if _NUMBER.search(w))


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.templates = templates
        self.words = [[w[0].lower() for w in _WORD.finditer(text)] for _, text in templates]
        self.counts = [Counter(words) for words in self.words]
        self.overlap = max([_OVERLAP, *(2 * len(text) for _, text in templates)])
        self.alone = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(level=9, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for _, text in templates
        ]

    def reductions(self, block: str, templates: Iterable[int]) -> dict[int, float]:
        """Share of the block's compressed size that each template saves as a dictionary."""
        data = block.encode()
        alone = len(self.alone.compress(data))
        return {k: 1 - len(self.given[k].compress(data)) / alone for k in templates}

    def possible(self, found: list[re.Match]) -> list[int]:
        """Templates of which four fifths of the words are in the block in any order: ``compare`` refuses all others."""
        have = Counter(m[0].lower() for m in found)
        return [k for k, words in enumerate(self.counts) if sum(min(n, have[w]) for w, n in words.items()) >= 0.8 * len(self.words[k])]

    def compare(self, k: int, found: list[re.Match]) -> dict | None:
        """The template laid over the block's words.

        None if under four fifths of it are there, if half as much stands between its words, or if the two wordings of
        a difference do not name the same: a naming word or a number that only one of them has is another license.
        """
        want, have = self.words[k], [m[0].lower() for m in found]
        matcher = difflib.SequenceMatcher(None, want, have, autojunk=False)
        same = [b for b in matcher.get_matching_blocks() if b.size]
        kept = sum(b.size for b in same)
        if kept < 0.8 * len(want):
            return None
        first, last = same[0].b, same[-1].b + same[-1].size
        differences = []
        for what, i, j, a, b in matcher.get_opcodes():
            inside = have[max(a, first) : min(b, last)] if what != "equal" else []
            if what != "equal" and (j > i or inside):
                differences.append((" ".join(want[i:j]), " ".join(inside)))
        extra = last - first - kept
        if extra > 0.5 * len(want):
            return None
        for a, b in differences:
            (names, numbers), (other_names, other_numbers) = _telling(a.split()), _telling(b.split())
            # Numbers of a text, such as years and list numbers, may stand where the template has none and names nothing.
            if names != other_names or (numbers != other_numbers and (numbers or len(want) < _LONG)):
                return None
        return {"same": kept, "template_words": len(want), "extra": extra, "from": first, "to": last, "differences": differences}

    def scan(self, text: str) -> list[dict]:
        """Findings in order of their places; what lies beside one in its block is looked at again.

        The templates are gone through by how much they reduce the block, and the first that its wording confirms is the
        finding. Templates of which too few words are there could not be confirmed and are not compressed with.
        """
        out: list[dict] = []
        todo = [*blocks(text, self.overlap)]
        while todo:
            start, end = todo.pop()
            block = text[start:end]
            if not _CUE.search(block):
                continue
            found = [*_WORD.finditer(block)]
            common = self.possible(found)
            if not common:
                continue
            gains = self.reductions(block, common)
            for k in sorted(common, key=lambda k: (-gains[k], k)):
                match = self.compare(k, found)
                if match:
                    break
            else:
                continue
            a, b = found[match["from"]].start(), found[match["to"] - 1].end()
            out.append(
                {
                    "license": self.templates[k][0],
                    "template": k,
                    "start": start + a,
                    "end": start + b,
                    "reduction": gains[k],
                    "exact": not match["differences"],
                    "differences": [{"template": x, "text": y} for x, y in match["differences"]],
                }
            )
            todo += [(start, start + a), (start + b, end)]
        kept: list[dict] = []
        for f in sorted(out, key=lambda f: (f["start"] - f["end"], f["start"])):  # of what overlaps, the longest
            if all(f["end"] <= k["start"] or k["end"] <= f["start"] for k in kept):
                kept.append(f)
        return sorted(kept, key=lambda f: f["start"])


_FOUND = "doc_id bigint, license string, template int, start int, end int, reduction double, exact boolean, differences array<struct<template:string,text:string>>"


def _scan(templates: tuple[tuple[str, str], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kinds = {
            "license": pa.string(), "template": pa.int32(), "start": pa.int32(), "end": pa.int32(), "reduction": pa.float64(), "exact": pa.bool_(),
            "differences": pa.list_(pa.struct([("template", pa.string()), ("text", pa.string())])),
        }
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column(0), batch.column(1)):
                rows = scanner.scan(text.as_py() or "")
                ids += [doc.as_py()] * len(rows)
                found += rows
            columns = [pa.array([f[name] for f in found], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], names=["doc_id", *kinds])

    return run


def license_notices(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per notice found: ``(doc_id, license, template, start, end, reduction, exact, differences)``.

    Places are code points, end exclusive; ``differences`` are pairs of wordings, none when
    the notice is ``exact``. Row by row, without a shuffle.

    Null and empty texts have no notices. Null ids stay null, repeated rows give repeated
    notices, of templates that reduce equally the first counts, other columns are not looked at.
    """
    return df.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(_scan(templates), _FOUND)
