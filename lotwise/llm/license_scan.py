"""License scans by conditional compression.

A candidate block is a run of words around one that speaks of a licence. It begins and
ends at a line, at a mark between words, or where a template would, and goes on over
line ends and blank lines. Every template is the raw zstandard dictionary of a
compressor; the more a template shortens a block, the more of it the template explains.
Each block is compressed with every template, and the largest reductions come first.
They are confirmed by the exact differences between the template's words and the
block's: enough must be equal, and no difference may touch a licence's name or
a number. Only blocks that no template could be confirmed for, as too few of its words
or not all of its names and numbers occur in them, are not compressed.

Spark selects the documents that have a cue at all; tasks compress their blocks.
"""

from __future__ import annotations

import difflib
import heapq
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, quoted

CUE = r"(?i)licen[sc]e|licen[sc]ing|copyright|spdx|public[\W_]+domain|permission[\W_]+is[\W_]+hereby|" \
    r"redistribution[\W_]+and[\W_]+use|without[\W_]+warranty"
MIN_REDUCTION = 0.2
MIN_ALIKE = 0.6  # share of words in common, of the longer of template and block
LEVEL = 3
# A difference in one of these, or in a number, is a difference of licence.
NAME_WORDS = frozenset(
    "apache mit gnu general lesser affero gpl lgpl agpl mozilla mpl bsd isc cc cc0 by by-sa by-nc by-nd by-nc-sa by-nc-nd "
    "attribution attribution-sharealike attribution-noncommercial attribution-noderivatives eclipse epl public domain".split())

# Well-known notices; the wording is fixed. An identifier may have several.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

_CUE = re.compile(CUE)
_MARK = re.compile(r"[\n.!?:;,()\[\]{}\"<>|\u2013\u2014]|\s-+\s")
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    """Words without case, punctuation and comment marks."""
    return _WORD.findall(text.lower())


class Templates:
    """The templates with a compressor for each, made once per task."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], level: int = LEVEL):
        self.names = [name for name, texts in templates.items() for _ in texts]
        self.words = [words_of(text) for texts in templates.values() for text in texts]
        self.level = level
        self.alone = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(level=level, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
                " ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for w in self.words
        ]
        self.counts = [Counter(w) for w in self.words]
        # without one of these a block is of another licence
        self.needed = [frozenset(x for x in w if x in NAME_WORDS or any(c.isdigit() for c in x)) for w in self.words]
        self.openings = {tuple(w[:2]) for w in self.words}
        self.closings = {tuple(w[-2:]) for w in self.words}

    def most(self, template: int) -> int:
        """Words of the longest block that the template can be confirmed for."""
        return int(len(self.words[template]) / MIN_ALIKE)

    def ranked(self, block: str) -> list[tuple[float, int]]:
        """Size reductions by the templates, the largest first; ties by the templates' order."""
        return [(reduction, t) for _, reduction, t in self.reductions(words_of(block))]

    def reductions(self, block: list[str]) -> list[tuple[int, float, int]]:
        """Bytes that each template saves less those it leaves, its size reduction, and the template; the largest first.

        Within a block both have one order. Between blocks, the words of a notice count for one, and words around it against it.
        """
        content = " ".join(block).encode()
        alone = len(self.alone.compress(content))
        left = [len(given.compress(content)) for given in self.given]
        return sorted(((alone - 2 * n, 1 - n / alone, t) for t, n in enumerate(left)), key=lambda x: (-x[0], x[2]))

    def differences(self, block: list[str], template: int) -> tuple[float, list[str], bool]:
        """Share of words in common, the exact differences, and whether they leave the licence the same.

        ``-`` is in the template only, ``+`` in the block only.
        """
        one, two = self.words[template], block
        steps = difflib.SequenceMatcher(None, one, two, autojunk=False).get_opcodes()
        same = sum(i2 - i1 for op, i1, i2, _, _ in steps if op == "equal")
        edits, same_licence = [], True
        for op, i1, i2, j1, j2 in steps:
            if op != "equal":
                lost, new = one[i1:i2], two[j1:j2]
                numbers = lost + new if lost else []  # a number in added words may be a year
                if NAME_WORDS.intersection(lost + new) or any(c.isdigit() for w in numbers for c in w):
                    same_licence = False
                edits += ["-" + " ".join(one[i1:i2])] * (i2 > i1) + ["+" + " ".join(two[j1:j2])] * (j2 > j1)
        return same / max(len(one), len(two), 1), edits, same_licence


def _cuts(text: str, places: list[re.Match], words: list[str], templates: Templates) -> list[int]:
    """Numbers of the words before which a block may begin or end, and the end of the text."""
    found = [0]
    for k in range(1, len(words)):
        if (_MARK.search(text, places[k - 1].end(), places[k].start())
                or (words[k], *words[k + 1:k + 2]) in templates.openings or (*words[max(k - 2, 0):k - 1], words[k - 1]) in templates.closings):
            found.append(k)
    return [*found, len(words)]


def blocks(words: list[str], cues: list[int], cuts: list[int], templates: Templates) -> set[tuple[int, int]]:
    """Candidate blocks around words with a cue: first word and end.

    A block is left out only if no template can be confirmed for it: each has too few words in common with the block,
    in any order, or a name or number that the block lacks. Counts of words decide nothing else.
    """
    found = set()
    longest = max((templates.most(t) for t in range(len(templates.words))), default=0)
    tried: set[tuple[int, int]] = set()
    for cue in cues:
        near = Counter(words[max(0, cue - longest):cue + longest])
        for t, (own, needed, counts) in enumerate(zip(templates.words, templates.needed, templates.counts, strict=True)):
            if not needed <= near.keys() or sum(min(n, near[w]) for w, n in counts.items()) < MIN_ALIKE * len(own):
                continue
            most = templates.most(t)
            for at in range(bisect_right(cuts, cue) - 1, -1, -1):
                start = cuts[at]
                if cue - start >= most:
                    break
                if (start, t) in tried:
                    continue
                tried.add((start, t))
                left, common, k = dict(counts), 0, start
                nearest = cues[bisect_right(cues, start - 1)]
                for end in cuts[at + 1:]:
                    if end - start > most:
                        break
                    for w in words[k:end]:
                        if left.get(w, 0):
                            left[w] -= 1
                            common += 1
                    k = end
                    if common / max(len(own), end - start) >= MIN_ALIKE and nearest < end and all(left[w] < counts[w] for w in needed):
                        found.add((start, end))
    return found


def scan_text(text: str, templates: Templates) -> list[dict]:
    """Confirmed notices, in the order of the text.

    Every block is compressed with every template, and the pairs are confirmed in the order of ``Templates.reductions``;
    what overlaps a confirmed notice is passed over.
    """
    text = text.lower()
    places = list(_WORD.finditer(text))
    if not places or not templates.words:
        return []
    words, starts = [m[0] for m in places], [m.start() for m in places]
    cues = sorted({max(0, bisect_right(starts, m.start()) - 1) for m in _CUE.finditer(text)})
    if not cues:
        return []
    queue = [
        (-gain, end - start, start, t, reduction)
        for start, end in blocks(words, cues, _cuts(text, places, words, templates), templates)
        for gain, reduction, t in templates.reductions(words[start:end])
        if reduction >= MIN_REDUCTION
    ]
    found: list[tuple[int, int, dict]] = []
    for _, n, start, t, reduction in sorted(queue):
        if any(start < e and b < start + n for b, e, _ in found):
            continue
        alike, edits, same_licence = templates.differences(words[start:start + n], t)
        if same_licence and alike >= MIN_ALIKE:
            line = text.count("\n", 0, starts[start])
            found.append((start, start + n, {
                "line": line, "n_lines": text.count("\n", starts[start], starts[start + n - 1]) + 1,
                "license": templates.names[t], "reduction": reduction, "alike": alike, "differences": edits}))
    return [notice for _, _, notice in sorted(found, key=lambda x: x[0])]


_SCHEMA = "doc_id bigint, line bigint, n_lines bigint, license string, reduction double, alike double, differences array<string>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("line", pa.int64()), ("n_lines", pa.int64()), ("license", pa.string()),
    ("reduction", pa.float64()), ("alike", pa.float64()), ("differences", pa.list_(pa.string()))])


def _scan(templates: dict[str, tuple[str, ...]], level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, level)
        for batch in batches:
            out = [
                {"doc_id": doc_id} | notice
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for notice in scan_text(text, known)
            ]
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return run


def scan_licenses(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, level: int = LEVEL,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each licence notice in ``docs``: place, identifier, size reduction, likeness, exact differences.

    Lines count from 0. Null and empty texts have no notice. Repeated rows give
    their notices again, a null doc_id stays null, other columns are not read. Of
    overlapping blocks that can be confirmed the one with the largest reduction in bytes, less
    the bytes that remain, is given, of equal ones the shorter, then the earlier; ties between
    templates go to the first.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    return map_arrow(rows.where(F.col("text").rlike(CUE)), _scan(dict(templates), level), _SCHEMA)
