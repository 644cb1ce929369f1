import difflib
import re
import textwrap

import pytest
import zstandard

from lotwise.llm import license_scan as scan
from llm_helpers import documents


@pytest.fixture(scope="module")
def known():
    return scan.Templates(scan.TEMPLATES)


def test_every_template_is_found_as_itself(known):
    for name, texts in scan.TEMPLATES.items():
        for text in texts:
            found = scan.scan_text(f"Some prose before.\n\n{text}\n\nMore prose.", known)
            assert [(f["license"], f["line"], f["alike"], f["differences"]) for f in found] == [(name, 2, 1.0, [])]


def test_wrapped_commented_and_reworded(known):
    long = scan.TEMPLATES["MIT"][1].split()
    wrapped = "\n".join(" * " + " ".join(long[i:i + 9]) for i in range(0, len(long), 9))
    found = scan.scan_text("/*\n" + wrapped.replace("free of charge", "without charge") + "\n */", known)
    assert [f["license"] for f in found] == ["MIT"]
    assert found[0]["n_lines"] >= 8 and any(d.startswith("-free of") for d in found[0]["differences"])
    assert [f["license"] for f in scan.scan_text("# Released under the terms of the MIT license", known)] == ["MIT"]


@pytest.mark.parametrize("text", [
    "Licensed under the Foo License, Version 2.0.",
    "Licensed under the Apache License, Version 1.1.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "He lost his driving license on the way to the public domain office.",
    "", "copyright",
])
def test_other_wordings_are_not_taken_for_a_template(known, text):
    assert scan.scan_text(text, known) == []


def test_versions_are_told_apart(known):
    for name, version in (("GPL-2.0", 2), ("GPL-3.0", 3)):
        text = f"this work is licensed under the GNU General Public License, version {version}"
        assert [f["license"] for f in scan.scan_text(text, known)] == [name]


def test_rank_is_by_size_reduction(known):
    ranked = known.ranked("Licensed under CC BY-NC 4.0.")
    assert known.names[ranked[0][1]] == "CC-BY-NC-4.0"
    assert [r for r, _ in ranked] == sorted((r for r, _ in ranked), reverse=True)


def test_query_equals_a_scan_of_every_text(spark, known):
    rows = [(1, None), (2, ""), (3, "Released under the MIT License.\nx\nLicensed under CC BY 4.0."), (3, "Released under the MIT License."),
            (None, "SPDX-License-Identifier: ISC"), (4, "words " * 30_000 + "\nReleased under the MIT License.\n" + "words " * 30_000)]
    got = scan.scan_licenses(documents(spark, rows)).collect()
    brute = [(i, f["line"], f["license"]) for i, t in rows for f in scan.scan_text(t or "", known)]
    assert sorted(((r.doc_id, r.line, r.license) for r in got), key=repr) == sorted(brute, key=repr)
    assert len(brute) == 5
    assert scan.scan_licenses(documents(spark, [])).collect() == []


def test_own_templates(spark):
    got = scan.scan_licenses(documents(spark, [(1, "This licence is ours alone.")]), {"OURS": ("This licence is ours alone.",)})
    assert [(r.license, r.alike) for r in got.collect()] == [("OURS", 1.0)]


TEXTS = [(name, text) for name, texts in scan.TEMPLATES.items() for text in texts]


@pytest.mark.parametrize("columns", [40, 75])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_every_template_wrapped(known, columns, mark):
    for name, text in TEXTS:
        lines = [mark + line for line in textwrap.wrap(text, columns, break_on_hyphens=False, break_long_words=False)]
        found = scan.scan_text("\n".join(["Some prose before", *lines, "and more prose"]), known)
        assert [(f["license"], f["line"], f["n_lines"], f["alike"]) for f in found] == [(name, 1, len(lines), 1.0)], text


def test_every_template_in_paragraphs(known):
    for name, text in TEXTS:
        parts = re.split(r"(?<=[.:;]) (?=[A-Z0-9])", text)
        found = scan.scan_text("Prose.\n\n" + "\n\n".join(parts) + "\n\nProse.", known)
        assert [(f["license"], f["line"], f["n_lines"], f["alike"]) for f in found] == [(name, 2, 2 * len(parts) - 1, 1.0)], text


def test_every_template_in_a_longer_line(known):
    for name, text in TEXTS:
        for before, after in (("We wrote this tool last year. ", " Patches are welcome, as are reports of faults in it."), ("This tool is ", " and hosted by us")):
            found = scan.scan_text(before + text + after, known)
            assert [(f["license"], f["line"], f["alike"]) for f in found] == [(name, 0, 1.0)], text


def test_cue_over_a_line_end(spark):
    rows = [(1, "This is free and unencumbered software released into the public\n# domain.")]
    assert [r.license for r in scan.scan_licenses(documents(spark, rows)).collect()] == ["Unlicense"]


def by_definition(text, texts):
    """Every pair of cuts around a cue, compressed with every template; the most bytes saved, less those left, first."""
    known = scan.Templates(texts)
    text = text.lower()
    places = list(scan._WORD.finditer(text))
    words = [m[0] for m in places]
    cues = [max([k for k, p in enumerate(places) if p.start() <= m.start()], default=0) for m in scan._CUE.finditer(text)]
    cuts = scan._cuts(text, places, words, known)
    dictionaries = [zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for w in known.words]

    def size(content, dictionary=None):
        return len(zstandard.ZstdCompressor(level=scan.LEVEL, write_content_size=False, dict_data=dictionary).compress(content))

    pairs = []
    for start in cuts:
        for end in cuts:
            if end - start <= 60 and any(start <= c < end for c in cues):
                content = " ".join(words[start:end]).encode()
                alone = size(content)
                pairs += [(2 * (left := size(content, d)) - alone, end - start, start, t, 1 - left / alone) for t, d in enumerate(dictionaries)]
    kept = []
    for _, n, start, t, reduction in sorted(pairs):
        block, own = words[start:start + n], known.words[t]
        if reduction < scan.MIN_REDUCTION or any(start < b + m and b < start + n for b, m, *_ in kept):
            continue
        steps = difflib.SequenceMatcher(None, own, block, autojunk=False).get_opcodes()
        alike = sum(i2 - i1 for op, i1, i2, _, _ in steps if op == "equal") / max(len(own), n)
        if alike >= scan.MIN_ALIKE and known.differences(block, t)[2]:
            kept.append((start, n, known.names[t], reduction, alike))
    return [(name, reduction, alike) for _, _, name, reduction, alike in sorted(kept)]


SHORT = {name: tuple(t for t in texts if len(t) < 200) for name, texts in scan.TEMPLATES.items()}


@pytest.mark.parametrize("text", [
    "We hold the copyright. Released under the MIT license; see there. Licensed under CC BY-SA 4.0, or CC BY 4.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.\nSPDX-License-Identifier: MIT\n",
    "this program is licensed under the gnu general public license, version 3, and the gnu general public license, version 2",
    "Licensed under the terms of the Apache License, Version 2.0. Released into the public domain, under CC0 1.0 of course.",
    "copyright copyright, copyright. license (public domain)",
])
def test_equals_every_block_with_every_template(text):
    found = [(f["license"], f["reduction"], f["alike"]) for f in scan.scan_text(text, scan.Templates(SHORT))]
    assert found == by_definition(text, SHORT)


def test_the_larger_reduction_is_confirmed_first():
    # the first template explains more words, the second one more bytes; one word is in both
    texts = {"A": ("it is so as to be of a licence",), "B": ("licence notwithstanding internationally incomprehensible obligations",)}
    text = "It is so as to be of a licence notwithstanding internationally incomprehensible obligations"
    assert [f["license"] for f in scan.scan_text(text, scan.Templates(texts))] == ["B"] == [name for name, _, _ in by_definition(text, texts)]


def test_every_template_takes_part_for_every_block(monkeypatch):
    known, asked = scan.Templates(SHORT), []
    reductions = scan.Templates.reductions
    monkeypatch.setattr(scan.Templates, "reductions", lambda self, block: asked.append(len(r := reductions(self, block))) or r)
    assert [f["license"] for f in scan.scan_text("Released under the MIT License.", known)] == ["MIT"]
    assert asked and set(asked) == {len(known.words)}
