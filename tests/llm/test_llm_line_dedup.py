import random

from lotwise.llm.line_dedup import dedup_lines
from llm_helpers import documents


def brute(rows):
    """By the definition: windows of three visible lines, first by doc_id and position."""
    first, places = {}, []
    for number, (doc_id, text) in enumerate(rows):
        if text is None or doc_id is None:
            continue
        visible = [(i, line.strip(" \t\r\x0b\f")) for i, line in enumerate(text.split("\n"))]
        visible = [v for v in visible if v[1]]
        for at in range(len(visible) - 2):
            key = tuple(v[1] for v in visible[at:at + 3])
            first[key] = min(first.get(key, (doc_id, at)), (doc_id, at))
            places.append((key, doc_id, at, number, [v[0] for v in visible[at:at + 3]]))
    cut = {}
    for key, doc_id, at, number, lines in places:
        if (doc_id, at) > first[key]:
            cut.setdefault(number, set()).update(lines)
    out = []
    for number, (doc_id, text) in enumerate(rows):
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        lines = text.split("\n")
        gone = cut.get(number, set())
        out.append((doc_id, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(out, key=repr)


def result(spark, rows):
    got = dedup_lines(documents(spark, rows))
    assert got.columns == ["doc_id", "text", "row", "value", "n", "n_lines", "n_removed"]
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=repr)


def test_against_definition(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        lines = [rng.choice(["a", "b", "c", " a ", "", "d", "e\t"]) for _ in range(rng.randint(0, 12))]
        rows.append((i % 150, "\n".join(lines)))
    assert result(spark, rows) == brute(rows)


def test_shared_passage_stays_once(spark):
    passage = "one line\ntwo line\nthree line\nfour line"
    rows = [(7, "own\n" + passage), (3, passage + "\nend"), (9, "x\n\n" + passage.replace("\n", "\n\n") + "\ny")]
    got = {r[0]: r for r in result(spark, rows)}
    assert got[3][1] == rows[1][1]
    assert got[7][1] == "own" and got[7][3] == 4
    assert got[9][1] == "x\n\n\n\n\ny"


def test_edges(spark):
    long = "\n".join(f"line {i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "a\nb"), (None, "p\nq\nr"), (5, "p\nq\nr"), (6, "p\nq\nr"), (6, "p\nq\nr"),
            (7, long), (8, long + "\nend"), (9, "z\nz\nz\nz\nz")]
    got = result(spark, rows)
    assert got == brute(rows)
    assert (8, "end", 20_001, 20_000) in got
    assert [r for r in got if r[0] == 6] == [(6, "", 3, 3)] * 2
    assert (None, "p\nq\nr", 3, 0) in got
    assert (9, "z", 5, 4) in got


def test_empty_table(spark):
    assert result(spark, []) == []


def test_added_names_replace_input_columns(spark):
    docs = documents(spark, [(1, "a")]).withColumnRenamed("n", "n_lines")
    assert [r.n_lines for r in dedup_lines(docs).collect()] == [1]
