import random

from lotwise.llm.decontaminate import decontaminate, report, words_of
from llm_helpers import documents


def test_words():
    found = words_of("A-b_C ÉÄ x\u00a0y 1,2\x7f~".encode())
    assert found == [w.encode() for w in ("a", "b", "c", "ÉÄ", "x\u00a0y", "1", "2")]
    assert words_of(None) == words_of(b"") == words_of(b" -- ") == []


def brute(rows, items):
    out = []
    tests = [(str(i) if i is not None else "", words_of((t or "").encode())) for i, t in items]
    for doc_id, text in rows:
        w = words_of((text or "").encode())
        hit, found, longest = set(), set(), 0
        for name, t in tests:
            size = min(13, len(t))
            for at in range(len(t) - size + 1 if t else 0):
                for k in range(len(w) - size + 1):
                    if w[k:k + size] == t[at:at + size]:
                        hit.update(range(k, k + size))
                        found.add(name)
                        n = size
                        while k + n < len(w) and at + n < len(t) and w[k + n] == t[at + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((doc_id, len(w), len(hit), sorted(found), longest or None, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(spark, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate(documents(spark, rows), benchmark, **options)
    assert found.columns[:5] == ["doc_id", "text", "row", "value", "n"]
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.longest.words if r.longest else None, r.contaminated)
                   for r in found.collect()), key=repr)


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 13, 14, 40])))) for i in range(12)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary + ["zz"]) for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(item) - 13))
            parts.append(" - ".join(item[at:at + rng.choice([3, 13, 20])]).upper())
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    return rows, items


def test_against_definition(spark):
    for seed in (1, 2):
        rows, items = cases(seed)
        assert result(spark, rows, items) == brute(rows, items)


def test_blocks_of_tests_add_up(spark):
    rows, items = cases(3)
    assert result(spark, rows, items, block_bytes=200) == brute(rows, items)


def test_edges(spark):
    words = [f"q{i}" for i in range(20)]
    items = [(1, " ".join(words)), (1, " ".join(words)), (2, None), (3, ""), (4, "--"), (None, "lone"), (10, " ".join(words[:13]))]
    clean = " ".join(f"c{i}" for i in range(300))
    rows = [(1, None), (2, ""), (None, " ".join(words)), (3, clean + " " + " ".join(words[:13])), (4, " ".join(words[:12])),
            (5, "lone"), (5, "lone"), (6, clean * 400), (7, " ".join(words[:13]) + " " + clean[:600])]
    assert result(spark, rows, items) == brute(rows, items)
    got = {r[0]: r for r in result(spark, rows, items)}
    assert got[3][2] == 13 and got[3][5] is False  # below a twentieth
    assert got[None][3] == ["1", "10"]
    assert got[5][3] == [""]


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a")]) == []
    assert result(spark, [(1, "a b")], []) == [(1, 2, 0, [], None, False)]


def test_report_digest(spark):
    import hashlib

    benchmark = spark.createDataFrame([(2, "a b"), (10, "b c")], "item_id bigint, text string")
    row = report(decontaminate(documents(spark, [(1, "a b c")]), benchmark)).first()
    assert row.n_items == 2 and row.items_sha256 == hashlib.sha256(b"10,2").hexdigest()
