import random

from lotwise.llm.quality_rules import BASE, RULES, Rule, quality_rules
from llm_helpers import documents, words


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def result(spark, rows):
    found = quality_rules(documents(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found), key=repr)


def test_counts_against_definition(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        size = rng.choice([0, 3, 9, 10, 30, 60])
        rows.append((i, "".join(rng.choice(["ab", "c", "é\u00a0x", "#", "𝔘"]) + rng.choice([" ", "\n", "\t ", " "]) for _ in range(size))))
    rows += [(1000, None), (1001, ""), (None, "a b"), (1002, "w " * 30_000), (1002, "w " * 30_000), (1003, "x\x1cy z\u2003")]
    expected = sorted(((i, *base(t)) for i, t in rows if t is None or len(t) < 5000), key=repr)
    got = [r for r in result(spark, rows) if r[0] != 1002]
    assert got == expected
    assert [r[1:] for r in result(spark, rows) if r[0] == 1002] == [(30_000, 30_000, 0, 0, 30_000, True)] * 2


def test_kept_follows_the_table(spark):
    good = "The quick fox and the slow dog walked to a house that was on the hill, and it was late in the day."
    rows = [(1, good), (2, good.replace(" ", "### ")), (3, good.upper()), (4, "too short"), (5, "100 200 300 400 500 600 700 800 900 1000 1100 1200"),
            (6, "\n".join("- " + x + " the words of a list" for x in "abcdefgh"))]
    got = {r.doc_id: (r.kept, r.failed_rules) for r in quality_rules(documents(spark, rows)).collect()}
    assert got[1] == (True, [])
    assert got[2] == (False, ["symbols"])
    assert got[3] == (False, ["shouting"])
    assert got[4][0] is False and "too_short" in got[4][1]
    assert got[5] == (False, ["no_letters"])
    assert "bullets" in got[6][1]


def test_own_table_and_plan(spark):
    docs = documents(spark, [(1, "a b c")])
    found = quality_rules(docs, base=(), rules=(Rule("few", "n_words", low=4),))
    assert [(r.kept, r.base_failed, r.failed_rules) for r in found.collect()] == [(False, False, ["few"])]
    plan = found._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert len({r.name for r in (*BASE, *RULES)}) == len((*BASE, *RULES))


def test_empty_table(spark):
    assert result(spark, []) == []
