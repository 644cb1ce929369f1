import random

import pytest

from lotwise.llm import near_dedup
from lotwise.llm.components import components
from llm_helpers import documents, lowered, words


def brute(rows, percent=75):
    """Component and set size of each (doc_id, text), from all pairs of full sets."""
    sets = []
    for _, text in rows:
        w = words(lowered(text))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, both = sets[j], len(a & sets[j])
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = None if doc_id is None else smallest[find(i)]
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def result(spark, rows):
    got = near_dedup.near_duplicates(documents(spark, rows))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def edited(rng, text, share):
    return " ".join(rng.choice(["x", "y", "z"]) + str(rng.randrange(999)) if rng.random() < share else w for w in text.split())


def corpus(seed, n_groups, copies, share):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([5, 12, 60, 200])))
        rows += [edited(rng, base, rng.random() * share) for _ in range(rng.randint(1, copies))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(spark):
    rows = corpus(1, 60, 8, 0.08)
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("share", [0.03, 0.06])
def test_large_groups_and_shared_passages(spark, monkeypatch, share):
    """Lists over the hot limit: a large group of near copies, and a passage that many documents share."""
    monkeypatch.setattr(near_dedup, "HOT", 6)
    rng = random.Random(11)
    base = " ".join(f"b{rng.randrange(5000)}" for _ in range(120))
    passage = " ".join(f"p{rng.randrange(5000)}" for _ in range(40))
    texts = [edited(rng, base, rng.random() * share) for _ in range(90)]
    texts += [passage + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([3, 8, 12, 60]))) for _ in range(60)]
    texts += [base] * 20
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("widest", [1024, 24])
def test_what_hubs_leave_is_compared_in_blocks(spark, monkeypatch, widest):
    """Many near copies around the threshold; with small sketches the blocks are not sure."""
    monkeypatch.setattr(near_dedup, "HOT", 3)
    monkeypatch.setattr(near_dedup, "LISTED", (24, 24))
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "WIDEST", widest)
    rows = corpus(4, 3, 60, 0.08)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    same = "a b c d e f g"
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(5, same), (2, same.upper()), (9, "a  b\tc\nd e f g"), (1, None), (3, ""), (4, " \n"), (None, same), (6, "one two"),
            (7, "One  two"), (8, "one"), (-3, long), (20, long + " end"), (11, "é b c"), (12, "É b c"), (5, same), (13, "a b c d")]
    got = result(spark, rows)
    assert [r for r in got if r[0] == 5] == [(5, 3, 2, False)] * 2
    assert (20, 29_997, -3, False) in got
    assert (None, 3, None, True) in got
    assert [(r[0], r[1], r[2]) for r in got if r[0] in (1, 3, 4)] == [(1, 0, 1), (3, 0, 3), (4, 0, 4)]
    assert [r[2] for r in got if r[0] in (6, 7)] == [6, 6]
    assert [r[2] for r in got if r[0] in (11, 12)] == [11, 12]


@pytest.mark.parametrize("turn", [1, -1])
def test_rows_of_one_id_with_different_texts(spark, turn):
    """In both orders of the rows: links go by the text, and none is lost."""
    text, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(3, text + " tail"), (5, text), (5, other), (5, text), (7, other + " more"), (4, other), (4, "one two"), (9, "One two"), (None, text)][::turn]
    assert result(spark, rows) == brute(rows)
    got = result(spark, rows)
    assert [r[2] for r in got if r[0] == 5] == [3, 3, 4] and [r[2] for r in got if r[0] == 4] == [4, 4]
    rng = random.Random(7)
    rows = [(rng.randrange(12), t) for _, t in corpus(5, 12, 6, 0.06)][::turn]
    assert result(spark, rows) == brute(rows)


def test_threshold_is_exact(spark):
    # 15 of 20 shingles in common: linked; 14 of 19: not
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base[:19])), (2, " ".join(base[:24])), (3, " ".join(f"v{i}" for i in range(18))), (4, " ".join(f"v{i}" for i in range(23)))]
    got = {r[0]: r[2] for r in result(spark, rows)}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_empty_table(spark):
    assert result(spark, []) == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    links = chain + star + [(7, 7), (900, 899), (899, 900)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {899: 899, 900: 899}


def test_union_sketches_lose_no_more_than_lists(spark):
    found = near_dedup.shared_by_size(1024, 75)
    assert [max(found[n], 1) for n in range(1, 120)] == [near_dedup.shared_at_least(n, 75) for n in range(1, 120)]
    # at 48 values fewer than 19 in common are as rare as MISSED says
    for common, kept in ((18, []), (19, [(1, 2)]), (20, [(1, 2)])):
        rows = [(c, 200, [*range(common), *(100 + 2 * x + c for x in range(48 - common))]) for c in (1, 2)]
        level = near_dedup._Level(spark.createDataFrame(rows, "rep bigint, n int, sketch array<bigint>"), 24, 75, 48)
        pairs = spark.createDataFrame([(1, 2)], "rep_a bigint, rep_b bigint")
        assert [tuple(r) for r in level.likely(pairs).collect()] == kept
