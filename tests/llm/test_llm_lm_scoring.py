import math
from collections import Counter

import pytest

from lotwise.llm import lm_scoring as lm
from llm_helpers import documents, lowered


def brute(rows, target_ids):
    """With dictionaries instead of arrays."""
    split = [(i, ["<s>", *lowered(t).split()] if t else ["<s>"]) for i, t in rows]
    single, pair = (Counter(), Counter()), (Counter(), Counter())
    for i, w in split:
        for m in ((0, 1) if i in target_ids else (1,)):
            single[m].update(w if len(w) > 1 else w[1:])
            pair[m].update(zip(w, w[1:]))
    sizes = [sum(n for x, n in s.items() if x != "<s>") for s in single]
    vocabulary = max(1, len(set(single[1]) - {"<s>"}))
    out = {}
    for i, w in split:
        losses = []
        for m, scale in ((0, 1.0), (1, sizes[0] / sizes[1] if sizes[1] else 1.0)):
            own = i in target_ids or m == 1
            own_single, own_pair = Counter(w) if own else Counter(), Counter(zip(w, w[1:])) if own else Counter()
            total = 0.0
            for a, b in zip(w, w[1:]):
                alone = (max(single[m][b] - own_single[b], 0) * scale + lm.ADDED) / (
                    max(sizes[0] - own * (len(w) - 1) * scale, 0) + lm.ADDED * vocabulary)
                context = max(single[m][a] - own_single[a], 0)
                p = lm.PAIR_WEIGHT * (pair[m][a, b] - own_pair[a, b]) / context + (1 - lm.PAIR_WEIGHT) * alone if context else alone
                total -= math.log(p)
            losses.append(total / max(1, len(w) - 1))
        out[i] = (len(w) - 1, *losses, losses[0] - losses[1])
    return out


def result(spark, rows, target_ids):
    wanted = spark.createDataFrame([(i,) for i in target_ids], "doc_id bigint")
    return {r.doc_id: tuple(r)[1:] for r in lm.score_documents(documents(spark, rows), wanted).collect()}


def close(got, expected):
    assert got.keys() == expected.keys()
    for key in got:
        assert got[key] == pytest.approx(expected[key], rel=1e-5, abs=1e-5), key


ROWS = [(i, f"the cat sat on mat {i % 3} and the dog Ran") for i in range(12)] + [
    (20 + i, f"buy cheap pills now {i % 4} buy buy now") for i in range(12)] + [(50, None), (51, ""), (52, "zzz"), (53, "the " * 2000)]


def test_against_dictionaries(spark):
    target = {0, 1, 2, 3, 4, 5, 52}
    close(result(spark, ROWS, target), brute(ROWS, target))


def test_documents_like_the_target_score_lower(spark):
    got = result(spark, ROWS, {0, 1, 2, 3, 4, 5})
    assert max(got[i][3] for i in range(6, 12)) < min(got[20 + i][3] for i in range(12))
    assert got[50] == got[51] == (0, 0.0, 0.0, 0.0)


def test_no_target_no_documents_and_nulls(spark):
    assert all(math.isfinite(x) for r in result(spark, ROWS, set()).values() for x in r)
    assert result(spark, [], {1}) == {}
    got = lm.score_documents(documents(spark, [(None, "a b"), (1, "a b"), (1, "a b")]), spark.createDataFrame([(1,), (1,), (None,)], "doc_id bigint"))
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "None"]
    assert len({r.score for r in got.collect() if r.doc_id == 1}) == 1


def test_whole_table_against_dictionaries(spark):
    # more words and pairs than a table of hashed cells could hold apart
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    target = {r.doc_id for r in spark.read.parquet(f"{path}/labels.parquet").where("quality = 1").collect()}
    close(result(spark, rows, target), brute(rows, target))


def test_batches_and_ranges_count_together(spark, monkeypatch):
    for batch_tokens, range_tokens in ((8, 1 << 22), (1 << 21, 1)):
        monkeypatch.setattr(lm, "BATCH_TOKENS", batch_tokens)
        monkeypatch.setattr(lm, "RANGE_TOKENS", range_tokens)
        close(result(spark, ROWS, {0, 1, 2, 52}), brute(ROWS, {0, 1, 2, 52}))


def test_smoothing_reckons_with_all_words(spark):
    rows = documents(spark, [(1, "a b c d e"), (2, "f")])
    got = lm.score_documents(rows, spark.createDataFrame([(2,)], "doc_id bigint"))
    # six words though the least is one; the target model has no other text than "f", which is its own
    assert {r.doc_id: r.target_loss for r in got.collect()}[2] == pytest.approx(math.log(6))
