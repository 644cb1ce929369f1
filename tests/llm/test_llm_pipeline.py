"""The pipeline's stages, each against a plain version on what the stage before kept."""

import pytest

import corpus_pipeline
from lotwise.llm import quality_classifier
from lotwise.llm.common import stored, table
from lotwise.llm.decontaminate import words_of
from llm_helpers import words
from test_llm_line_dedup import brute as cut_lines
from test_llm_near_dedup import brute as near_copies
from test_llm_packing import check as check_packing, exact  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_stages(spark, docs):
    """What is left after each of the first four stages."""
    model = quality_classifier.train(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    scored = quality_classifier.classify(table(spark, SF_DIR, "documents"), model).where("predicted = 1")
    good = {r.doc_id for r in scored.collect()}
    docs = [d for d in docs if d[0] in good]
    yield docs

    cut = {i: (text, n) for i, text, _, n in cut_lines([(d[0], d[1]) for d in docs])}
    docs = [(d[0], cut[d[0]][0], d[2], d[3], len(cut[d[0]][0])) for d in docs if not cut[d[0]][1] or words(cut[d[0]][0])]
    yield docs

    kept = {i for i, _, _, keep in near_copies([(d[0], d[1]) for d in docs]) if keep}
    docs = [d for d in docs if d[0] in kept]
    yield docs

    windows = {}
    for item in table(spark, SF_DIR, "benchmark").collect():
        w = words_of(item.text.encode())
        size = min(13, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            windows.setdefault(size, set()).add(tuple(w[at:at + size]))

    def clean(text):
        w, hit = words_of(text.encode()), set()
        for size, known in windows.items():
            for at in range(len(w) - size + 1):
                if tuple(w[at:at + size]) in known:
                    hit.update(range(at, at + size))
        return not hit or 20 * len(hit) < len(w)

    yield [d for d in docs if clean(d[1])]


def test_stages_and_run(spark, exact):  # noqa: F811
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "decontaminate", "best_fit_packing"]
    docs = table(spark, SF_DIR, "documents")
    before = docs.count()
    columns = docs.columns
    plain = plain_stages(spark, [tuple(r) for r in docs.collect()])
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], plain):
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns
        assert rows_of(docs) == sorted(expected, key=repr), name
        assert docs.count() < before, name
        before = docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    sequences, total = check_packing(packed, texts, exact)
    assert sequences <= -(-total // 1024) + 2


# names that the stages and operators use themselves, and one with a dot
CLASHING = ("row", "of", "a.b", "parts", "text2", "n_lines", "n_removed", "group", "text_hash", "n_hit", "items", "contaminated", "value", "x", "starts")


def case(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", None, None, *CLASHING) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING))


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a b"), (1, None), (2, ""), (2, ""), (3, "word " * 20_000)]])
def test_every_stage_takes_nulls_and_empty_tables(spark, rows):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, case(spark, rows), SF_DIR)
        assert got.dtypes == case(spark, rows).dtypes, name
        kept = got.collect()
        assert len(kept) <= len(rows)
        assert all(r[c] == c for r in kept for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, case(spark, rows), SF_DIR).count() >= len(rows)


def test_near_dedup_keeps_one_row_of_a_group(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text), (5, text), (3, text), (None, text), (9, "other words that are here on their own")]
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, case(spark, rows), SF_DIR)
    assert sorted((r.doc_id for r in got.collect()), key=str) == [3, 9, None]


@pytest.mark.parametrize("turn", [1, -1])
def test_near_dedup_judges_rows_of_one_id_by_their_own_text(spark, turn):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, text), (5, other), (3, text + " end"), (5, other), (6, other + " end"), (5, other + " tail"), (8, ""), (8, ""), (8, None)][::turn]
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, case(spark, rows), SF_DIR).collect()
    # of the other text's group one row with the smallest id stays
    assert sorted(r.doc_id for r in got if r.text) == [3, 5]
    assert [r.doc_id for r in got if not r.text] == [8, 8, 8]
    assert all(r.text.startswith("b0") for r in got if r.doc_id == 5 and r.text)
