import zlib

import numpy as np
import pytest

from lotwise.llm import quality_classifier as quality
from lotwise.llm.common import table
from llm_helpers import documents

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))


def test_held_out_accuracy(spark, model):
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    got = quality.classify(table(spark, SF_DIR, "documents"), model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_labels_of_the_held_out_fold_change_nothing(spark, model):
    labels = table(spark, SF_DIR, "labels").selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert quality.train(table(spark, SF_DIR, "documents"), labels) == model


def test_fit_ranks_by_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    good = x[:, 0] - 0.5 * x[:, 1] > -0.5
    model = quality.fit(x, good)
    strength = quality.standardised(x, np.array(model.mean), np.array(model.scale)) @ np.array(model.weight)
    assert ((strength >= model.threshold) == good).mean() > 0.98
    # the threshold is the quantile of the bad documents' share
    assert (strength < model.threshold).sum() == (~good).sum()


def test_bounded_sample(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    small = quality.train(docs, labels, sample=60)
    assert small != quality.train(docs, labels) and small.weight != (0.0,) * len(quality.FEATURES)


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (None, "The end of it."), (3, "same text"), (3, "same text"), (4, "word " * 50_000), (5, "x\x00y 中")]
    got = quality.classify(documents(spark, rows), model).collect()
    assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score and by[None].held_out is False
    assert len(quality.accepted(documents(spark, rows), model).columns) == 5
    assert quality.accepted(documents(spark, rows), model).count() == sum(r.predicted for r in got)
    assert quality.classify(documents(spark, []), model).collect() == []


def test_without_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(documents(spark, [(1, "a")]), labels)
    assert [r.predicted for r in quality.classify(documents(spark, [(1, "a"), (2, None)]), model).collect()] == [1, 1]


def test_repeated_labelled_documents_stay_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] * 3, "doc_id bigint, quality int")
    docs = documents(spark, [(i, "good words here ." if i % 2 else "### ### !!!") for i in range(20)] * 50)
    model = quality.train(docs, labels)
    got = {r.doc_id: r.predicted for r in quality.classify(docs, model).collect()}
    assert got == {i: i % 2 for i in range(20)}
