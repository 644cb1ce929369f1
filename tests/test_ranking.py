import random

import pytest

from lotwise.operators.ranking import number_rows, top_per_group


@pytest.mark.parametrize("bits", [16, 22])
def test_row_numbers_over_blocks(spark, bits):
    rng = random.Random(1)
    keys = {
        "a": [rng.randrange(-(2**62), 2**62) for _ in range(50)] + list(range(-20, 40)),
        "b": list(range(65500, 65600)),
        "c": [7],
    }
    df = spark.createDataFrame([(g, k) for g, ks in keys.items() for k in ks], "g string, k bigint")
    got = {(r.g, r.k): r.position for r in number_rows(df, "g", "k", bits=bits).collect()}
    want = {(g, k): n for g, ks in keys.items() for n, k in enumerate(sorted(ks), 1)}
    assert got == want


def test_top_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame(
        [("x", 3, 1.0), ("x", 1, 1.0), ("x", 2, 1.0), ("x", 9, 5.0), ("y", 4, None), ("y", 5, 0.5)],
        "g string, k bigint, v double",
    )
    got = {(r.g, r.k) for r in top_per_group(df, "g", "v", "k", 3).collect()}
    assert got == {("x", 9), ("x", 1), ("x", 2), ("y", 4), ("y", 5)}
    assert {(r.g, r.k) for r in top_per_group(df, "g", "v", "k", 1).collect()} == {("x", 9), ("y", 5)}
