import numpy as np
import pytest

from lotwise.llm import neighbours as nn

SCHEMA = "vec_id bigint, embedding array<float>, vector string, rep int, `a.b` int, bucket string, query string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "v", 1, 2, "b", "q")
                                  for i, v in rows], SCHEMA)


def brute(rows, k=5, step=50):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and None not in v and len(v) and np.isfinite(np.array(v, np.float32)).all() and np.any(np.array(v, np.float32))]
    out = []
    for at, (i, v) in enumerate(ok):
        if i % step == 0:
            near = sorted((-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), j)
                          for other, (j, w) in enumerate(ok) if other != at and len(w) == len(v))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


def draw(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] + rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def close(got, wanted):
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=1e-12)


def test_all_buckets_are_exact(spark):
    rows = draw(400, 12)
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, rows[3][1]), (2050, rows[50][1])]  # copies, more than a list holds
    rows += [(3000, None), (3050, [0.0] * 12), (3100, [1.0, None] + [0.0] * 10), (3150, [float("nan")] * 12), (3200, [float("inf")] + [1.0] * 11),
             (3250, []), (None, rows[0][1]), (50, rows[50][1]), (100, rows[7][1]), (4000, [1.0, 2.0, 3.0]), (4001, [1.0, 2.0, 2.0]), (4050, [3.0] * 7)]
    got = nn.nearest_neighbours(table(spark, rows), bucket_rows=8, block_rows=16, sample=64, recall=1.0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    # with every neighbour of every query in the sample, what is found is exact
    close(sorted(map(tuple, got.collect())), brute(rows))


def test_recall_on_a_larger_table(spark):
    rows = draw(4000, 32)
    got = {(r.query_id, r.vec_id) for r in nn.nearest_neighbours(table(spark, rows), bucket_rows=32).collect()}
    wanted = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(got) == len(wanted) == 400
    assert len(got & wanted) >= 0.9 * len(wanted)


def test_own_condition_fewer_candidates_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, -1.0])]
    got = sorted(map(tuple, nn.nearest_neighbours(table(spark, rows), "vec_id < 3").collect()))
    close(got, [(1, 1, 2, 1.0), (1, 2, 3, 0.0), (2, 1, 1, 1.0), (2, 2, 3, 0.0)])
    assert nn.nearest_neighbours(table(spark, rows)).collect() == []
    assert nn.nearest_neighbours(table(spark, [])).collect() == []
    assert nn.nearest_neighbours(table(spark, [(50, [1.0, 1.0])])).collect() == []


def test_rotations_keep_lengths_and_probes_begin_with_the_own_bucket():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20, 13))
    x /= np.linalg.norm(x, axis=1)[:, None]
    hashes = nn.Hashes(13, 100_000, tables=3, bucket_rows=16)
    assert hashes.axes[0] == 16 and len(hashes.axes) > 1
    assert np.linalg.norm(nn.hadamard(np.pad(x, ((0, 0), (0, 3)))), axis=1) == pytest.approx(np.ones(20))
    own = hashes.buckets_of(x)
    for v, buckets in zip(x, own, strict=True):
        probes = hashes.probes(v, 50)
        assert probes[:, 0].tolist() == buckets.tolist()
        assert all(len(set(row)) == 50 for row in probes.tolist())
    assert sorted(hashes.probes(x[0], hashes.buckets)[1].tolist()) == list(range(hashes.buckets, 2 * hashes.buckets))
