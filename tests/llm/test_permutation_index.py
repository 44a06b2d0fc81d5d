"""Neighbours against brute force: recall on the given vectors, edge cases exactly."""

import math

import numpy as np

from seriesloom.llm import permutation_index as pi


def brute(rows, k=10, every=100):
    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = near[:k]
    return out


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = {}
    for r in pi.nearest(df, lambda i: i % 100 == 0, shard_rows=500).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    for name, near in got.items():
        assert near == sorted(near)
        scores = {j: s for s, j in want[name]}
        assert all(abs(scores[j] - s) < 1e-12 for s, j in near if j in scores)
    hit = sum(len({j for _, j in got[i]} & {j for _, j in want[i]}) for i in want) / sum(map(len, want.values()))
    assert hit >= 0.9, hit


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (100, [1.0, 1.0, 1.0]),
            (9, [1.0, 0.0]), (9, [1.0, 0.0]), (0, [1.0, 0.0]), (200, [5.0, 5.0]), (101, [2.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, rank int, id int")
    got = [tuple(r) for r in pi.nearest(df, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect()]
    near = [(1, 0.0), (9, 0.0), (9, 0.0), (2, math.sqrt(2)), (200, math.sqrt(41))]
    assert got[:5] == [(0, i + 1, j, s) for i, (j, s) in enumerate(near)]
    assert got[5:6] == [(100, 1, 101, 1.0)]
    assert [r[2] for r in got[6:]] == [0, 0, 1, 2, 9, 9]
    assert pi.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0


def test_footrule():
    rng = np.random.default_rng(1)
    order = np.array([rng.permutation(20)[:8] for _ in range(30)], dtype=np.int16)
    full = np.full((30, 20), 8)
    np.put_along_axis(full, order.astype(int), np.arange(8)[None].repeat(30, 0), 1)
    index = pi.Inverted(order, 20)
    for i in range(30):
        assert (index.footrule(order[i]) == np.abs(full - full[i]).sum(1)).all()


def test_recall_with_a_tight_group(spark):
    """A third of the rows lie in one tight group; its members find one another."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x[::3] = x[0] + 0.02 * rng.normal(size=(500, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(rows, every=20)
    got = {}
    for r in pi.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"),
                        lambda i: i % 20 == 0, shard_rows=400).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for inside in (True, False):
        names = [i for i in want if (i % 3 == 0) == inside]
        hit = sum(len(got[i] & {j for _, j in want[i]}) for i in names) / (10 * len(names))
        assert hit >= 0.9, (inside, hit)
