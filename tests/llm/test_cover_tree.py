import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(anchor, positive, rank, negative, positive score, negative score) by plain loops."""
    known = []
    for key, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        known.append((i, key, [int(np.floor(256 * float(np.float32(x)))) for x in v],
                      (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, key, v, label in known:
        if i % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, k, l) for j, k, w, l in known if k != key)
        for ps, p, _, _ in [s for s in scores if s[3] == label][:5]:
            fits = [s for s in scores if s[3] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(i, p, r, j, -ps, -s) for r, (s, j, _, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    got = cover_tree.hard_negatives(df, lambda i: i % 100 == 0, lambda i: i % 7 == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(cover_tree, "SHARD_ROWS", 64)
    monkeypatch.setattr(cover_tree, "LEAF", 8)
    monkeypatch.setattr(cover_tree, "BLOCK_QUERIES", 2)


def grouped_rows(n=700, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = middle[i % 12] + 0.3 * rng.normal(size=dim)
        rows.append((i, [float(x) for x in (middle[0] if i % 3 == 0 else v)], int(rng.integers(0, 4))))
    return rows  # a third of the rows are one vector


def test_equals_brute_force_over_many_shards(spark, small_shards):
    rows = grouped_rows()
    assert mined(spark, rows) == brute(rows)


def test_nulls_repeats_and_lengths(spark, small_shards):
    rows = grouped_rows(300, 3, 5) + [
        (None, [1.0, 1.0, 1.0], 1), (401, None, 1), (402, [1.0, None, 0.0], 1), (403, [float("nan"), 0.0, 1.0], 1),
        (404, [float("inf"), 0.0, 0.0], 1), (405, [1.0, 2.0, 3.0], None), (406, [0.0, 0.0, 0.0], 2),
        (500, [0.0, 0.0, 0.0], 1), (600, [0.5], 1), (407, [0.25, 0.5], 3), (408, [], 1), (700, [], 1)]
    rows += [rows[100], rows[100], rows[7]]  # repeated rows, an anchor among them
    assert mined(spark, rows) == brute(rows)


def test_empty_tables_and_clashing_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    rows = grouped_rows(120, 4, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "key", "cell", "shard", "score", "windows"):
        df = df.withColumn(name, F.lit("x"))
    got = cover_tree.hard_negatives(df, lambda i: i % 100 == 0, lambda i: i % 7 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    for scale in (2**20, 2**27, 2**30):
        v = rng.integers(-scale, scale, (200, 3))
        ids = np.arange(200)
        tree = cover_tree.CoverTree(ids, ids, ids % 3, v, float((v.astype(float) ** 2).sum(axis=1).max()))
        q = cover_tree.Query.__new__(cover_tree.Query)
        q.key, q.label, q.same, q.k, q.v = 5, 2, True, 4, v[5]
        q.windows = [cover_tree.SearchWindow(-2**62, 2**62, None, None)]
        want = sorted((-sum(int(a) * int(b) for a, b in zip(v[i], v[5])), i) for i in range(200) if i % 3 == 2 and i != 5)
        assert [(-s, i) for _, _, i, _, s in tree.search([q])] == want[:4]
