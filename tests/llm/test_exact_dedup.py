"""Exact duplicates against a dictionary."""

import hashlib

import pytest

from seriesloom.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for i in ids:
            out.append((i, keep, len(ids), left and i == keep, hashlib.sha256(text.encode()).hexdigest()))
            left = left and i != keep
    return sorted(out, key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, "é"), (9, "é"), (3, "a"),
        (10, "x" * 200_000), (11, "x" * 200_000), (12, "x" * 199_999 + "y"), (None, "b"), (None, "lone"), (None, "lone"),
        *[(100 + i, f"t{i % 40}") for i in range(200)]]


@pytest.mark.parametrize("key_bits, page_rows", [(64, 50_000), (64, 3), (3, 2), (0, 5)])
def test_equal_texts(spark, key_bits, page_rows):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS], "doc_id bigint, text string, id int, key string")
    got = ed.exact_dedup(df, key_bits=key_bits, page_rows=page_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)
    assert ed.exact_dedup(df.limit(0), key_bits=key_bits).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) as key").unionByName(spark.range(500).selectExpr("0L as key"))
    cells, depth = ed.directory(keys, page_rows=100)
    rows = keys.withColumn("cell", ed._cell(depth, 64)).join(cells, "cell").groupBy("bucket", "depth").count().collect()
    assert sum(r["count"] for r in rows) == 1500
    assert all(r["count"] <= 100 or r["depth"] == depth for r in rows)
    assert min(r["depth"] for r in rows) < depth  # not every bucket was split as far as the fullest


def test_without_copies(spark):
    df = spark.createDataFrame([(*r, "z") for r in ROWS], "doc_id bigint, text string, _keep string")
    got = sorted([(r["doc_id"], r["text"]) for r in ed.without_copies(df).collect()], key=str)
    last = {}
    for i, text in ROWS:
        last[text or ""] = max(last.get(text or "", -1), -1 if i is None else i)
    assert [(i, t or "") for i, t in got] == sorted([(None if i < 0 else i, t) for t, i in last.items()], key=str)
