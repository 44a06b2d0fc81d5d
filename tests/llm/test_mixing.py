"""Mixing: targets, shares, limits, reruns."""

import numpy as np
import pytest

from seriesloom.llm import mixing


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    # 5/8 of 1010 is above 3 * 10; the rest goes 2 : 1
    assert mixing.targets([10, 500, 500], [5, 2, 1]) == [30.0, pytest.approx(980 * 2 / 3), pytest.approx(980 / 3)]
    assert mixing.targets([0, 10], [5, 2]) == [0.0, 10.0]
    assert mixing.targets([], []) == [] and mixing.targets([0], [5]) == [0.0]


def test_shards_hold_every_slot_once():
    quotas = [1000, 37, 0, 5]
    shards = mixing.Shards(quotas, 64, seed=3)
    total = np.zeros(4, dtype=np.int64)
    for i in range(shards.n):
        own, before = shards.counts(i)
        assert (before == total).all() and (own >= 0).all()
        assert own.sum() == min(64, 1042 - 64 * i)
        total += own
    assert total.tolist() == quotas
    huge = mixing.Shards([10**12, 3 * 10**11], 1024, seed=1)
    own, before = huge.counts(huge.n // 2)
    assert own.sum() == 1024 and abs(before[0] / before.sum() - 10 / 13) < 1e-3


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutation(n):
    once = mixing.permute(np.arange(n), n, 1, 0)
    assert sorted(once.tolist()) == list(range(n))
    assert n < 17 or once.tolist() != mixing.permute(np.arange(n), n, 1, 1).tolist()


def table(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(40 + i * 7 % 300)), f"s{i % 4}") for i in range(400)]
    rows += [(1000, None, "s1"), (1001, "", "s1"), (1002, " \t\n", None), (1003, "one two", None),
             (1004, "word " * 50_000, "s2"), (5, "a b c", "s0"), (5, "a b c", "s0"), (1005, "é ü x", "s3"),
             (None, "no id", "s3")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, source string, size int, src int")


def test_taken(spark):
    df = table(spark)
    got = mixing.taken(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.taken(df.repartition(7)).collect()), key=str)
    want = [len((r["text"] or "").encode().split()) for r in df.collect()]
    assert sorted(r["size"] for r in got) == sorted(want)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    targets = {}
    for r in got:
        held = targets.setdefault((r["target"], r["source_size"]), [0, r["source_size"]])
        held[0] += r["taken"]
    assert len(targets) == 5
    for (target, _), (taken, size) in targets.items():
        assert target <= 3 * size and abs(taken - target) <= 2 * 128
    assert abs(sum(t for t, _ in targets) - sum(want)) < 1e-6 * sum(want)
    assert mixing.taken(df.limit(0)).count() == 0
    assert mixing.taken(df.where("text is null")).first()["taken"] == 0


def test_mixed_documents_hold_what_is_taken(spark):
    df = table(spark)
    got = {}
    for r in mixing.mixed_documents(df).select("doc_id", "text").collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    want = {}
    for r in mixing.taken(df).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    given = {}
    for r in df.collect():
        given.setdefault(r["doc_id"], set()).update((r["text"] or "").encode().split())
    assert {i: n for i, n in want.items() if n} == {i: sum(len(t.encode().split()) for t in ts) for i, ts in got.items()}
    assert all(set(t.encode().split()) <= given[i] for i, ts in got.items() for t in ts)
