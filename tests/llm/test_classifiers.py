"""Toxicity and quality: held-out accuracy, the pair sum, edge cases."""

import zlib

import numpy as np
import pytest

from seriesloom.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, operator, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = operator.train(docs, labels)
    rows = operator.score(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    again = operator.score(docs, operator.train(docs, labels)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_edge_cases(spark, operator, label):
    texts = [(i, f"good words number {i} here", 20, "x") for i in range(40)]
    texts += [(100 + i, f"idiot### trash%%% {i}", 20, "x") for i in range(40)]
    texts += [(500, None, None, "x"), (501, "", 0, "x"), (502, "word " * 300_000, 1_500_000, "x"), (None, "no id", 5, "x"),
              (1, "twice", 5, "x")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, n_chars int, score string")
    marks = [(i, int(i >= 100), int(i < 100)) for i, *_ in texts if i is not None and i < 200] + [(None, 1, 1), (7, None, None)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int")
    rows = operator.score(docs, operator.train(docs, labels)).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    low, high = (by[3], by[103]) if label == "toxic" else (by[103], by[3])
    assert low < 0.3 and high > 0.5
    assert operator.score(docs.limit(0), operator.train(docs, labels)).count() == 0
    for some in (labels.limit(0), labels.where(f"{label} = 1")):
        assert operator.score(docs, operator.train(docs, some)).count() == len(texts)


def test_linear_pair_sum_equals_all_pairs():
    rng = np.random.default_rng(0)
    machine = quality.Machine(3)
    machine.v[:] = rng.normal(size=machine.v.shape)
    machine.w[:] = rng.normal(size=machine.size)
    cols, values = rng.choice(machine.size, 12, replace=False), rng.normal(size=12)
    z, _ = machine.raw(np.zeros(12, int), cols, values, 1)
    want = machine.b + machine.w[cols] @ values + sum(
        machine.v[a] @ machine.v[b] * x * y for i, (a, x) in enumerate(zip(cols, values))
        for b, y in list(zip(cols, values))[:i])
    assert z[0] == pytest.approx(want)


def test_long_texts_have_the_features_of_their_parts(monkeypatch):
    texts = ["abc def  ghi\njkl " * 40, "", "x", "Straße ÄÖ " * 30]
    whole = toxicity.features(texts)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    parts = toxicity.features(texts)
    assert all((a == b).all() for a, b in zip(whole, parts))
