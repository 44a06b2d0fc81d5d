"""The join against brute force on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import ngram_join as nj


def brute(rows, width=5):
    """doc_id -> (n_shingles, component_id) by comparing all pairs of word sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width
                    else ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), name), name)
    return sorted((name, len(sets[i]), least[root(i)]) for i, (name, _) in enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = nj.similar_documents(df).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, out.collect()))


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            words = list(rng.choice(texts))
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(words) + 1)
                action = rng.random()
                if action < 0.4:
                    words[at:at + 1] = [rng.choice(vocabulary)]
                elif action < 0.7:
                    words[at:at] = rng.choices(vocabulary, k=rng.randint(1, 8))
                else:
                    del words[at:at + rng.randint(1, 8)]
        else:
            words = rng.choices(vocabulary, k=rng.choice([0, 1, 4, 5, 6, 20, 60, 120]))
            if rng.random() < 0.5:
                words[len(words) // 2:len(words) // 2] = passage
        texts.append(words)
    ids = list(range(n))
    rng.shuffle(ids)
    return [(i, " ".join(w)) for i, w in zip(ids, texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(nj, "RANGE_TOKENS", 2000)
    monkeypatch.setattr(nj, "CHUNK_SETS", 3)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    base = " ".join(f"a{i}" for i in range(40))
    rows = [(9, base), (3, base.upper()), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (8, "ONE\ttwo"),
            (10, "one two three"), (11, "x" * 3_000_000 + " y"), (12, "x" * 3_000_000 + " y"), (9, base)]
    assert run(spark, rows) == brute(rows)
    clash = spark.createDataFrame([(1, base, 0, 0)], "doc_id bigint, text string, n int, component_id int")
    assert nj.similar_documents(clash).count() == 1
    assert run(spark, []) == []
    nulls = spark.createDataFrame([(None, base), (2, base), (None, "lone")], "doc_id bigint, text string")
    got = {tuple(r) for r in nj.similar_documents(nulls).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {(None, 36, 2), (2, 36, 2), (None, 1, None)}


def test_exact_threshold(spark):
    """3 of 4 shingles in common links, one less does not."""
    x = [f"a{i}" for i in range(11)]  # 7 shingles
    y = x + ["b0", "b1"]  # 9, 7 common: 7/9 links
    z = x + ["c0", "c1", "c2"]  # 10, 7 common: 7/10 does not
    rows = [(1, " ".join(x)), (2, " ".join(y)), (3, " ".join(z))]
    assert run(spark, rows) == brute(rows) == [(1, 7, 1), (2, 9, 1), (3, 10, 3)]


def test_trie_counts_every_reachable_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(12)]
        probe = np.unique(rng.integers(0, 60, 40))
        needed = [nj.overlap_needed(len(probe), len(s)) for s in sets]
        want = {i: len(np.intersect1d(s, probe)) for i, s in enumerate(sets)}
        assert nj.Trie(sets).overlaps(probe, needed, 60) == {i: o for i, o in want.items() if o >= needed[i]}


def test_large_group_of_near_copies_makes_few_pairs(spark):
    rng = random.Random(5)
    base = [f"a{i}" for i in range(100)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(100)] = f"b{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = nj.similar_documents(df)
    assert got.where("component_id <> 0").count() == 0
    assert got.agg(F.min("n_shingles")).first()[0] == 96
