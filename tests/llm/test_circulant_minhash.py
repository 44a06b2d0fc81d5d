import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import circulant_minhash as cm

SCHEMA = "doc_id long, text string"


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: min((r[0] for r, q in zip(rows, part) if q == p and r[0] is not None), default=None) for p in part}
    return sorted(((r[0], len(s), least[p], r[0] == least[p]) for r, s, p in zip(rows, sets, part)), key=repr)


def found(spark, rows):
    got = cm.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def near_copies(count, words, changed, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(count):
        own = list(base)
        for _ in range(changed):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [cm.BLOCK_SHINGLES, 500])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cm, "BLOCK_SHINGLES", block)  # small blocks: links across blocks
    texts = near_copies(60, 100, 2, 1) + near_copies(60, 100, 4, 2) + near_copies(20, 40, 1, 3) + ["same text here now"] * 30
    order = random.Random(4).sample(range(1000), len(texts))
    rows = list(zip(order, texts))
    assert found(spark, rows) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"t{i}" for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a"), (7, "b a"), (8, long), (9, long + " end"),
            (None, "a b"), (None, "only here and nowhere"), (4, "a b"), (4, "c d e f"), (10, "Ä b c"), (11, "ä b c")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_clashing_columns(spark):
    rows = [(1, "a b c d"), (2, "a b c d")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "set", "band", "block", "digest", "component", "n", "a", "b"):
        df = df.withColumn(name, F.lit("x"))
    got = cm.near_duplicates(df)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = base[:2000], base[1000:]
    signature = cm.signatures([a, b], 4000)
    assert abs((signature[0] == signature[1]).mean() - 1 / 3) < 0.03
    # long sets are permuted in pieces, with the same result
    big = rng.integers(0, 2**63, 3 * cm.PIECE // 2).astype(np.uint64)
    one = cm.signatures([big], 12)
    places = cm._scattered(big)
    assert (one[0] == [cm._ring(places + np.uint32(k)).min() for k in range(12)]).all()
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(cm._ring(x.copy()))) == len(x)  # one to one
