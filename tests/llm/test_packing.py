"""Packing: the plan uses every piece once, sequences are gapless and hold the library's ids."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesloom.llm import packing
from seriesloom.llm.queries import vocabulary


def test_nnls_meets_a_reachable_target():
    rng = np.random.default_rng(2)
    a = rng.random((20, 50))
    x = np.maximum(rng.normal(size=50), 0)
    assert np.linalg.norm(a @ packing.nnls(a, a @ x) - a @ x) < 1e-3
    assert (packing.nnls(a, -a @ x) == 0).all()


def test_combinations_fill_the_window():
    found = packing.combinations(12)
    assert len(found) == len(set(found)) and all(sum(c) == 12 and len(c) <= 3 for c in found)
    assert (12,) in found and (6, 6) in found and (4, 4, 4) in found and (10, 1, 1) in found


@pytest.mark.parametrize("lengths", [[], [5], [128] * 9, list(range(1, 129)) * 7, [70] * 50 + [58] * 20 + [1] * 5])
def test_plan_uses_each_piece_once(lengths):
    histogram = np.bincount(lengths, minlength=129)
    used = np.zeros(129, dtype=int)
    for combination, repeats in packing.plan(histogram):
        assert sum(combination) <= 128 and repeats > 0
        np.add.at(used, list(combination), repeats)
    assert (used == histogram).all()


def test_pack(spark):
    rows = [(i, "the quick brown fox, " * (i * 13 % 120)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 30_000), (3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, bin int")
    words = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_str(words)
    want = []
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids))
                 for s in range(0, len(ids), 2048)]
    got = packing.pack(df, words).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(held) == list(range(len(held)))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(w[2] for w in want) >= 0.97 * 2048 * (len(held) - 1)
    assert packing.pack(df.limit(0), words).count() == 0


def test_sequences_hold_the_ids(spark):
    rows = [(i, "some words to pack here " * (i % 50)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    words = vocabulary("word_bpe_49k.json")
    pieces = packing.pack(df, words).cache()
    library = Tokenizer.from_str(words)
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    want = {}
    for r in sorted(pieces.collect(), key=lambda r: r["offset"]):
        want.setdefault(r["sequence_id"], []).extend(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]])
    assert {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(df, pieces, words).collect()} == want
    pieces.unpersist()
