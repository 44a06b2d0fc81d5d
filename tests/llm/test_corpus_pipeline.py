"""Every stage of the pipeline against brute force on what its predecessor kept."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from seriesloom.llm import mixing, quality
from seriesloom.llm.queries import vocabulary
from seriesloom.session import durable

from .test_ngram_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(durable(stage(spark, out[-1], SF)))
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_quality_keeps_what_it_scores_high_enough(spark, kept):
    machine = quality.train(kept[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {r["doc_id"]: r["predicted"] for r in quality.score(kept[0], machine).collect()}
    assert {r["doc_id"] for r in rows(kept[1])} == {i for i, p in scored.items() if p}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [i for i in labels if i in scored and scored[i] != labels[i]]
    assert len(wrong) <= 0.05 * len(labels)
    assert kept[1].columns == kept[0].columns


def test_exact_copies_go(kept):
    last = {}
    for r in rows(kept[1]):
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows(kept[2])) == sorted(last.values())
    assert {tuple(r.values()) for r in rows(kept[2])} <= {tuple(r.values()) for r in rows(kept[1])}


def test_one_of_each_near_group_stays(kept):
    heads = [i for i, _, c in brute([(r["doc_id"], r["text"]) for r in rows(kept[2])]) if i == c]
    assert sorted(r["doc_id"] for r in rows(kept[3])) == heads
    assert kept[3].columns == kept[0].columns


def test_sources_come_near_their_targets(kept):
    given = {r["doc_id"]: r for r in rows(kept[3])}
    size = {i: len(r["text"].encode().split()) for i, r in given.items()}
    names = sorted({r["source"] for r in given.values()})
    totals = [sum(size[i] for i, r in given.items() if r["source"] == s) for s in names]
    target = dict(zip(names, mixing.targets(totals, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])))
    taken, of_doc = dict.fromkeys(names, 0), dict.fromkeys(given, 0)
    for r in rows(kept[4]):
        words = r["text"].encode().split()
        taken[r["source"]] += len(words)
        of_doc[r["doc_id"]] += len(words)
        assert r["source"] == given[r["doc_id"]]["source"] and r["n_chars"] == len(r["text"])
        own = given[r["doc_id"]]["text"].encode().split()
        assert set(words) <= set(own)
    assert all(n <= 3 * size[i] for i, n in of_doc.items())
    for s in names:
        assert abs(taken[s] - target[s]) <= 2 * 128 + 0.02 * target[s]
    assert kept[4].columns == kept[0].columns


def test_packing_holds_every_id_once(kept):
    library = Tokenizer.from_str(vocabulary("word_bpe_49k.json"))
    library.encode_special_tokens = True
    want = {}
    for r in rows(kept[4]):
        ids = np.array(library.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start:start + 2048]
            key = (r["doc_id"], start, len(part), zlib.crc32(part.tobytes()), len(ids))
            want[key] = want.get(key, 0) + 1
    got, sequences = {}, {}
    for r in rows(kept[5]):
        key = (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(k[2] * n for k, n in got.items()) >= 0.95 * 2048 * len(sequences)


def test_run_is_the_stages(spark, kept):
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, kept[5].collect()))
