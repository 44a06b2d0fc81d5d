"""Exact round trips of the coder and of whole files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seriesloom.llm import token_files as tf
from seriesloom.llm.tokens import PieceTokenizer, read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n, lanes", [(0, 1), (1, 1), (5, 7), (1000, 1), (100_000, 64), (700_000, 1024)])
def test_coder(n, lanes):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 40_000).astype(np.int64)
    table = tf.Table.scaled(*np.unique(np.append(ids, 3), return_counts=True))
    state, words, marks = tf.encode(ids, table, lanes)
    assert (tf.decode(n, state, words, table) == ids).all()
    for step, place, at in marks:
        assert (tf.decode(n, at, words, table, step, place) == ids[step * lanes:]).all()
    assert n < 1000 or len(marks) == (-(-n // lanes) - 1) // tf.CHECK
    if n > 10_000:
        p = np.unique(ids, return_counts=True)[1] / n
        assert len(words) * 32 < 1.01 * n * -(p * np.log2(p)).sum() + 64 * lanes


def test_rare_and_many_symbols_keep_a_frequency():
    counts = np.ones(100_000, dtype=np.int64)
    counts[7] = 10**12
    table = tf.Table.scaled(np.arange(100_000), counts)
    assert table.freq.sum() == 1 << tf.SCALE and table.freq.min() == 1


def test_damage_is_found():
    table = tf.Table.scaled(np.arange(10), np.ones(10, dtype=np.int64))
    data = bytearray(tf.to_block([1], np.array([2000]), np.arange(2000) % 10, 0, table))
    assert (tf.Block.read(bytes(data)).ids(table) == np.arange(2000) % 10).all()
    data[-3] ^= 1
    with pytest.raises(ValueError):
        tf.Block.read(bytes(data))


ALPHABET = ["a", "b", "The", "ea,", "'s", " ", "  ", "\n", "\n\n", " \n", "\t", "é", "ñ", "1", "22", "...", "don't", "’",
            "\x1c", "\x85", "\xa0", " ", "᠎", "​", "é", "́", "Σ", "ΑΣ", "İ", "中文", "🙂",
            "<|endoftext|>", "<|startoftext|>", ",", "?!", ".", "ǅ", "ﬁ", "x" * 50]


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_give_the_library_s_ids(name, kind, monkeypatch):
    monkeypatch.setattr("seriesloom.llm.tokens.KEPT_PIECES", 300)  # emptied often
    vocabulary, rng = read_vocabulary(public_tokenizers.path(name)), random.Random(4)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    library = Tokenizer.from_str(vocabulary)
    library.encode_special_tokens = True
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert PieceTokenizer(vocabulary, kind).encode(texts) == want


def expected(rows):
    tokenizer = PieceTokenizer(read_vocabulary(PATH), "byte")
    coded = [(i, x + b"\0\0\0\0") for i, x in zip([r[0] for r in rows], tokenizer.encode([r[1] or "" for r in rows]))]
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), np.frombuffer(r[1], "<u4").astype("<u2").tobytes()))
    out, start = [], 0
    for i, x in coded:
        out.append((i, start, len(x) // 4, zlib.crc32(x)))
        start += len(x) // 4
    return out


def test_files(spark, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 3000)
    rng = random.Random(2)
    rows = [(i * 7 % 101, " ".join(rng.choices(["the", "of", "and", "zebra,", "é"], k=rng.choice([0, 1, 30, 400]))))
            for i in range(101)]
    rows += [(5, None), (5, ""), (None, "no id"), (300, "long " * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n int")
    got = tf.round_trip(df, read_vocabulary(PATH), range_docs=20).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)
    assert tf.round_trip(df.limit(0), read_vocabulary(PATH)).count() == 0


def test_letters_are_looked_up_by_code_point():
    """Words reach the model by one lookup per character; ids are the library's."""
    import public_tokenizers
    from seriesloom.llm import tokens

    made = tokens.PieceTokenizer(tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")), "byte")
    words = ["word", "Straße", "señorío", "слово", "言葉", "𝒳𝒴", "a" * 300]
    made.encode([" ".join(words)])
    assert made.letters[ord("é")] == "Ã©" and ord("ñ") in made.letters
    for text in [*words, *(f"x {w}" for w in words)]:
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_word_meets_the_model_once():
    """A new word is kept at its first sight, with any mark behind it."""
    made, asked = PieceTokenizer(read_vocabulary(PATH), "byte"), []
    real = made.tokenize
    made.tokenize = lambda text: asked.append(text) or real(text)
    for text in ("so zebrine, zebrine. (zebrine) so", "so zebrine*** zebrine", "zebrine% so zebrine!"):
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted({"so", "Ġso", "zebrine", "Ġzebrine"})


FILES = {"byte": "byte_bpe_50k", "word": "word_bpe_49k"}


@pytest.mark.parametrize("kind", FILES)
def test_texts_cut_together_keep_their_ids(kind, monkeypatch):
    """No cut is made beside white space of any width, nor across the texts of a slice."""
    monkeypatch.setattr("seriesloom.llm.tokens.SLICE", 50)
    made = PieceTokenizer(read_vocabulary(public_tokenizers.path(f"{FILES[kind]}.json")), kind)
    wide = ["\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "\u201c", "あ", "\0"]
    texts = [t for w in wide for t in (w, f"a{w}", f"{w} b", f"a {w}b", f"a{w} b.c'd", f"a {w}", f" {w}\n{w}x\ny ", "", "a\nb", "\n")]
    want = [e.ids for e in made.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == want
    assert made.encode([]) == [] and made.encode(["", ""]) == [b"", b""]


def test_a_full_table_keeps_the_most_used(monkeypatch):
    monkeypatch.setattr("seriesloom.llm.tokens.KEPT_PIECES", 8)
    made = PieceTokenizer(read_vocabulary(PATH), "byte")
    for text in (" the" * 9 + " of" * 8, " a b c d e f g", " " + "x" * 50):
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids
    assert made.known.to_pylist() == [" the", " of", " f", " g"]
    assert made.sizes.sum() == len(made.ids) and len(made.uses) == 4
