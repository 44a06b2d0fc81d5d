"""Token ids of whole texts, by a public tokenizer file, fast enough for a corpus.

Words repeat, so ids are kept per word. A text may be cut without changing its ids
wherever the tokenizer's own split ends a word anyway:

* "byte" files (byte-level, a word takes the one space before it): before a single
  space, and on both sides of a single line feed, with no white space on either side;
* "word" files (white space is dropped): at every space and line feed;
* in both, between an ASCII letter and an ASCII punctuation mark, and between a run of
  letters and one final `,` `.` `;` `:` `!` or `?`.

The bytes of many texts are cut together, as array operations, and Arrow numbers the
different pieces. Each piece that is new to a task goes through the tokenizers library, a
run of letters straight to its model. Short pieces are kept, with a bound: when the table
of pieces is full, the half that was used most stays; no result changes.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_slices

#: Pieces kept, and the most bytes of a piece worth keeping.
KEPT_PIECES, KEPT_LENGTH = 350_000, 40
SLICE = 3_000_000  # characters cut together
_FINAL = frozenset(",.;:!?")
_WHITE, _LETTER, _MARK, _LEAD = 1, 2, 3, 4
_ASCII = [chr(b) for b in range(128)]
_WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0")) for c in range(128, 0x10000)
                  if chr(c).isspace()])  # white space of two or three bytes
#: What a byte of UTF-8 is: a lead byte may begin white space.
_KINDS = np.array([_WHITE if c.isspace() else _LETTER if c.isalpha() else
                   _MARK if c.isprintable() and not c.isdigit() else 0 for c in _ASCII] + [0] * 128, dtype=np.uint8)
_KINDS[np.unique(_WIDE >> 16)] = _LEAD


def read_vocabulary(path: str) -> str:
    """The tokenizer file's text; a few MB at most, so tasks get it with their function."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Letters(dict):
    """The byte-level alphabet by code point, for `str.translate`: the letters of its UTF-8 bytes."""

    def __init__(self):
        # Printable bytes stand for themselves, the others follow from 256 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.of_byte = [others.get(b, chr(b)) for b in range(256)]

    def __missing__(self, point: int) -> str:
        found = self[point] = "".join(self.of_byte[b] for b in chr(point).encode())
        return found


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte of `data` is; every byte of a white space character counts as white."""
    kinds = _KINDS[data]
    lead = np.flatnonzero(kinds == _LEAD)
    if len(lead):
        three, long = np.append(data, np.zeros(2, np.uint8)).astype(np.int64), data[lead] >= 0xE0
        found = (three[lead] << 16) | (three[lead + 1] << 8) | np.where(long, three[lead + 2], 0)
        white = np.isin(found, _WIDE)
        kinds[lead[white]] = kinds[lead[white] + 1] = _WHITE
        kinds[lead[white & long] + 2] = _WHITE
    return kinds


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[0], start[0] + 1, ... of `size[0]` values, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class PieceTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes. A piece holds the space before it."""

    def __init__(self, vocabulary: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        if kind not in ("byte", "word"):
            raise ValueError(f"kind is byte or word, not {kind!r}")
        self.kind, self.model = kind, self.tokenizer.model
        # a token that was added and is no special one may hold any characters
        self.marks = all(t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known = pa.array([], pa.string())
        self.uses, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.normal = self.tokenizer.normalizer.normalize_str if kind == "word" else None
        self.letters, self.tokenize = _Letters(), self.model.tokenize
        self.finals = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in _FINAL}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids for a, b in text_slices(texts, SLICE) for ids in self._encode(texts[a:b])]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.kind == "word":
            texts = [self._lowered(t) for t in texts]
        parts = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(parts), np.uint8)
        if not len(data):
            return [b""] * len(texts)
        begin = np.cumsum([0, *map(len, parts)])
        cuts = self._cuts(data, begin)
        pieces = pa.Array.from_buffers(pa.string(), len(cuts) - 1,
                                       [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
        ids, sizes = self._ids(pieces)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(cuts, begin)] * 4
        coded = ids.astype("<u4").tobytes()
        return [coded[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    @staticmethod
    def _lowered(text: str) -> str:
        # the tokenizer lower-cases as well; a capital sigma's form hangs on its place,
        # a dotted capital i becomes two characters
        text = text if "\u03a3" in text or "\u0130" in text else text.lower()
        return text.replace("\n", " ")

    def _cuts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where pieces begin, and the end; `begin` has the same of the texts."""
        kinds, cut = _kinds(data), np.zeros(len(data) + 1, dtype=bool)
        if self.marks:
            cut[1:-1] = (kinds[:-1] == _LETTER) & (kinds[1:] == _MARK)
        if self.kind == "word":
            cut[:-1] |= data == 32
        else:
            edge, white = np.zeros(len(data) + 1, dtype=bool), kinds == _WHITE
            edge[begin] = True
            at = np.flatnonzero((data == 32) | (data == 10))
            at = at[~(edge[at] | edge[at + 1])]
            at = at[~(white[at - 1] | white[at + 1])]
            cut[at] = True
            cut[at[data[at] == 10] + 1] = True
        cut[begin] = True
        return np.flatnonzero(cut)

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        coded = pieces.dictionary_encode()
        number, names = coded.indices.to_numpy(), coded.dictionary
        at = pc.index_in(self.known, value_set=names).fill_null(-1).to_numpy()
        held = np.flatnonzero(at >= 0)
        place = np.full(len(names), -1)
        place[at[held]] = held
        fresh = np.flatnonzero(place < 0)
        place[fresh] = len(self.known) + np.arange(len(fresh))
        new = names.take(pa.array(fresh))
        made = self._make(new.to_numpy(zero_copy_only=False).tolist())
        sizes = np.concatenate([self.sizes, np.fromiter(map(len, made), np.int64, len(made))])
        ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.uint32)])
        start, own = np.cumsum(sizes) - sizes, place[number]
        self.uses = np.append(self.uses, np.zeros(len(made), np.int64))
        self.uses[place] += np.bincount(number, minlength=len(names))
        if made:
            self._keep(pa.concat_arrays([self.known, new]), start, sizes, ids)
        return ids[_spans(start[own], sizes[own])], sizes[own]

    def _keep(self, names: pa.Array, start: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        stay = np.flatnonzero(pc.binary_length(names).to_numpy() <= KEPT_LENGTH)
        if len(stay) > KEPT_PIECES:
            most = np.argsort(self.uses[stay], kind="stable")[-(KEPT_PIECES // 2):]  # of equals, the newest
            stay, self.uses = stay[np.sort(most)], self.uses // 2
        self.known, self.uses, self.sizes = names.take(pa.array(stay)), self.uses[stay], sizes[stay]
        self.ids = ids[_spans(start[stay], sizes[stay])]

    def _make(self, pieces: list[str]) -> list[list[int]]:
        made, heads, mixed, finals = [], {}, [], self.finals
        for p in pieces:
            if letters := self._letters(p):
                made.append(self._word(letters))
            elif p[-1] in _FINAL and (letters := self._letters(head := p[:-1])):
                if head not in heads:
                    heads[head] = self._word(letters)
                made.append(heads[head] + finals[p[-1]])
            else:
                mixed.append(len(made))
                made.append([])
        if mixed:
            for i, e in zip(mixed, self.tokenizer.encode_batch([pieces[i] for i in mixed], add_special_tokens=False)):
                made[i] = e.ids
        return made

    def _letters(self, piece: str) -> str | None:
        """What the model gets of a piece, if that is a run of letters."""
        spaced = piece[:1] == " "
        text = piece[1:] if spaced else piece
        if not text.isalpha():
            return None
        if self.normal and not text.isascii():
            text = self.normal(text)
            if not text.isalpha():
                return None
        elif self.normal:
            text = text.lower()
        return " " + text if spaced and self.kind == "byte" else text

    def _word(self, text: str) -> list[int]:
        """Ids of one run of letters: the library's model without its splitting."""
        if not text.isascii():
            text = text.translate(self.letters)
        elif text[0] == " ":
            text = self.letters.of_byte[32] + text[1:]
        return [t.id for t in self.tokenize(text)]


_ready: dict = {}


def shared_tokenizer(vocabulary: str, kind: str) -> PieceTokenizer:
    """One tokenizer per Python worker, so that its pieces serve the worker's later tasks."""
    key = (kind, hash(vocabulary))
    if key not in _ready:
        _ready.clear()
        _ready[key] = PieceTokenizer(vocabulary, kind)
    return _ready[key]


def release() -> None:
    """Give the shared tokenizer's pieces back; the next task that needs them starts anew."""
    _ready.clear()
