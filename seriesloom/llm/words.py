"""Word hashes of many texts at once.

A word is a run of bytes other than ASCII white space, lower-cased in A-Z. Its hash is
a polynomial in 64-bit arithmetic over a random number per byte value, taken from
prefix sums, so the work is a few array operations per byte and none per word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .tokens import release

CHUNK = 1 << 19  # bytes looked at together
_BASE = 0x9E3779B97F4A7C13  # odd, 3 mod 8
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK + 1
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, dtype=np.uint64))])
                     for b in (_BASE, inverse))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_chunk(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words in at most CHUNK bytes."""
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = ~_IS_SPACE[codes]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers()
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[codes] * up[:len(codes)], out=sums[1:])
    return start, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word of every text, in order. None counts as empty."""
    release()  # a worker that counted pieces before needs their memory now
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    names, parts, held = [], [], 0

    def flush():
        nonlocal names, parts, held
        if parts:
            ends = np.cumsum([len(p) + 1 for p in parts])
            start, found = _hash_chunk(b" ".join(parts))
            owners.append(np.array(names, np.int64)[np.searchsorted(ends, start, side="right")])
            hashes.append(found)
        names, parts, held = [], [], 0

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        while True:
            part = data
            if len(data) > CHUNK - 1:  # cut at white space
                cut = max(data.rfind(c, 0, CHUNK - 1) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                if cut <= 0:
                    part = None
                else:
                    part, data = data[:cut], data[cut:]
            if part is None:  # a word longer than a chunk
                flush()
                owner, found = _long_word(i, data)
                owners.append(owner)
                hashes.append(found)
                break
            if held + len(part) + 1 > CHUNK:
                flush()
            names.append(i)
            parts.append(part)
            held += len(part) + 1
            if part is data:
                break
    flush()
    return np.concatenate(owners), np.concatenate(hashes)


def _long_word(i: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text that holds one longer than a chunk."""
    import xxhash

    short, order = [], []
    for word in data.split():
        if len(word) < CHUNK - 1:
            short.append(word)
            order.append(None)
        else:
            order.append(xxhash.xxh64_intdigest(word))
    plain = iter([h for s in range(0, len(short), 1) for h in _hash_chunk(short[s])[1]])
    found = np.array([next(plain) if o is None else o for o in order], dtype=np.uint64)
    return np.full(len(found), i, np.int64), found
