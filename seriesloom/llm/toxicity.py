"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character n-grams (3 to 5 code points, lower-cased,
white space runs as one space), hashed to `2 ** BITS` numbers. Each is scaled by
its log-count ratio r = log((p + a) / |p|) - log((q + a) / |q|), p and q being the texts
of either label that hold it; a logistic regression is fitted on the scaled features.
As r is the same for every text, the fitted weight and r become one table of numbers,
which the scoring pass looks up.

Fitting takes a bounded sample of labelled rows: about `per_label` of each label. Their
features are made on the executors; the driver gets hashed features, no text.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked

BITS = 20
SIZES = (3, 4, 5)
CHUNK = 1 << 20  # code points looked at together
_SPACES = re.compile("[\t-\r ]+")


def _chunks(texts: list[str]):
    """(text numbers, code points) of about CHUNK code points; long texts come in overlapping parts."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        text = f" {_SPACES.sub(' ', text.lower()).strip(' ')} "
        for start in range(0, max(1, len(text) - max(SIZES) + 1), CHUNK):
            part = text[start:start + CHUNK + max(SIZES) - 1]
            if held and held + len(part) > CHUNK:
                yield owners, parts
                owners, parts, held = [], [], 0
            owners.append(i)
            parts.append(part)
            held += len(part)
    if parts:
        yield owners, parts


def features(texts: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed n-gram), each pair once, in order. `keep`: only features marked there."""
    found = [np.zeros(0, np.int64)]
    for owners, parts in _chunks(texts):
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        piece = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        names = np.array(owners, dtype=np.int64)
        rolled = np.zeros(len(chars), dtype=np.uint64)
        for k in range(max(SIZES)):
            n = len(chars) - k
            if n <= 0:
                break
            rolled = rolled[:n] * np.uint64(0x100000001B3) + chars[k:] + np.uint64(1)
            if k + 1 in SIZES:
                feature = ((rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
                at = np.flatnonzero(keep[feature]) if keep is not None else np.arange(n)
                at = at[piece[at] == piece[at + k]]
                found.append((names[piece[at]] << BITS) | feature[at])
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(rows: list[np.ndarray], labels: np.ndarray, least: float = 0.01) -> tuple[np.ndarray, float]:
    """(number of each feature, bias); rows hold feature numbers. Fitted twice: features that
    end below `least` are left out of the second fit, so most of a text need not be looked up."""
    size = 1 << BITS
    bad = labels.astype(bool)
    p, q = np.ones(size), np.ones(size)
    for held, features_of in zip(bad, rows):
        (p if held else q)[features_of] += 1  # a text holds a feature once
    ratio = np.log(p / (bad.sum() + 2)) - np.log(q / ((~bad).sum() + 2))
    telling = (np.abs(ratio) > 0.5) & (p + q >= 2 + 3)  # held by three texts at least
    rows = [r[telling[r]] for r in rows]
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int32)])
    first, _ = _logistic(row, col, np.where(telling, ratio, 0.0), bad)
    return _logistic(row, col, np.where(np.abs(first) > least, ratio, 0.0), bad)


def _logistic(row, col, ratio, bad, l2: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Balanced logistic regression on the features of non-zero ratio, scaled by it (Adam)."""
    used, n = ratio[col] != 0, len(bad)
    row, col = row[used], col[used]
    names = np.flatnonzero(np.bincount(col, minlength=len(ratio)))
    number = np.zeros(len(ratio), dtype=np.int32)
    number[names] = np.arange(len(names))
    local = number[col]
    values = ratio[names].astype(np.float32)[local]
    y = bad.astype(float)
    weight = np.where(bad, 0.5 / max(y.sum(), 1), 0.5 / max(n - y.sum(), 1))
    w = np.zeros(len(names) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, values * w[:-1][local], minlength=n) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.append(np.bincount(local, values * error[row], minlength=len(names)) + l2 * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    table = np.zeros(len(ratio))
    table[names] = w[:-1] * ratio[names]
    return table, float(w[-1])


def _per_text(texts: list[str], keep: np.ndarray | None = None) -> list[np.ndarray]:
    owner, feature = features(texts, keep)
    return np.split(feature, np.searchsorted(owner, np.arange(1, len(texts)))) if texts else []


def labelled_sample(labels: DataFrame, label: str, per_label: int, id_col: str = "doc_id") -> DataFrame:
    """(`id`, `label`) of about `per_label` ids of each label (all, if fewer), drawn by a hash of the
    id: few enough to broadcast, whatever the corpus holds.

    Rows with crc32(id as text) mod 5 = 0 are held out and never drawn.
    """
    own = picked(labels, id=id_col, label=label).where(
        "label in (0, 1) and id is not null and crc32(cast(id as string)) % 5 != 0")
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, F.lit(per_label / max(counts.get(1, 0), 1))).otherwise(
        F.lit(per_label / max(counts.get(0, 0), 1)))
    return own.where(F.pmod(F.xxhash64("id", F.lit(label)), F.lit(1 << 30)) < share * (1 << 30)).groupBy("id").agg(
        F.max("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = 1500,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Fit on a bounded sample: about `per_label` rows of each label outside the held-out fold.

    Without any labelled row, or with one label alone, every score is the share of label 1
    (one half without rows).
    """
    def made(batches):
        for frame in batches:
            own = _per_text(frame["text"].tolist())
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"].astype("int32"),
                                "features": [r.astype("<i4").tobytes() for r in own]})

    drawn = labelled_sample(labels, label, per_label, id_col)
    sample = picked(docs, id=id_col, text=text_col).join(F.broadcast(drawn), "id").select(
        "id", F.coalesce("text", F.lit("")).alias("text"), "label")
    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.mapInPandas(made, f"id {kind}, label int, features binary").collect()
    rows.sort(key=lambda r: (r["id"], r["features"]))
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(set(y)) < 2:
        return np.zeros(1 << BITS), 0.0 if not len(y) else 6.0 * (2 * y[0] - 1)
    return fit([np.frombuffer(r["features"], "<i4") for r in rows], y)


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, `held_out`, `score` (0 to 1), `predicted`.

    Null counts as empty; an empty text has the score of the bias. Rows that repeat an id
    are scored one by one. Whole texts are read; other columns are not looked at.
    """
    table, bias = model
    names = np.flatnonzero(table)
    shared = docs.sparkSession.sparkContext.broadcast((names, table[names], bias))  # at most 2 ** BITS numbers

    def scored(batches):
        names, weights, bias = shared.value
        own = np.zeros(1 << BITS)
        own[names] = weights
        keep = own != 0
        for frame in batches:
            owner, feature = features(frame["text"].tolist(), keep)
            z = np.bincount(owner, own[feature], minlength=len(frame)) + bias
            yield pd.DataFrame({"id": frame["id"], "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))})

    texts = picked(docs, id=id_col, text=text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    found = texts.mapInPandas(scored, f"id {kind}, score double")
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(column: str):
    """Whether a row belongs to the fold that is never learned from (a null id: yes)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))
