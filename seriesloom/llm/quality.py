"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pair sum is taken in
linear time as half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features are the words, lower-cased and hashed to `2 ** BITS` (counts scaled to length
one), statistics of the text (`STATISTICS`) and metadata columns of the row, by
default its character count; language, source and id are never looked at.
Fitting takes a bounded sample: about `per_label` labelled rows of each label outside
the held-out fold; the driver gets their hashed features, no text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.columns import q

from .common import text_slices
from .toxicity import held_out, labelled_sample
from .words import word_hashes

BITS = 15
FACTORS = 6
METADATA = ("n_chars",)
STATISTICS = ("words", "distinct share", "characters a word", "words a line", "letters", "upper case", "digits",
              "sentence marks", "symbols", "symbols a word")
_KIND = np.full(256, 4, dtype=np.int64)  # 0 space, 1 lower or non-ASCII letter, 2 upper, 3 digit, 4 symbol, 5 mark
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123], _KIND[128:], _KIND[65:91], _KIND[48:58] = 1, 1, 2, 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5


def _statistics(texts: list[str], owner: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(STATISTICS)))
    words = np.bincount(owner, minlength=len(texts))
    for i, text in enumerate(texts):
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kinds = np.bincount(_KIND[data], minlength=6)[:6]
        lines = 1 + np.count_nonzero(data == 10)
        size, n = max(len(data), 1), max(words[i], 1)
        out[i] = (np.log1p(words[i]), distinct[i] / n, np.log1p(len(data) / n), np.log1p(words[i] / lines),
                  (kinds[1] + kinds[2]) / size, kinds[2] / size, kinds[3] / size, kinds[5] / n, kinds[4] / size,
                  min(kinds[4] / n, 4.0))
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, word number, value) of the words and the matrix of statistics."""
    owner, word = word_hashes(texts)
    pair, count = np.unique((owner << BITS) | (word >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    row, col = pair >> BITS, pair & ((1 << BITS) - 1)
    norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, minlength=len(texts)))
    return row, col, count / norm[row], _statistics(texts, owner, np.bincount(row, minlength=len(texts)))


class Machine:
    """Weights over words (first) and dense columns (last), and how dense columns are scaled."""

    def __init__(self, dense: int, seed: int = 9):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.size = (1 << BITS) + dense
        self.w, self.b = np.zeros(self.size), 0.0
        self.v = rng.normal(0, 0.02, (self.size, FACTORS))
        self.middle, self.spread = np.zeros(dense), np.ones(dense)

    def joined(self, row, col, value, dense):
        """One sparse list of words and scaled dense columns; a missing value is the mean."""
        scaled = np.nan_to_num(np.clip((dense - self.middle) / self.spread, -4, 4))
        n, k = scaled.shape
        return (np.concatenate([row, np.repeat(np.arange(n), k)]),
                np.concatenate([col, np.tile(np.arange(k) + (1 << BITS), n)]),
                np.concatenate([value, scaled.ravel()]))

    def raw(self, row, col, value, n):
        """(z, sums per factor) of n texts in time linear in the features."""
        z = self.b + np.bincount(row, self.w[col] * value, minlength=n)
        sums = np.empty((n, FACTORS))
        for f in range(FACTORS):
            part = self.v[col, f] * value
            sums[:, f] = np.bincount(row, part, minlength=n)
            z += 0.5 * (sums[:, f] ** 2 - np.bincount(row, part * part, minlength=n))
        return z, sums

    def fit(self, row, col, value, dense, labels, rounds: int = 80, rate: float = 0.05, l2: float = 1e-4):
        with np.errstate(invalid="ignore"):
            self.middle = np.nan_to_num(np.nanmean(dense, axis=0)) if len(dense) else self.middle
            self.spread = np.maximum(np.nan_to_num(np.nanstd(dense, axis=0)), 1e-6) if len(dense) else self.spread
        row, col, value = self.joined(row, col, value, dense)
        n, good = len(labels), labels.astype(bool)
        weight = np.where(good, 0.5 / good.sum(), 0.5 / (~good).sum())
        names, local = np.unique(col, return_inverse=True)
        moments = None
        for t in range(1, rounds + 1):
            z, sums = self.raw(row, col, value, n)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) * weight
            pull = error[row] * value
            grad = np.empty((len(names), FACTORS + 1))
            grad[:, 0] = np.bincount(local, pull, minlength=len(names)) + l2 * self.w[names]
            square = np.bincount(local, pull * value, minlength=len(names))
            for f in range(FACTORS):
                grad[:, f + 1] = (np.bincount(local, pull * sums[row, f], minlength=len(names))
                                  - square * self.v[names, f] + l2 * self.v[names, f])
            if moments is None:
                moments = [np.zeros_like(grad), np.zeros_like(grad), 0.0, 0.0]
            bias = error.sum()
            moments = [0.9 * moments[0] + 0.1 * grad, 0.99 * moments[1] + 0.01 * grad**2,
                       0.9 * moments[2] + 0.1 * bias, 0.99 * moments[3] + 0.01 * bias**2]
            step = rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
            self.w[names] -= step[:, 0]
            self.v[names] -= 0.3 * step[:, 1:]
            self.b -= rate * (moments[2] / (1 - 0.9**t)) / (np.sqrt(moments[3] / (1 - 0.99**t)) + 1e-8)
        return self

    def score(self, texts: list[str], metadata: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for a, b in text_slices(texts):
            row, col, value, dense = features(texts[a:b])
            z, _ = self.raw(*self.joined(row, col, value, np.hstack([dense, metadata[a:b]])), b - a)
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(out)


def _metadata(frame: pd.DataFrame, n: int) -> np.ndarray:
    columns = [np.log1p(np.maximum(frame[f"m{i}"].to_numpy(dtype=float, na_value=np.nan), 0)) for i in range(n)]
    return np.column_stack(columns) if n else np.zeros((len(frame), 0))


def _with_metadata(docs: DataFrame, id_col: str, text_col: str, columns) -> DataFrame:
    return docs.select(F.col(q(id_col)).alias("id"), F.coalesce(F.col(q(text_col)), F.lit("")).alias("text"),
                       *[F.col(q(c)).cast("double").alias(f"m{i}") for i, c in enumerate(columns)])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = 2000,
          id_col: str = "doc_id", text_col: str = "text", metadata=METADATA) -> Machine:
    """Fit on a bounded sample. With one label alone, or none, every score is its share (1 without rows)."""
    drawn = labelled_sample(labels, label, per_label, id_col)
    sample = _with_metadata(docs, id_col, text_col, metadata).join(F.broadcast(drawn), "id")
    n_meta = len(metadata)

    def made(batches):
        for whole, (a, b) in ((f, s) for f in batches for s in text_slices(f["text"].tolist())):
            frame = whole.iloc[a:b]
            row, col, value, dense = features(frame["text"].tolist())
            ends = np.searchsorted(row, np.arange(len(frame) + 1))
            dense = np.hstack([dense, _metadata(frame, n_meta)])
            yield pd.DataFrame({
                "label": frame["label"].astype("int32").to_numpy(),
                "cols": [col[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])],
                "vals": [value[a:b].astype("<f4").tobytes() for a, b in zip(ends, ends[1:])],
                "dense": [d.astype("<f8").tobytes() for d in dense]})

    rows = sample.mapInPandas(made, "label int, cols binary, vals binary, dense binary").collect()
    rows.sort(key=lambda r: (r["dense"], r["cols"], r["vals"]))
    machine = Machine(len(STATISTICS) + n_meta)
    y = np.array([r["label"] for r in rows])
    if len(set(y.tolist())) < 2:
        machine.v[:], machine.b = 0, 6.0 * (2 * y[0] - 1) if len(y) else 6.0
        return machine
    cols = [np.frombuffer(r["cols"], "<i4").astype(np.int64) for r in rows]
    return machine.fit(np.repeat(np.arange(len(rows)), [len(c) for c in cols]), np.concatenate(cols),
                       np.concatenate([np.frombuffer(r["vals"], "<f4").astype(float) for r in rows]),
                       np.stack([np.frombuffer(r["dense"], "<f8") for r in rows]), y)


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text", metadata=METADATA) -> DataFrame:
    """Per row: the id, `held_out`, `score` (0 to 1), `predicted`.

    Null counts as empty, a missing metadata value as the mean of the sample. Rows that
    repeat an id are scored one by one. Whole texts are read.
    """
    texts = _with_metadata(docs, id_col, text_col, metadata)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 2 ** BITS rows of 7 numbers
    n_meta = len(metadata)

    def scored(batches):
        for frame in batches:
            yield pd.DataFrame({"id": frame["id"],
                                "score": shared.value.score(frame["text"].tolist(), _metadata(frame, n_meta))})

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInPandas(scored, f"id {kind}, score double").select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, machine: Machine, threshold: float = 0.3, text_col: str = "text",
             metadata=METADATA) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, all columns kept, in one pass without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    n_meta = len(metadata)

    @F.pandas_udf("double")
    def rated(text: pd.Series, numbers: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.score([t or "" for t in text], _metadata(numbers, n_meta)))

    numbers = F.struct(F.lit(0.0).alias("none"), *[F.col(q(c)).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)])
    return docs.where(rated(F.col(q(text_col)), numbers) >= threshold)
