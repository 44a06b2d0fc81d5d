"""Packing token pieces into sequences: shallow combinations chosen by non-negative least squares.

1. A document's ids are cut every `window` ids; the rest is its last piece. Lengths
   count in grains (`window / GRAINS` ids, rounded up), so the histogram has 128 bins
   whatever the corpus holds. It is the only thing the driver sees.
2. All combinations of up to three lengths that fill a window exactly are enumerated;
   non-negative least squares gives how often to repeat each so that the histogram is
   met. Repeats are rounded down to what is there.
3. The rest of the histogram is packed greedily: the longest length left, then again
   and again the longest that fits, repeated while its lengths last.
4. The plan is a small table of rank intervals per bin. Each piece takes its rank in
   its bin (ranks are counted in slices of a bin, about as many as rows in a slice)
   and finds its sequence and place there.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import durable

from .common import picked
from .tokens import shared_tokenizer

GRAINS = 128


def combinations(full: int = GRAINS) -> list[tuple[int, ...]]:
    """Up to three lengths, longest first, that sum to `full`."""
    out = [(full,)]
    for a in range(full - 1, 0, -1):
        if a >= full - a:
            out.append((a, full - a))
        for b in range(min(a, full - a - 1), 0, -1):
            c = full - a - b
            if c <= b:
                out.append((a, b, c))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """min |a x - b| over x >= 0, by adding and removing columns (active sets)."""
    n = a.shape[1]
    x, on = np.zeros(n), np.zeros(n, dtype=bool)
    gram, rhs = a.T @ a, a.T @ b
    tolerance = 1e-5 * max(1.0, np.abs(rhs).max(initial=0))
    for _ in range(rounds):
        gradient = np.where(on, -np.inf, rhs - gram @ x)
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        on[best] = True
        while True:
            use = np.flatnonzero(on)
            solved = np.linalg.solve(gram[np.ix_(use, use)] + 1e-9 * np.eye(len(use)), rhs[use])
            if (solved > 0).all():
                x[:] = 0
                x[use] = solved
                break
            low = solved <= 0
            step = np.min(x[use][low] / np.maximum(x[use][low] - solved[low], 1e-300))
            x[use] += step * (solved - x[use])
            on[use[low & (x[use] <= 1e-9 * (1 + x.max()))]] = False
            x[~on] = 0
            if not on.any():
                break
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of `histogram` (index = length in grains) once."""
    left = histogram.astype(np.int64).copy()
    out = []

    def use(lengths, repeats):
        if repeats > 0:
            out.append((tuple(lengths), int(repeats)))
            np.subtract.at(left, np.array(lengths), int(repeats))

    def most(lengths):
        kinds, times = np.unique(lengths, return_counts=True)
        return int((left[kinds] // times).min())

    shallow = combinations(len(left) - 1)
    matrix = np.zeros((len(left), len(shallow)))
    for j, lengths in enumerate(shallow):
        np.add.at(matrix[:, j], np.array(lengths), 1)
    total = left.sum()
    if total:
        for j in np.argsort(-(solved := nnls(matrix, left / total) * total), kind="stable"):
            use(shallow[j], min(math.floor(solved[j] + 1e-6), most(shallow[j])))
    while left.any():
        lengths, space, spare = [], len(left) - 1, left.copy()
        while True:
            fits = np.flatnonzero(spare[1:space + 1])
            if not len(fits):
                break
            lengths.append(int(fits[-1]) + 1)
            space -= lengths[-1]
            spare[lengths[-1]] -= 1
        use(lengths, most(lengths))
    return out


def _pieces(batches, vocabulary, kind: str, end_id: int, window: int):
    encoder = shared_tokenizer(vocabulary.value, kind)
    end = np.array([end_id], dtype="<u4").tobytes()
    for frame in batches:
        rows = []
        for name, ids in zip(frame["id"], encoder.encode(frame["text"].tolist())):
            ids += end
            n = len(ids) // 4
            for start in range(0, n, window):
                part = ids[4 * start:4 * (start + window)]
                rows.append((name, start, len(part) // 4, zlib.crc32(part), n))
        yield pd.DataFrame(rows, columns=["id", "start", "length", "crc", "doc_tokens"]).astype(
            {"id": frame["id"].dtype})


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = 2048, end_id: int = 1, kind: str = "word") -> DataFrame:
    """Per piece: the id, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`.

    `vocabulary` is the tokenizer file's text. A null or empty text is the end id alone.
    Rows that repeat an id are packed as documents of their own; so are rows without an
    id. Sequences take numbers from 0; an empty table gives no piece. Ranks follow
    (id, start, crc, length), so a rerun gives the same packing.
    """
    grain = -(-window // GRAINS)
    full = -(-window // grain)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    kind_of_id = picked(docs, id=id_col).schema["id"].dataType.simpleString()
    cut = durable(picked(docs, id=id_col, text=text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
                  .mapInPandas(lambda b: _pieces(b, shared, kind, end_id, window),
                               f"id {kind_of_id}, start bigint, length bigint, crc bigint, doc_tokens bigint")
                  .withColumn("bin", F.ceil(F.col("length") / grain).cast("int")))
    counts = {r["bin"]: r["count"] for r in cut.groupBy("bin").count().collect()}
    histogram = np.array([counts.get(i, 0) for i in range(full + 1)])
    chosen: dict[int, list] = {b: [] for b in counts}
    used, sequence = dict.fromkeys(counts, 0), 0
    for lengths, repeats in plan(histogram):
        for place, b in enumerate(lengths):
            chosen[b].append((used[b] + repeats, sequence - used[b], place))
            used[b] += repeats
        sequence += repeats
    table = spark.createDataFrame(
        [(b, math.isqrt(n) + 1, chosen[b]) for b, n in counts.items()],
        "bin int, slices int, plan array<struct<end: bigint, shift: bigint, place: int>>")
    order = ["id", "start", "crc", "length"]
    parted = cut.join(F.broadcast(table.select("bin", "slices")), "bin").withColumn(
        "slice", F.pmod(F.xxhash64(*order), F.col("slices")))
    before = W.partitionBy("bin").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    heads = parted.groupBy("bin", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        "bin", "slice", (F.sum("n").over(before) - F.col("n")).alias("base"))
    ranked = parted.withColumn("_in", F.row_number().over(W.partitionBy("bin", "slice").orderBy(*order))).join(
        heads, ["bin", "slice"]).withColumn("rank", F.col("base") + F.col("_in") - 1)
    at = F.element_at("plan", F.size(F.filter("plan", lambda p: p["end"] <= F.col("rank"))) + 1)
    placed = ranked.join(F.broadcast(table.select("bin", "plan")), "bin").withColumn("_at", at).select(
        "id", "start", "length", "crc", "doc_tokens", F.col("_at.place").alias("place"),
        (F.col("rank") + F.col("_at.shift")).alias("sequence_id"))
    upto = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    return placed.select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
        "sequence_id", (F.sum("length").over(upto) - F.col("length")).alias("offset"))


def sequences(docs: DataFrame, pieces: DataFrame, vocabulary: str, id_col: str = "doc_id",
              text_col: str = "text", end_id: int = 1, kind: str = "word") -> DataFrame:
    """The packed ids: `sequence_id`, `ids` in order of offset, unpadded. Ids must be unique."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    parts = pieces.groupBy(id_col).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("_parts"))
    joined = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(parts, id_col).select(
        "_text", "_parts")

    def cut(batches):
        encoder = shared_tokenizer(shared.value, kind)
        for frame in batches:
            rows = []
            for ids, own in zip(encoder.encode(frame["_text"].tolist()), frame["_parts"]):
                ids = np.append(np.frombuffer(ids, "<u4"), end_id).astype(np.int64)
                rows += [(p["sequence_id"], p["offset"], ids[p["start"]:p["start"] + p["length"]]) for p in own]
            yield pd.DataFrame(rows, columns=["sequence_id", "offset", "ids"])

    spread = joined.mapInPandas(cut, "sequence_id bigint, offset bigint, ids array<bigint>")
    return spread.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])).alias("ids"))
