"""Approximate nearest neighbours by pivot permutations.

A vector is represented by its `prefix` nearest of `pivots` reference vectors, in order.
The index is cut into shards of about `shard_rows` rows; a shard holds an inverted file per
pivot: which of its rows have it, and at which place. A query adds up, over the lists of its
own pivots, how much each shared pivot brings a row's footrule distance
sum_p |place(p) - place_q(p)| (a pivot out of the prefix stands at place `prefix`) below
that of rows with nothing shared. The best `share` of every shard is compared on the
original vectors, and all rows of less than CLOSE times the shard's median footrule: the
order of pivots hardly tells the members of a tight group apart, so a group is compared
as a whole however large it is. Queries come in blocks, so a task holds one shard and
one block.

Pivots lie apart: of a sample by hash, each is taken that is not near one taken before, so
that a tight group has one pivot and not its share of them.

Recall@10 of the defaults, measured against brute force: see the README.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import durable

from .common import picked, size_of

PIVOTS, PREFIX, SHARE = 256, 64, 0.12
CLOSE, SAMPLED = 0.3, 16  # SAMPLED: rows looked at per pivot
SHARD_ROWS, BLOCK_QUERIES = 8192, 1024


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(`id`, `v` as doubles, `dim`) of vectors that take part."""
    v = F.col("v").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return picked(rows, id=id_col, v=vector_col).select("id", v.alias("v")).where(
        "id is not null and v is not null and size(v) > 0").where(
        ~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def apart(sample: np.ndarray, n: int) -> np.ndarray:
    """`n` rows of `sample` (all, if fewer) in its order, no two nearer than need be."""
    if len(sample) <= n:
        return sample
    gap = np.sqrt(np.maximum(((sample[:256, None] - sample[None, :256]) ** 2).sum(2), 0))
    least, taken = 0.6 * float(np.median(gap)), np.zeros(len(sample), dtype=bool)
    while taken.sum() < n:
        near = np.full(len(sample), np.inf)
        for i in np.flatnonzero(taken):
            near = np.minimum(near, ((sample - sample[i]) ** 2).sum(1))
        for i in range(len(sample)):
            if taken.sum() == n:
                break
            if not taken[i] and near[i] >= least * least:
                taken[i] = True
                near = np.minimum(near, ((sample - sample[i]) ** 2).sum(1))
        least = least / 2 if least > 1e-12 else 0.0
    return sample[taken]


def places(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the `prefix` nearest pivots of each row, nearest first."""
    gap = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
    return np.argsort(gap, axis=1, kind="stable")[:, :prefix].astype(np.int16)


class Inverted:
    """The inverted files of one shard: per pivot, the rows that have it and its place there."""

    def __init__(self, order: np.ndarray, pivots: int):
        rows, self.prefix = order.shape
        flat = order.ravel().astype(np.int64)
        by_pivot = np.argsort(flat, kind="stable")
        cuts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
        self.lists = [(by_pivot[a:b] // max(self.prefix, 1), by_pivot[a:b] % max(self.prefix, 1))
                      for a, b in zip(cuts, cuts[1:])]
        self.rows = rows

    def footrule(self, query: np.ndarray) -> np.ndarray:
        k = self.prefix
        saved = np.zeros(self.rows, dtype=np.int64)
        for place, pivot in enumerate(query):
            rows, at = self.lists[pivot]
            saved[rows] += 2 * (k - np.maximum(at, place))
        return k * (k + 1) - saved


def search_shard(names, x, order, query_names, queries, query_order, pivots: int, k: int, share: float):
    """(query number, row, score) of the k best of the candidates in one shard."""
    index = Inverted(order, pivots)
    want = min(len(x), max(4 * k, int(np.ceil(share * len(x)))))
    out = []
    for i, q in enumerate(queries):
        far = index.footrule(query_order[i])
        far[names == query_names[i]] = np.iinfo(np.int64).max  # not its own neighbour
        near = np.flatnonzero((far <= np.partition(far, want - 1)[want - 1])  # with all that tie
                              | (far < CLOSE * np.median(far)))
        near = near[names[near] != query_names[i]]
        score = np.sqrt(((x[near] - q) ** 2).sum(1))
        best = np.lexsort((names[near], score))[:k]
        out += [(i, near[j], float(score[j])) for j in best]
    return out


def _searched(frame: pd.DataFrame, pivots: int, k: int, share: float) -> pd.DataFrame:
    asked = frame["query"].to_numpy()
    rows, queries = frame[~asked], frame[asked]
    if not len(rows) or not len(queries):
        return pd.DataFrame(columns=["query_id", "ask", "vec_id", "score"])
    rows = rows.sort_values("id", kind="stable")
    names, asks = rows["id"].to_numpy(), queries["id"].to_numpy()
    found = search_shard(names, np.stack(rows["v"].to_numpy()), np.stack(rows["order"].to_numpy()), asks,
                         np.stack(queries["v"].to_numpy()), np.stack(queries["order"].to_numpy()), pivots, k, share)
    mark = queries["ask"].to_numpy()
    return pd.DataFrame([(asks[i], mark[i], names[j], s) for i, j, s in found],
                        columns=["query_id", "ask", "vec_id", "score"])


def nearest(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE,
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id`, `score` (euclidean distance) for the rows that `is_query` picks by `id`.

    Vectors that are null, empty, zero, or hold a null or a number that is not finite take no
    part, nor do rows without an id. Vectors meet those of their own length only. Rows that
    repeat an id are rows of their own as candidates; of equal query rows one asks. A row
    with a query's id is not its neighbour. Ties go to the smaller id. Pivots come from the
    SAMPLED * `pivots` distinct vectors of smallest hash, a bounded sample; every row is indexed.
    """
    good = durable(usable(rows, id_col, vector_col))
    spark = rows.sparkSession
    lengths = [r["dim"] for r in good.select("dim").distinct().limit(1001).collect()]
    if len(lengths) > 1000:
        raise ValueError("vectors of more than 1000 lengths")
    chosen = {d: apart(np.array([r["v"] for r in good.where(F.col("dim") == d).select("v").distinct().orderBy(
        F.xxhash64("v"), "v").limit(SAMPLED * pivots).collect()]), pivots) for d in lengths}
    shared = spark.sparkContext.broadcast(chosen)

    def ordered(batches):
        for frame in batches:
            order = [None] * len(frame)
            for d in frame["dim"].unique():
                at = np.flatnonzero(frame["dim"] == d)
                own = shared.value[d]
                for i, o in zip(at, places(np.stack(frame["v"].iloc[at].to_numpy()), own, min(prefix, len(own)))):
                    order[i] = o
            yield frame.assign(order=order)

    kind = good.schema["id"].dataType.simpleString()
    index = durable(good.mapInPandas(ordered, f"id {kind}, v array<double>, dim int, order array<smallint>"))
    asking = index.where(is_query(F.col("id"))).withColumn("ask", F.xxhash64("v")).dropDuplicates(["id", "ask"])
    shards = -(-max(1, size_of(index)) // shard_rows)
    blocks = -(-max(1, size_of(asking)) // block_queries)
    cells = index.withColumn("ask", F.lit(0).cast("bigint")).withColumn("query", F.lit(False)).withColumn(
        "shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asking.withColumn("query", F.lit(True)).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))).withColumn(
        "block", F.pmod(F.xxhash64("id", "ask"), F.lit(blocks)).cast("int"))
    found = cells.unionByName(asked).groupBy("dim", "shard", "block").applyInPandas(
        lambda frame: _searched(frame, pivots, k, share),
        f"query_id {kind}, ask bigint, vec_id {kind}, score double")
    rank = F.row_number().over(W.partitionBy("query_id", "ask").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
