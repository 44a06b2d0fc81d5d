"""Hard negatives by a cover tree over norm-augmented candidates.

An anchor's positives are the rows of its own label with the largest inner products; its
hard negatives are the best rows of other labels whose inner product lies in a window set by
a positive's. Both are searches for the largest inner products, exact ones:

* **Augmentation.** Every candidate x gets the coordinate sqrt(M^2 - |x|^2), M the largest
  norm, and every anchor a 0 there. Inner products do not change and all candidates lie on one
  sphere, so close candidates have close inner products with any anchor q: within a covering
  radius r of a centre c they are between <c, q> - r |q| and <c, q> + r |q|.
* **Top level.** At most CELLS centres, far apart, taken from a bounded sample of rows. Every row
  goes to its nearest centre. A cell is cut by hash into shards of about SHARD_ROWS rows,
  however many rows it has (copies of one vector are many shards of radius 0).
* **Levels below.** A shard holds its own tree: a node is split by centres far apart, chosen from
  its rows until they cover it at half its radius or there are FAN of them, and every row
  follows its nearest centre. Each node keeps its exact covering radius, its smallest id,
  and its label if it has just one.
* **Descent.** Level by level to the leaves, then best bound first, in growing steps. A node is left
  if its bounds lie outside all windows, if it cannot beat the worst result so far (ties by
  id), or if its label is of no use. The rows of leaves are compared in whole numbers.
* **Two passes.** An anchor first searches the shard it lives in; the thresholds found there
  spare it the cells that cannot beat them.
"""

from __future__ import annotations

import heapq
import pickle
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import durable

from .common import picked, size_of

CELLS, SAMPLE_NUMBERS = 256, 1 << 19  # the sample for the centres holds so many numbers at most
SHARD_ROWS, SHARD_NUMBERS, BLOCK_QUERIES = 8192, 1 << 22, 512
FAN, LEAF = 16, 64
POSITIVES, NEGATIVES = 5, 10
_FAR = 1 << 62


# -- one shard's tree -----------------------------------------------------------------------------

def augmented(v: np.ndarray, top: float) -> np.ndarray:
    """The rows with the coordinate that gives all of them the squared norm `top`."""
    v = v.astype(np.float64)
    return np.column_stack([v, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", v, v), 0.0))])


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences: exactly 0 for copies."""
    apart = points - centre
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def far_apart(points: np.ndarray, most: int, within: float = 0.0, first: int = 0):
    """(centres, nearest centre of each point, its distance): each centre is the point farthest from
    those before it, until all points are `within` reach or there are `most` centres."""
    centres, nearest = [first], np.zeros(len(points), dtype=np.int64)
    reach = distances(points, points[first])
    while len(centres) < most and reach.max() > within:
        new = int(reach.argmax())
        away = distances(points, points[new])
        closer = away < reach
        nearest[closer], reach[closer] = len(centres), away[closer]
        centres.append(new)
    return centres, nearest, reach


class CoverTree:
    """Nodes in order of levels; the rows of a node, and its children, lie side by side."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, v: np.ndarray, top: float):
        points = augmented(v, top)
        order = np.arange(len(ids))
        nodes = [(0, len(ids), 0)]  # (from, to, place of the centre in `order`)
        centre, radius, children = [], [], []
        at = 0
        while at < len(nodes):
            start, end, middle = nodes[at]
            own = order[start:end]
            point = order[middle]
            reach = distances(points[own], points[point])
            centre.append(point)
            radius.append(float(reach.max(initial=0.0)))
            children.append((len(nodes), len(nodes)))
            if end - start > LEAF and radius[-1] > 0:
                found, nearest, _ = far_apart(points[own], FAN, radius[-1] / 2, middle - start)
                # a centre comes first of its own rows
                lead = np.ones(len(own), dtype=np.int8)
                lead[found] = 0
                sorting = np.lexsort((lead, nearest))
                order[start:end] = own[sorting]
                cuts = start + np.searchsorted(nearest[sorting], np.arange(len(found) + 1))
                children[-1] = (len(nodes), len(nodes) + len(found))
                nodes += [(int(a), int(b), int(a)) for a, b in zip(cuts[:-1], cuts[1:])]
            at += 1
        self.centres = points[centre]
        self.radius, self.children = np.array(radius), np.array(children)
        self.bounds = np.array([(a, b) for a, b, _ in nodes])
        self.ids, self.keys, self.labels = ids[order], keys[order], labels[order]
        self.v = v[order]
        self.least_id = np.array([self.ids[a:b].min() for a, b in self.bounds])
        lowest = np.array([self.labels[a:b].min() for a, b in self.bounds])
        highest = np.array([self.labels[a:b].max() for a, b in self.bounds])
        self.label, self.one_label = lowest, lowest == highest
        self.largest = float(np.abs(v).max(initial=0))

    @cached_property
    def doubles(self) -> np.ndarray:
        return self.v.astype(np.float64)

    def node_bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest whole inner product that each node's rows can have with each query."""
        q = queries.astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", q, q))
        middle = q @ self.centres[:, :-1].T
        size = np.sqrt(np.einsum("ij,ij->i", self.centres, self.centres))
        slack = 1e-9 * norm[:, None] * size[None, :] + 1e-6  # far above the rounding of doubles
        spread = norm[:, None] * self.radius[None, :] * (1 + 1e-9) + slack
        return np.ceil(middle - spread), np.floor(middle + spread)

    def exactly(self, query: np.ndarray):
        """The rows, in numbers whose products with the query are exact."""
        most = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query))
        if most < 2**53:
            return self.doubles, query.astype(np.float64)
        if most < 2**62:
            return self.v.astype(np.int64), query
        return self.v.astype(object), query.astype(object)

    def search(self, queries: list["Query"]) -> list[tuple]:
        """(query, window, id, key, score) of the best rows in each window of each query."""
        low, high = self.node_bounds(np.stack([q.v for q in queries]))
        return [row for q, a, b in zip(queries, low, high) for row in self._descend(q, a, b)]

    def _descend(self, query: "Query", low: np.ndarray, high: np.ndarray) -> list[tuple]:
        best = [[] for _ in query.windows]  # (-score, id, key), best first
        worst = [(-w.score, w.id) if w.id is not None else (_FAR, 0) for w in query.windows]
        of_use = ~self.one_label | ((self.label == query.label) == query.same)

        def wanted(nodes: np.ndarray) -> np.ndarray:
            """Those that can hold a better row of some window."""
            use = np.zeros(len(nodes), dtype=bool)
            for w, (score, least) in zip(query.windows, worst):
                top = np.minimum(high[nodes], w.hi)
                use |= (high[nodes] >= w.lo) & (low[nodes] <= w.hi) & (
                    (top > -score) | ((top == -score) & (self.least_id[nodes] <= least)))
            return nodes[use & of_use[nodes]]

        v, q = self.exactly(query.v)
        open_nodes, leaves = wanted(np.zeros(1, dtype=np.int64)), []
        while len(open_nodes):  # level by level down to the leaves
            inner = self.children[open_nodes, 1] > self.children[open_nodes, 0]
            leaves.append(open_nodes[~inner])
            spans = self.children[open_nodes[inner]]
            open_nodes = wanted(np.concatenate([np.arange(a, b) for a, b in spans] + [np.zeros(0, np.int64)]).astype(int))
        leaves = np.concatenate(leaves + [np.zeros(0, np.int64)]).astype(int)
        leaves = leaves[np.argsort(-high[leaves], kind="stable")]  # best bound first
        step = 2
        while len(leaves):
            now, leaves = leaves[:step], leaves[step:]
            rows = np.concatenate([np.arange(a, b) for a, b in self.bounds[now]])
            use = ((self.labels[rows] == query.label) == query.same) & (self.keys[rows] != query.key)
            rows = rows[use]
            score = (v[rows] @ q if len(rows) * 4 < len(v) else (v @ q)[rows]).astype(np.int64)
            for i, w in enumerate(query.windows):
                fits = np.flatnonzero((score >= max(w.lo, -worst[i][0])) & (score <= w.hi))
                if len(fits) > 4 * query.k:  # scores below the k-th need no sorting
                    fits = fits[score[fits] >= np.partition(score[fits], -query.k)[-query.k]]
                if not len(fits):
                    continue
                at = rows[fits]
                first = np.lexsort((self.keys[at], self.ids[at], -score[fits]))[:query.k]
                found = list(zip((-score[fits][first]).tolist(), self.ids[at][first].tolist(), self.keys[at][first].tolist()))
                best[i] = heapq.nsmallest(query.k, best[i] + [f for f in found if f[:2] <= worst[i]])
                if len(best[i]) == query.k:
                    worst[i] = min(worst[i], best[i][-1][:2])
            leaves, step = wanted(leaves), 2 * step
        return [(query.key, i, id_, key, -score) for i, rows in enumerate(best) for score, id_, key in rows]


class SearchWindow:
    """Scores from `lo` to `hi` that are not worse than (`score`, `id`), if there is one."""

    def __init__(self, lo: int, hi: int, score: int | None, id_: int | None):
        self.lo, self.hi, self.score, self.id = lo, hi, score, id_


class Query:
    def __init__(self, row, same: bool, k: int):
        self.key, self.label, self.same, self.k = row.key, row.label, same, k
        self.v = np.frombuffer(row.v, "<i8")
        self.windows = [SearchWindow(w["lo"], w["hi"], w["score"], w["id"]) for w in row.windows]


# -- the index ------------------------------------------------------------------------------------

def whole_numbers(rows: DataFrame, id_col: str, vector_col: str, label_col: str, is_moved) -> DataFrame:
    """(`key`, `id`, `label`, `v`) of the rows that take part."""
    v = F.col("v").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = picked(rows, id=id_col, v=vector_col, label=label_col).select(
        F.col("id").cast("bigint").alias("id"), v.alias("v"), F.col("label").cast("bigint").alias("label")).where(
        "id is not null and v is not null and label is not null").where(~bad)
    label = F.when(is_moved(F.col("id")), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return durable(held.select("id", label.alias("label"), F.transform("v", lambda x: F.floor(x * 256)).alias("v"))
                   .withColumn("key", F.monotonically_increasing_id()))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _reached(batches, held: dict):
    """The queries once per shard, but their own, that can hold a better row than they have."""
    cells = list(held.items())
    centres = np.stack([c[0] for _, c in cells])
    radius = np.array([c[1] for _, c in cells])
    size = np.sqrt(np.einsum("ij,ij->i", centres, centres))
    for frame in batches:
        out = []
        for r in frame.itertuples(index=False):
            q = np.frombuffer(r.v, "<i8").astype(np.float64)
            norm = float(np.sqrt(q @ q))
            middle = centres[:, :-1] @ q
            spread = norm * radius * (1 + 1e-9) + 1e-9 * norm * size + 1e-6
            use = np.zeros(len(cells), dtype=bool)
            for w in r.windows:
                least = w["lo"] if w["id"] is None else max(w["lo"], w["score"])
                use |= (np.floor(middle + spread) >= least) & (np.ceil(middle - spread) <= w["hi"])
            out += [(cells[c][0], s, *r) for c in np.flatnonzero(use) for s in range(cells[c][1][2])
                    if (cells[c][0], s) != (r.home_cell, r.home_shard)]
        yield pd.DataFrame(out, columns=["cell", "shard", *frame.columns])


class Index:
    """The shards' trees in a written table, and what the top level knows of its cells."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        count, top, dim = rows.agg(F.count(F.lit(1)), F.max(square), F.max(F.size("v"))).first()
        self.count, self.top, self.dim = count, top or 0.0, max(1, dim or 0)
        shard_rows = max(64, min(SHARD_ROWS, SHARD_NUMBERS // self.dim))
        sampled = rows.orderBy(F.xxhash64("key"), "key").limit(max(1, min(4096, SAMPLE_NUMBERS // self.dim))).select("v")
        points = augmented(_matrix([r["v"] for r in sampled.collect()], self.dim), self.top)
        chosen = far_apart(points, max(1, min(CELLS, count // shard_rows)))[0] if len(points) else []
        centres = spark.sparkContext.broadcast(points[chosen])  # at most CELLS rows
        top_square, width = self.top, self.dim

        def routed(batches):
            for frame in batches:
                v = _matrix(frame["v"].tolist(), width)
                points = augmented(v, top_square)
                away = np.stack([distances(points, c) for c in centres.value])
                yield pd.DataFrame({"key": frame["key"], "id": frame["id"], "label": frame["label"],
                                    "v": [x.tobytes() for x in v], "cell": away.argmin(axis=0).astype(np.int32),
                                    "away": away.min(axis=0)})

        self.rows = durable(rows.select("key", "id", "label", "v").mapInPandas(
            routed, "key bigint, id bigint, label bigint, v binary, cell int, away double"))
        cells = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("away").alias("radius")).collect()
        #: (centre, radius, shards) of each cell that has rows
        self.cells = {r["cell"]: (points[chosen][r["cell"]], r["radius"], -(-r["rows"] // shard_rows)) for r in cells}
        shards = spark.createDataFrame([(c, s[2]) for c, s in self.cells.items()], "cell int, shards int")
        self.placed = self.rows.join(F.broadcast(shards), "cell").withColumn(
            "shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")).drop("shards", "away")

        def built(key, frame):
            v = np.frombuffer(b"".join(frame["v"]), "<i8").reshape(len(frame), width)
            small = v.astype(np.int32) if np.abs(v).max(initial=0) < 2**31 else v
            tree = CoverTree(frame["id"].to_numpy(), frame["key"].to_numpy(), frame["label"].to_numpy(), small, top_square)
            return pd.DataFrame({"cell": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree)]})

        self.trees = durable(self.placed.groupBy("cell", "shard").applyInPandas(
            built, "cell int, shard int, tree binary"))

    def search(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(`query`, `window`, `id`, `key`, `score`, `place`): the best `k` in each window, from 1."""
        queries = durable(queries)
        blocks = max(1, -(-size_of(queries) // BLOCK_QUERIES))
        if not self.cells:
            return queries.sparkSession.createDataFrame([], f"{FOUND}, place int")
        home = durable(self._visited(queries.withColumn("cell", F.col("home_cell")).withColumn(
            "shard", F.col("home_shard")), blocks, same, k))
        worst = home.groupBy("query", "window").agg(
            F.count(F.lit(1)).alias("held"), F.max_by(F.struct("score", "id"), F.struct(-F.col("score"), "id")).alias("last"))
        reached = worst.where(F.col("held") == k).select("query", F.struct("window", "last.score", "last.id").alias("end"))
        ends = reached.groupBy("query").agg(F.collect_list("end").alias("ends"))  # one per window
        seeded = queries.join(ends, queries["key"] == ends["query"], "left").withColumn(
            "windows", F.transform("windows", lambda w, i: F.struct(
                w["lo"].alias("lo"), w["hi"].alias("hi"),
                _end(i)["score"].alias("score"), _end(i)["id"].alias("id")))).select(queries.columns)
        cells = self.cells
        away = seeded.mapInPandas(lambda batches: _reached(batches, cells), f"cell int, shard int, {QUERIES}")
        found = home.unionByName(self._visited(away, blocks, same, k))
        order = W.partitionBy("query", "window").orderBy(F.desc("score"), "id", "key")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    def _visited(self, queries: DataFrame, blocks: int, same: bool, k: int) -> DataFrame:
        dealt = durable(queries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")))
        asked = dealt.select(F.col("cell").alias("_c"), F.col("shard").alias("_s"), "block").distinct()
        trees = asked.join(self.trees, (F.col("_c") == F.col("cell")) & (F.col("_s") == F.col("shard"))).select(
            F.col("cell").alias("c"), F.col("shard").alias("s"), F.col("block").alias("b"), "tree")

        def visit(_, rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(rows) and len(tree):
                found = pickle.loads(tree["tree"].iloc[0]).search(
                    [Query(r, same, k) for r in rows.itertuples(index=False)])
            return pd.DataFrame(found, columns=["query", "window", "id", "key", "score"])

        return dealt.groupBy("cell", "shard", "block").cogroup(trees.groupBy("c", "s", "b")).applyInPandas(visit, FOUND)


QUERIES = ("key bigint, label bigint, v binary, home_cell int, home_shard int, "
           "windows array<struct<lo: bigint, hi: bigint, score: bigint, id: bigint>>")
FOUND = "query bigint, window int, id bigint, key bigint, score bigint"


def _window(lo, hi):
    none = F.lit(None).cast("bigint")
    return F.struct(lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), none.alias("score"), none.alias("id"))


def _end(i):
    """The worst of a full window's results so far; null if it is not full."""
    return F.get(F.filter(F.col("ends"), lambda e: e["window"] == i), F.lit(0))


def hard_negatives(rows: DataFrame, is_anchor, is_moved, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_tenths: int = 3, most_tenths: int = 9) -> DataFrame:
    """(`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`).

    `is_anchor` and `is_moved` take the id column and tell which rows are anchors and which
    ones' labels move on by one (modulo 10). A negative's score lies between `least_tenths` and
    `most_tenths` tenths of the positive's; below 0 no such score exists.

    Rows with a null id, label or vector, or any null or non-finite component, take no part. Zero
    vectors do; a vector shorter than others counts as ended by zeros. Rows that repeat an
    id are rows of their own. A table without anchors, or an anchor without positives or
    negatives, has no rows here. A score must fit a long.
    """
    index = Index(whole_numbers(rows, id_col, vector_col, label_col, is_moved))
    anchors = durable(index.placed.where(is_anchor(F.col("id"))).select(
        "key", "id", "label", "v", F.col("cell").alias("home_cell"), F.col("shard").alias("home_shard")))
    asked = anchors.drop("id")
    best = durable(index.search(asked.withColumn("windows", F.array(_window(F.lit(-_FAR), F.lit(_FAR)))), True, positives).select(
        "query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    lowest = F.expr(f"-((-{least_tenths} * positive_score - pmod(-{least_tenths} * positive_score, 10)) DIV 10)")
    highest = F.expr(f"({most_tenths} * positive_score - pmod({most_tenths} * positive_score, 10)) DIV 10")
    # positives of one score share a window
    limits = durable(best.select("query", "positive_score").distinct().where(lowest <= highest).select(
        "query", "positive_score", lowest.alias("lo"), highest.alias("hi"),
        (F.row_number().over(W.partitionBy("query").orderBy("positive_score")) - 1).alias("window")))
    packed = limits.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("window", "lo", "hi"))).alias("limits"))
    of_anchor = asked.join(packed, F.col("key") == F.col("query")).withColumn("windows", F.transform(
        "limits", lambda w: _window(w["lo"], w["hi"]))).select(asked.columns + ["windows"])
    found = index.search(of_anchor, False, negatives).select(
        "query", "window", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "place")
    return best.join(limits.select("query", "window", "positive_score"), ["query", "positive_score"]).join(found, ["query", "window"]).join(
        anchors.select(F.col("key").alias("query"), F.col("id").alias("anchor_id")), "query").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score")
