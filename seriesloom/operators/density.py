"""Density clusters (DBSCAN) of points in the plane, by grid cells.

Cells have side eps / sqrt(2): any two points of a cell are neighbours. A cell
with `min_points` points is therefore dense without measuring any distance, and
all core points of a cell are connected, so the graph of clusters has one node
per cell, however many points the cell holds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .graph import connected_components
from .pairs import BLOCK_ROWS, block_tasks, run_tasks, to_blocks
from .ranking import sorted_rank

CELL = ["cx", "cy"]
TILE = ["tx", "ty"]
ROWS_PER_TILE = 512


def to_cells(points: DataFrame, eps: float, key: str) -> tuple[DataFrame, list[tuple]]:
    """Points with their cell and tile, and the offsets of the tiles within reach.

    Tasks pair tiles. Where cells hold few rows a tile joins several cells, so
    that a sparse plane does not fall into a task per point.
    """
    side = eps / math.sqrt(2.0)
    points = durable(points.select(key, "x", "y"))
    cells = points.select(
        key, "x", "y", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    rows, used = cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n"), F.count(F.lit(1))).first()
    wide = max(1, math.isqrt(int(ROWS_PER_TILE * used / rows))) if rows else 1
    tiled = cells.withColumns({t: F.floor(F.col(c) / wide) for t, c in zip(TILE, CELL)})
    reach = 2 if wide == 1 else 1
    return tiled, [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)
                   if abs(i) + abs(j) < 4]


def _xy(side: dict) -> np.ndarray:
    return np.column_stack([side["x"].to_numpy(), side["y"].to_numpy()])


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, None, 0] - b[None, :, 0]) ** 2 + (a[:, None, 1] - b[None, :, 1]) ** 2


def neighbour_counts(points: DataFrame, eps: float, key: str = "sku_key",
                     rows: int = BLOCK_ROWS) -> DataFrame:
    """(`key`, `neighbours`): rows within eps, the row itself included."""
    cells, reach = to_cells(points, eps, key)
    blocked = to_blocks(cells, TILE, key, rows)

    def kernel(a: dict, b: dict, same: bool) -> dict:
        near = _gaps(_xy(a), _xy(b)) <= eps * eps
        ids, counts = [a[key]], [near.sum(axis=1)]
        if not same:
            ids.append(b[key])
            counts.append(near.sum(axis=0))
        return {key: pa.concat_arrays(ids), "c": pa.array(np.concatenate(counts).astype("int64"))}
    key_type = points.schema[key].dataType.simpleString()
    parts = run_tasks(blocked, block_tasks(blocked, TILE, offsets=reach), [key, "x", "y"],
                      f"{key} {key_type}, c bigint", kernel)
    return parts.groupBy(key).agg(F.sum("c").alias("neighbours"))


def _mixed_tasks(blocked: DataFrame, reach: list[tuple], sparse_pairs: bool) -> DataFrame:
    """Tile tasks without pairs of two kind-1 blocks (and of two kind-0 blocks)."""
    tasks = block_tasks(blocked, [*TILE, "kind"], offsets=[(*o, None) for o in reach])

    def kind(c: str):
        return F.element_at(F.split(c, ":"), 3)
    wanted = (kind("_a") == "0") | (kind("_b") == "0")
    if not sparse_pairs:
        wanted &= (kind("_a") != kind("_b"))
    return tasks.where(wanted)


def _core_points(cells: DataFrame, reach: list, eps: float, min_points: int, key: str,
                 rows: int) -> DataFrame:
    """Cells plus `core`. Distances are measured only for points of sparse cells."""
    sizes = cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
    sized = cells.join(sizes.withColumn("dense", F.col("_n") >= min_points).drop("_n"), CELL)
    # sparse cells hold few points, so pairing them with dense blocks stays linear
    blocked = to_blocks(sized.withColumn("kind", F.col("dense").cast("int")), [*TILE, "kind"], key, rows)
    tasks = _mixed_tasks(blocked, reach, sparse_pairs=True)

    def kernel(a: dict, b: dict, same: bool) -> dict:
        near = _gaps(_xy(a), _xy(b)) <= eps * eps
        ids, counts = [], []
        sides = [(a, near.sum(axis=1))] + ([] if same else [(b, near.sum(axis=0))])
        for side, found in sides:
            keep = ~np.asarray(side["dense"].to_numpy(zero_copy_only=False), dtype=bool)
            ids.append(side[key].filter(pa.array(keep)))
            counts.append(found[keep])
        return {key: pa.concat_arrays(ids), "c": pa.array(np.concatenate(counts).astype("int64"))}
    key_type = cells.schema[key].dataType.simpleString()
    parts = run_tasks(blocked, tasks, [key, "x", "y", "dense"], f"{key} {key_type}, c bigint", kernel)
    counted = parts.groupBy(key).agg(F.sum("c").alias("_c"))
    return sized.join(counted, key, "left").select(
        key, "x", "y", *CELL, *TILE,
        (F.col("dense") | (F.coalesce("_c", F.lit(0)) >= min_points)).alias("core"))


def _cell_links(core: DataFrame, reach: list[tuple], eps: float, key: str, rows: int) -> DataFrame:
    """(`a`, `b`): pairs of cells with core points within eps of each other.

    A cell is first judged by which of its 8 x 8 squares hold points: two squares
    that lie within eps as a whole link their cells, two that lie farther apart
    cannot. Points are compared only in squares that leave a pair of cells open,
    so a cell with a third of all points is mostly 64 rows.
    """
    square = eps / math.sqrt(2.0) / 8
    core = core.withColumns({"sx": F.floor(F.col("x") / square), "sy": F.floor(F.col("y") / square)})
    squares = core.select(*TILE, "cell", "sx", "sy").distinct().withColumn(
        "spot", F.concat_ws(":", "cell", "sx", "sy"))
    blocked = to_blocks(squares, TILE, "spot", rows)

    def judge(a: dict, b: dict, same: bool) -> dict:
        steps = [np.abs(a[c].to_numpy()[:, None] - b[c].to_numpy()[None, :]) for c in ("sx", "sy")]
        near = sum((np.maximum(s - 1, 0) * square) ** 2 for s in steps) <= eps * eps * (1 + 1e-9)
        whole = sum(((s + 1) * square) ** 2 for s in steps) <= eps * eps * (1 - 1e-9)
        cells_a, cells_b = (s["cell"].to_numpy(zero_copy_only=False).astype(str) for s in (a, b))
        spots_a, spots_b = (s["spot"].to_numpy(zero_copy_only=False).astype(str) for s in (a, b))
        i, j = np.nonzero(near)
        apart = cells_a[i] != cells_b[j]
        i, j = i[apart], j[apart]
        first, second = cells_a[i], cells_b[j]
        low, high = np.where(first < second, first, second), np.where(first < second, second, first)
        sure = whole[i, j]
        linked = {(x, y, "", True) for x, y in zip(low[sure].tolist(), high[sure].tolist())}
        known = {p[:2] for p in linked}
        rest = np.array([pair not in known for pair in zip(low.tolist(), high.tolist())], dtype=bool)
        for spots, at in ((spots_a, i), (spots_b, j)):
            linked |= {(x, y, s, False) for x, y, s in zip(low[rest].tolist(), high[rest].tolist(), spots[at[rest]].tolist())}
        out = sorted(linked)
        return {"a": pa.array([r[0] for r in out], pa.string()), "b": pa.array([r[1] for r in out], pa.string()),
                "spot": pa.array([r[2] for r in out], pa.string()), "sure": pa.array([r[3] for r in out], pa.bool_())}
    judged = durable(run_tasks(blocked, block_tasks(blocked, TILE, offsets=reach), ["cell", "sx", "sy", "spot"],
                               "a string, b string, spot string, sure boolean", judge))
    sure = judged.where("sure").select("a", "b").distinct()
    doubt = judged.where(~F.col("sure")).join(sure, ["a", "b"], "left_anti").select("spot").distinct()
    near_points = core.withColumn("spot", F.concat_ws(":", "cell", "sx", "sy")).join(doubt, "spot", "left_semi")
    points = to_blocks(near_points, TILE, key, rows)

    def link(a: dict, b: dict, same: bool) -> dict:
        i, j = np.nonzero(_gaps(_xy(a), _xy(b)) <= eps * eps)
        (names_a, code_a), (names_b, code_b) = (
            np.unique(s["cell"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for s in (a, b))
        met = np.unique(code_a[i] * len(names_b) + code_b[j])
        left, right = names_a[met // max(len(names_b), 1)], names_b[met % max(len(names_b), 1)]
        apart = left != right
        return {"a": pa.array(left[apart].tolist(), pa.string()),
                "b": pa.array(right[apart].tolist(), pa.string())}
    found = run_tasks(points, block_tasks(points, TILE, offsets=reach), ["x", "y", "cell"],
                      "a string, b string", link)
    return sure.unionByName(found).distinct()


def density_clusters(points: DataFrame, eps: float, min_points: int = 5,
                     min_cluster_size: int = 50, key: str = "sku_key",
                     rows: int = BLOCK_ROWS) -> DataFrame:
    """(`key`, `cluster`) of (`key`, `x`, `y`); -1 is noise.

    A border point joins the cluster of its nearest core point (smaller key on
    ties). Clusters under `min_cluster_size` become noise. The others are numbered
    by their smallest cell.
    """
    key_type = points.schema[key].dataType.simpleString()
    cells, reach = to_cells(points, eps, key)
    marked = durable(_core_points(cells, reach, eps, min_points, key, rows))
    core = marked.where("core")
    name = F.concat_ws(":", *CELL)
    edges = _cell_links(core.withColumn("cell", name), reach, eps, key, rows)
    parts = connected_components(core.select(name.alias("id")), edges)
    labelled = core.withColumn("cell", name).join(parts.withColumnRenamed("id", "cell"), "cell").select(
        key, "x", "y", *TILE, "component", F.lit(True).alias("core"))
    rest = marked.where(~F.col("core")).select(
        key, "x", "y", *TILE, F.lit(None).cast("string").alias("component"), F.lit(False).alias("core"))
    both = labelled.unionByName(rest).withColumn("kind", F.col("core").cast("int"))
    blocked = to_blocks(both, [*TILE, "kind"], key, rows)

    def border(a: dict, b: dict, same: bool) -> dict:
        found = []
        d = _gaps(_xy(a), _xy(b))
        for free, host, gap in ((a, b, d), (b, a, d.T)) if not same else ((a, a, d),):
            open_rows = np.flatnonzero(~np.asarray(free["core"].to_numpy(zero_copy_only=False), dtype=bool))
            cores = np.flatnonzero(np.asarray(host["core"].to_numpy(zero_copy_only=False), dtype=bool))
            if not len(open_rows) or not len(cores):
                continue
            by_key = cores[np.argsort(host[key].to_numpy()[cores], kind="stable")]
            sub = gap[np.ix_(open_rows, by_key)]
            best = sub.argmin(axis=1)
            ok = sub[np.arange(len(open_rows)), best] <= eps * eps
            hosts = by_key[best[ok]]
            found.append((free[key].take(pa.array(open_rows[ok])), sub[np.arange(len(open_rows)), best][ok],
                          host[key].take(pa.array(hosts)), host["component"].take(pa.array(hosts))))
        if not found:
            empty = a[key].slice(0, 0)
            return {key: empty, "gap": pa.array([], pa.float64()), "host": empty,
                    "component": pa.array([], pa.string())}
        return {key: pa.concat_arrays([f[0] for f in found]),
                "gap": pa.array(np.concatenate([f[1] for f in found])),
                "host": pa.concat_arrays([f[2] for f in found]),
                "component": pa.concat_arrays([f[3] for f in found])}
    nearest_core = run_tasks(
        blocked, _mixed_tasks(blocked, reach, sparse_pairs=False), [key, "x", "y", "core", "component"],
        f"{key} {key_type}, gap double, host {key_type}, component string", border)
    bordered = nearest_core.groupBy(key).agg(
        F.min_by("component", F.struct("gap", "host")).alias("component"))
    members = labelled.select(key, "component").unionByName(bordered)
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") >= min_cluster_size)
    numbered = sorted_rank(sizes.select("component"), ["component"], "cluster")
    placed = members.join(numbered, "component")
    return points.select(key).join(placed.select(key, "cluster"), key, "left").select(
        key, F.coalesce(F.col("cluster").cast("int"), F.lit(-1)).alias("cluster"))
