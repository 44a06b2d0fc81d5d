import collections
import datetime
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.functions import distributions, kernels
from seriesloom.operators import (density, dtw, embed, features, graph, kmeans, neighbours, pairs, prep, quality, som,
                                  supervised, ward)


def frame(spark, points, key="sku_key"):
    return spark.createDataFrame([(i, [float(v) for v in np.atleast_1d(p)]) for i, p in enumerate(points)],
                                 f"{key} bigint, vec array<double>")


def blobs(n=150, d=3, seed=0):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(c * 6, 1, (n // 3, d)) for c in range(3)])


def partition(labels):
    groups = {}
    for k, v in labels.items():
        groups.setdefault(v, set()).add(k)
    return {frozenset(g) for g in groups.values()}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(40)]
    edges += [tuple(map(int, rng.integers(200, 260, 2))) for _ in range(40)]
    nodes = sorted({v for e in edges for v in e} | {999})
    parent = {v: v for v in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = graph.connected_components(spark.createDataFrame([(v,) for v in nodes], "id bigint"),
                                     spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["id"]: r["component"] for r in got.collect()} == {v: root(v) for v in nodes}


def plain_dtw(a, b):
    t = np.full((len(a) + 1, len(b) + 1), np.inf)
    t[0, 0] = 0
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1, j + 1] = (a[i] - b[j]) ** 2 + min(t[i, j + 1], t[i + 1, j], t[i, j])
    return float(np.sqrt(t[-1, -1]))


def test_dtw_kernel():
    cases = [([0, 1, 2], [0, 2], 1), ([1, 2, 3], [1, 2, 2, 3], 0), ([0, 0], [1, 1], 2 ** 0.5),
             ([0, 1, 0, 0], [0, 0, 1, 0], 0)]
    for a, b, want in cases:
        (ta, la), (tb, lb) = kernels.padded([np.array(a, float)]), kernels.padded([np.array(b, float)])
        assert np.isclose(kernels.dtw_batch(ta, la, tb, lb)[0], want)
        assert np.isclose(kernels.dtw_batch(tb, lb, ta, la)[0], want)


def random_series(n=60, seed=3):
    rng = np.random.default_rng(seed)
    made = [[float(v) for v in rng.integers(0, 6, rng.integers(1, 7))] for _ in range(n)]
    return made + [made[0]] * 20  # a hot group of copies


def test_dtw_on_runs():
    rng = np.random.default_rng(1)

    def sparse(n):
        return np.where(rng.random(n) < 0.3, rng.integers(1, 5, n), 0).astype(float)
    for shift in (0.0, 0.1):
        for n in range(1, 40):
            a, many = sparse(n), [sparse(m) + shift for m in rng.integers(1, 40, 6)]
            want = np.array([plain_dtw(a, s) for s in many])
            table, lengths = kernels.padded(many)
            assert np.allclose(kernels.dtw_runs(a, table, lengths), want)
            cut = np.where(want <= 3, want, np.inf)
            assert np.allclose(kernels.dtw_runs(a, table, lengths, 3.0), cut)
            ta, la = kernels.padded([a] * 6)
            assert np.allclose(kernels.dtw_batch(ta, la, table, lengths, limit=3.0), cut)
            for j, distance in enumerate(want):  # the bound keeps every pair within the limit
                assert dtw.run_bounds([a], many, np.zeros(1, int), np.array([j]), distance).all()


def test_dtw_pairs_and_clusters(spark):
    data = random_series()
    df = spark.createDataFrame(list(enumerate(data)), "sku_key bigint, series array<double>")
    limit = 2.0
    close = {(i, j): d for i, j in itertools.combinations(range(60), 2)
             if (d := plain_dtw(data[i], data[j])) <= limit}
    reps = {r["sku_key"]: r["rep"] for r in dtw.copies(df).collect()}
    want = {(i, j): d for (i, j), d in close.items() if reps[i] == i and reps[j] == j}
    want |= {(r, i): 0.0 for i, r in reps.items() if i != r}
    got = {(r["a"], r["b"]): r["dist"] for r in dtw.dtw_pairs(df, limit, rows=4).collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
    parent = list(range(80))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for i, j in [*close, *((0, k) for k in range(60, 80))]:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    labels = {r["sku_key"]: r["cluster"] for r in dtw.dtw_clusters(df, limit, rows=4).collect()}
    assert partition(labels) == partition({v: root(v) for v in range(80)})
    assert set(labels.values()) == set(range(len(set(labels.values()))))


def test_warping_of_run_series(spark):
    rng = np.random.default_rng(8)
    first = datetime.date(2000, 1, 1)
    rows = [(k, first + datetime.timedelta(int(d)), float(rng.integers(0, 4)))
            for k in range(14) for d in rng.choice(40, rng.integers(1, 6), replace=False)]
    rows += [(20 + k, d, v) for k, d, v in rows if k < 2]  # copies
    cells = spark.createDataFrame(rows, "sku_key bigint, tran_date date, sales double")
    runs, days = prep.run_series(cells), prep.series(cells, fill=True)
    one, other = ({tuple(r) for r in dtw.dtw_pairs(df, 3.0, rows=4).collect()} for df in (runs, days))
    assert one == other and len(one) > 5
    assert rows_of(dtw.dtw_clusters(runs, 2.0, rows=4)) == rows_of(dtw.dtw_clusters(days, 2.0, rows=4))
    windows = [{tuple(r) for r in dtw.dtw_pairs(df, 4.0, 5, rows=4).collect()} for df in (runs, days)]
    assert windows[0] == windows[1]
    for df in (runs, days):
        found = {r["sku_key"]: (r["cluster"], r["dist"]) for r in dtw.dtw_medoids(df, 2, rows=4).collect()}
        assert set(found) == {r[0] for r in rows} and found[20] == found[0] and found[21] == found[1]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_dtw_medoids(spark):
    data = [[0.0, 1.0, 0.0]] * 5 + [[0.0, 1.1, 0.0], [9.0, 8.0, 9.0], [9.0, 8.2, 9.0], [9.1, 8.0, 9.0]]
    df = spark.createDataFrame(list(enumerate(data)), "sku_key bigint, series array<double>")
    labels = {r["sku_key"]: r["cluster"] for r in dtw.dtw_medoids(df, 2, rows=2, seed=1).collect()}
    assert len(labels) == 9 and len({labels[i] for i in range(6)}) == 1 and labels[8] != labels[0]


def test_knn_is_exact(spark):
    x = np.vstack([blobs(90), np.repeat(blobs(3), 15, axis=0)])  # copies included
    got = {}
    for r in neighbours.knn(frame(spark, x), 4, pivots=6, rows=10).collect():
        got.setdefault(r["sku_key"], []).append((r["dist"], r["neighbour"]))
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for i in range(len(x)):
        want = sorted((gap[i, j], j) for j in range(len(x)) if j != i)[:4]
        assert np.allclose([d for d, _ in sorted(got[i])], [d for d, _ in want], atol=1e-7)
        assert len(got[i]) == 4


def test_fuzzy_and_spectral(spark):
    df = frame(spark, blobs(60))
    edges = neighbours.fuzzy_edges(neighbours.knn(df, 5), 5).collect()
    assert all(0 < r["weight"] <= 1 + 1e-9 and r["a"] < r["b"] for r in edges)
    layout = embed.embed(df, 2, "spectral", neighbours=5).collect()
    assert len(layout) == 60 and all(np.isfinite(r["vec"]).all() for r in layout)
    with pytest.raises(ValueError):
        embed.embed(df, 2, "other")


@pytest.mark.parametrize("kind", ["path", "groups"])
def test_spectral_layout_with_a_narrow_gap(spark, kind):
    """Against a dense solver: a path, and three groups that hang together by weak edges."""
    if kind == "path":
        edges = [(i, i + 1, 1.0) for i in range(23)]
    else:
        edges = [(g + i, g + j, 1.0 + (i * j) % 3) for g in (0, 12, 24) for i in range(12) for j in range(i)]
        edges = [(min(e[:2]), max(e[:2]), e[2]) for e in edges] + [(3, 15, 0.05), (16, 30, 0.06)]
    n = max(e[1] for e in edges) + 1
    w = np.zeros((n, n))
    for a, b, v in edges:
        w[a, b] = w[b, a] = v
    deg = w.sum(axis=1)
    vectors = np.linalg.eigh(w / np.sqrt(np.outer(deg, deg)))[1][:, [-2, -3]]
    found = embed.spectral_layout(spark.createDataFrame(edges, "a bigint, b bigint, weight double"), 2)
    got = np.array([r["vec"] for r in found.orderBy("id").collect()])
    assert np.allclose((got ** 2).sum(axis=0), 1)
    assert np.all(np.abs((got * vectors).sum(axis=0)) > 1 - 1e-5)


def test_held_layout_writes_no_table_a_round(spark, monkeypatch):
    """The driver's block and the distributed one give the same vectors, up to their signs; only the latter writes each round."""
    edges = [(i, i + 1, 1.0 + i % 3) for i in range(9)] + [(9, 9, 0.5), (3, 8, 0.2)]
    df, found, written = spark.createDataFrame(edges, "a int, b int, weight double"), [], []
    real = embed.durable
    monkeypatch.setattr(embed, "durable", lambda table: written.append(1) or real(table))
    monkeypatch.setattr(embed, "LINKS_A_TASK", 6)
    for numbers in (embed.STATE_NUMBERS, 0):
        written.clear()
        monkeypatch.setattr(embed, "STATE_NUMBERS", numbers)
        found.append(embed.spectral_layout(df, 2).orderBy("id"))
        assert (len(written) < 6) == (numbers > 0)
    assert found[0].schema["id"].dataType == found[1].schema["id"].dataType
    one, other = (np.array([[r["id"], *r["vec"]] for r in f.collect()]) for f in found)
    assert (one[:, 0] == other[:, 0]).all()
    turn = np.sign((one[:, 1:] * other[:, 1:]).sum(axis=0))
    assert np.allclose(one[:, 1:], other[:, 1:] * turn, atol=1e-6)


def test_pca(spark):
    x = blobs(60)
    got = np.array([r["vec"] for r in embed.embed(frame(spark, x), 2).orderBy("sku_key").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    spread = got - got.mean(axis=0)
    assert np.allclose(np.abs(spread), np.abs((u * s)[:, :2]), atol=1e-6)


@pytest.mark.parametrize("rows", [2, 2048])
def test_silhouette(spark, rows):
    def score(points, clusters, **kw):
        df = spark.createDataFrame([(i, c, [float(p)]) for i, (p, c) in enumerate(zip(points, clusters))],
                                   "sku_key bigint, cluster int, vec array<double>")
        s = quality.silhouette_samples(df, rows=rows, **kw)
        return [r["silhouette"] for r in s.orderBy("sku_key").collect()]
    assert np.allclose(score([0, 1, 10, 11], [0, 0, 1, 1]),
                       [0.9047619, 0.8947368, 0.8947368, 0.9047619])
    assert np.allclose(score([0, 1, 10], [0, 0, 1]), [0.9, 0.8888889, 0])
    squared = score([0, 1, 10, 11], [0, 0, 1, 1], metric="sqeuclidean")
    assert np.isclose(np.mean(squared), 0.9899503)


def test_blocks_of_a_cell_are_bounded(spark, monkeypatch):
    df = spark.range(2000).selectExpr("id", "0 AS c")
    assert pairs.to_blocks(df, ["c"], "id", 10).select("_block").distinct().count() > 150
    assert pairs.to_blocks(df, ["c"], "id", 10, most=6).select("_block").distinct().count() == 6
    monkeypatch.setattr(pairs, "MOST_ROWS", 100)  # a block's size is bounded before their number is
    assert pairs.to_blocks(df, ["c"], "id", 10, most=6).select("_block").distinct().count() == 20


def test_silhouettes_of_many_blocks_and_labels(spark, monkeypatch):
    """Slices of blocks and several labels at once against plain loops."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    x, labels = rng.normal(size=(90, 3)), rng.integers(0, 4, (2, 90))
    df = spark.createDataFrame([(i, int(labels[0, i]), int(labels[1, i]), x[i].tolist()) for i in range(90)],
                               "sku_key bigint, one int, two int, vec array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for rows in (20, 200):
        for r in quality._mean_distances(df, "sku_key", rows, ["one", "two"]).collect():
            there = labels[r["set"]] == r["other"]
            assert r["n"] == there.sum() and np.isclose(r["total"], d[r["sku_key"], there].sum())


def test_silhouette_by_k_agrees_with_a_pass_for_each(spark):
    df = frame(spark, np.random.default_rng(2).normal(size=(50, 2)))
    got = {r["k"]: r["silhouette"] for r in quality.silhouette_by_k(df, ks=(2, 3, 4), n_init=2).collect()}
    for k in (2, 3, 4):
        labels = kmeans.fit_kmeans(df, k, 2).assigned
        want = quality.silhouette_score(quality.silhouette_samples(df.join(labels, "sku_key"))).first()[0]
        assert np.isclose(got[k], want)


def test_silhouette_sums_of_all_sets_take_one_product(spark, monkeypatch):
    """A pass over a block's distances serves every set of clusters."""
    rng = np.random.default_rng(3)
    x, labels = rng.normal(size=(30, 2)), rng.integers(0, 3, (3, 30))
    kernels_made = []
    monkeypatch.setattr(quality, "run_tasks", lambda blocked, tasks, columns, schema, kernel: kernels_made.append(kernel) or blocked)
    df = spark.createDataFrame([(i, *map(int, labels[:, i]), x[i].tolist()) for i in range(30)],
                               "sku_key bigint, s0 int, s1 int, s2 int, vec array<double>")
    try:
        quality._mean_distances(df, "sku_key", 100, ["s0", "s1", "s2"])
    except Exception:  # noqa: BLE001 - only the kernel is wanted here
        pass

    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += 1
            return np.asarray(self) @ np.asarray(other)
    monkeypatch.setattr(quality, "squared_distances", lambda a, b: ((a[:, None] - b[None]) ** 2).sum(axis=2).view(Counted))
    sides = [{"sku_key": pa.array(np.arange(30)[part]), "vec": pa.array(x[part].tolist()),
              **{f"s{i}": pa.array(labels[i][part].astype("int32")) for i in range(3)}} for part in (slice(0, 17), slice(17, 30))]
    out = kernels_made[0](*sides, False)
    assert Counted.products == 2
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for k, i, other, total, n in zip(*(out[c].to_pylist() for c in ("sku_key", "set", "other", "total", "n"))):
        there = (labels[i] == other) & ((np.arange(30) < 17) != (k < 17))
        assert n == there.sum() and np.isclose(total, d[k, there].sum())


def test_beginnings_of_paths_leave_out_no_near_pair():
    rng = np.random.default_rng(7)
    many = [rng.integers(0, 9, n).astype(float) for n in rng.integers(1, 30, 60)]
    table, lengths = kernels.padded(many)
    i, j = (x.ravel() for x in np.indices((60, 60)))
    want = kernels.dtw_batch(table[i], lengths[i], table[j], lengths[j])
    for limit in (1.0, 5.0, 12.0):
        near = kernels.dtw_begins_near(table.T[:, i], table.T[:, j], lengths[i] + lengths[j] - 2, limit)
        assert near[want <= limit].all() and (limit > 5 or near.mean() < 0.6)
        assert (dtw.run_bounds(many, many, i, j, limit) == dtw.run_bounds(many, many, j, i, limit)).all()


def test_whole_steps_and_diagonals_agree_with_plain_warping():
    rng = np.random.default_rng(5)
    i, j = (x.ravel() for x in np.indices((40, 40)))
    for scale, noise in ((1.0, 0.0), (0.5, 0.0), (0.37, 0.0), (900.0, 1e-3)):
        many = [rng.integers(-9, 9, n) * scale + noise * rng.normal(size=n) for n in rng.integers(1, 30, 40)]
        many[3] = np.repeat(many[3], 3)
        table, lengths = kernels.padded(many)
        want = kernels.dtw_batch(table[i], lengths[i], table[j], lengths[j])
        days = table.T[:, i], lengths[i], table.T[:, j], lengths[j]
        assert np.array_equal(kernels.dtw_diagonals(*days), want)
        for limit in np.quantile(want, [0.05, 0.3, 0.6]):
            cut = np.where(want <= limit * (1 + 1e-10), want, np.inf)
            assert np.array_equal(kernels.dtw_diagonals(*days, limit), cut)
            (steps,), reach, loss = kernels.in_steps(limit, table)
            assert reach < 180 and loss == (scale not in (1.0, 0.5))
            for width in (None, 5):
                near = kernels.dtw_steps_near(steps.T[:width, i], steps.T[:width, j], lengths[i] + lengths[j] - 2, reach, loss,
                                              None if width else lengths[i])
                assert near[want <= limit].all() and (width or loss or (near == (want <= limit)).all())


@pytest.mark.parametrize("short", (400, 0))
def test_costly_pair_tasks_go_to_several_spark_tasks(spark, monkeypatch, short):
    """Blocks of a few kilobytes: adaptive execution would warp all pairs in one task."""
    monkeypatch.setattr(dtw, "SHORT", short)
    rng = np.random.default_rng(6)
    data = [rng.integers(0, 6, 5).astype(float).tolist() for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(data)), "sku_key bigint, series array<double>")
    found = dtw.dtw_pairs(df, 3.0, rows=4).withColumn("at", F.spark_partition_id()).where("dist > 0").collect()
    assert len({r["at"] for r in found}) > 8
    assert {(r["a"], r["b"]) for r in found} == {
        (i, j) for i, j in itertools.combinations(range(60), 2) if 0 < plain_dtw(data[i], data[j]) <= 3
        and i == data.index(data[i]) and j == data.index(data[j])}


def plain_dbscan(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label, c = np.full(len(x), -1), 0
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack = [i]
        while stack:
            at = stack.pop()
            if label[at] >= 0:
                continue
            label[at] = c
            stack += [j for j in np.flatnonzero(near[at] & core) if label[j] < 0]
        c += 1
    return core, label, near


@pytest.mark.parametrize("rows", [7, 2048])
def test_density_clusters(spark, rows):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(0, 0.3, (80, 2)), rng.normal(3, 0.3, (60, 2)), rng.uniform(-3, 6, (30, 2)),
                   np.tile([[1.5, 4.0]], (40, 1))])
    pts = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)],
                                "sku_key bigint, x double, y double")
    got = {r["sku_key"]: r["cluster"] for r in density.density_clusters(pts, 0.4, 5, 10, rows=rows).collect()}
    core, label, near = plain_dbscan(x, 0.4, 5)
    want = {}
    for i in range(len(x)):
        if not core[i]:
            hosts = [j for j in np.flatnonzero(near[i] & core)]
            host = min(hosts, key=lambda j: (((x[i] - x[j]) ** 2).sum(), j)) if hosts else None
            want[i] = label[host] if hosts else -1
        else:
            want[i] = label[i]
    sizes = {c: sum(v == c for v in want.values()) for c in set(want.values())}
    want = {k: (v if v >= 0 and sizes[v] >= 10 else -1) for k, v in want.items()}
    assert {k for k, v in got.items() if v == -1} == {k for k, v in want.items() if v == -1}
    assert partition(got) == partition(want)


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        def rise(a, b):
            ca, cb = x[a].mean(axis=0), x[b].mean(axis=0)
            return len(a) * len(b) / (len(a) + len(b)) * ((ca - cb) ** 2).sum()
        i, j = min(itertools.combinations(range(len(groups)), 2), key=lambda p: rise(groups[p[0]], groups[p[1]]))
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def test_ward_merges_are_exact():
    x = np.random.default_rng(7).normal(size=(40, 2))
    merges = ward.ward_merges(x, np.ones(len(x)))
    for k in (2, 4, 6):
        assert partition(dict(enumerate(ward.cut(merges, len(x), k)))) == plain_ward(x, k)


@pytest.mark.parametrize("n", [24, 300])
def test_ward_is_one_path_for_any_number_of_rows(spark, n):
    tree = ward.ward_tree(frame(spark, blobs(n)), micro=30)
    labels = {r["sku_key"]: r["cluster"] for r in tree.assigned(3).collect()}
    assert partition(labels) == {frozenset(range(i * n // 3, (i + 1) * n // 3)) for i in range(3)}
    heights = [r["height"] for r in tree.last_merges(10).orderBy("step").collect()]
    assert heights == sorted(heights)


def spread(x, labels):
    return sum(((x[list(g)] - x[list(g)].mean(axis=0)) ** 2).sum() for g in partition(labels))


def test_ward_on_cells_against_exact_ward(spark):
    """No blobs, some copies and a far pair that is smaller than a cell."""
    x = np.random.default_rng(11).normal(size=(240, 3))
    x[200:220] = x[0]
    x[-2:] = [[40.0, 0.0, 0.0], [40.5, 0.0, 0.0]]
    exact = ward.ward_merges(x, np.ones(len(x)))
    tree = ward.ward_tree(frame(spark, x), micro=240)
    assert tree.leaves == 220
    got = tree.last_merges(219).orderBy("step").collect()
    assert np.allclose([r["height"] for r in got], [m[2] for m in exact[20:]])
    assert [r["rows"] for r in got] == [m[3] for m in exact[20:]]
    coarse = ward.ward_tree(frame(spark, x), micro=80)
    for k in (2, 4, 6):
        want = dict(enumerate(ward.cut(exact, len(x), k)))
        labels = {r["sku_key"]: r["cluster"] for r in tree.assigned(k).collect()}
        assert partition(labels) == partition(want)
        labels = {r["sku_key"]: r["cluster"] for r in coarse.assigned(k).collect()}
        assert frozenset({238, 239}) in partition(labels)
        assert spread(x, labels) < 1.15 * spread(x, want)


def test_registered_ward_merges_every_row(spark):
    import __spark_entry__ as entry
    x = np.array([r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()])
    exact = ward.ward_merges(x.astype(float), np.ones(len(x)))[-18:]
    got = entry.queries()["ward_last_merges"](spark, "/root/testdata/sf0.001").orderBy("step").collect()
    assert np.allclose([r["height"] for r in got], [m[2] for m in exact])
    assert [r["rows"] for r in got] == [m[3] for m in exact]


@pytest.mark.parametrize("df", [5, 40, 24_999, 25_001, 1e7])
def test_studentized_range_is_one_formula(df):
    # two means: Q / sqrt(2) is a t statistic, so the tail is a two-sided p of t
    t = 1.7
    want = distributions.beta_inc(df / 2, 0.5, df / (df + t * t))
    assert abs(distributions.studentized_range_tail(t * 2 ** 0.5, 2, df) - want) < 1e-6


def test_som(spark):
    df = frame(spark, blobs())
    model = som.train_som(df, 5, 5, rough=6, fine=6)
    assert model.history[-1] < model.history[0]
    units = som.best_units(df, model)
    found = som.assign_clusters(units, som.cluster_nodes(model, spark, 3)).collect()
    assert len(found) == 150 and all(r["cluster"] is not None for r in found)
    errors = som.map_errors(units, 5).first()
    assert 0 <= errors["topographic_error"] <= 1 and errors["quantization_error"] > 0
    book = model.codebook_table(spark)
    assert som.hit_counts(units, book).agg({"hits": "sum"}).first()[0] == 150
    assert som.u_matrix(book).count() == 25 and som.component_planes(book, ["a", "b", "c"]).count() == 75


def test_kmeans(spark):
    line = frame(spark, [0.0, 1.0, 10.0, 11.0])
    costs = [r["inertia"] for r in kmeans.elbow(line, 3).orderBy("k").collect()]
    assert np.isclose(costs[0], 101) and costs[0] >= costs[1] >= costs[2] and np.isclose(costs[1], 1)
    fit = kmeans.fit_kmeans(frame(spark, blobs()), 3, n_init=2)
    assert sorted(r["count"] for r in fit.assigned.groupBy("cluster").count().collect()) == [50, 50, 50]
    by_k = quality.silhouette_by_k(frame(spark, blobs(60)), ks=(2, 3)).collect()
    assert by_k[1]["silhouette"] > by_k[0]["silhouette"]


def test_forest(spark):
    rows_ = [(i, i % 3, float(i % 3), float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows_, "sku_key bigint, cluster int, signal double, noise double")
    ranked, predicted = supervised.feature_importance(df, ["signal", "noise"], trees=10)
    assert [r["feature"] for r in ranked.collect()] == ["noise", "signal"]
    report = {r["row"]: r for r in supervised.classification_report(predicted).collect()}
    assert report["accuracy"]["f1"] == 1.0 and {"0", "1", "2", "macro avg", "weighted avg"} < set(report)


def test_series_kernels():
    rng = np.random.default_rng(2)
    noise = rng.normal(size=400)
    ar = np.zeros(400)
    for i in range(1, 400):
        ar[i] = 0.7 * ar[i - 1] + noise[i]
    out = kernels.autoregression(ar)
    assert abs(out["ar_coefficient__coeff_1__k_10"] - 0.7) < 0.15
    stat, p, lags = kernels.dickey_fuller(ar)
    assert stat < -4 and p < 0.01
    assert kernels.dickey_fuller(np.cumsum(noise))[1] > 0.05
    assert kernels.permutation_entropy(np.arange(20.0), 3) == 0
    assert kernels.sample_entropy(np.tile([0.0, 1.0], 50)) < kernels.sample_entropy(noise[:100])
    assert np.isclose(kernels.welch_density(noise).sum() / 256, noise.var(), rtol=0.2)
    wave = np.sin(np.arange(100) * 2 * np.pi / 20)
    assert 3 <= kernels.ridge_peaks(wave, 5) <= 7
    assert kernels.lempel_ziv(np.zeros(30) + np.arange(30) % 2, 2) < kernels.lempel_ziv(noise[:30], 10)
    slow = [kernels.approximate_entropy(np.tile([0.0, 1.0, 2.0], 30))[0]]
    assert slow[0] < 0.05


def test_kernels_on_tables_of_series():
    """Rows of one length together against plain loops over one series at a time."""
    rng = np.random.default_rng(5)
    given = [rng.integers(0, 9, n).astype(float) for n in [*range(1, 30), 60] for _ in range(3)]
    given += [np.zeros(12), np.arange(12.0), np.array([0.0, 1.0] * 6)]  # constant, rank-deficient, periodic

    def near(x, m, limit):
        w = [x[i:i + m] for i in range(len(x) - m + 1)]
        return np.array([sum(np.abs(a - b).max() <= limit for b in w) for a in w])

    def entropy(x, d):
        seen = collections.Counter(tuple(np.argsort(x[i:i + d], kind="stable")) for i in range(len(x) - d + 1))
        p = np.array(list(seen.values())) / (len(x) - d + 1)
        return -(p * np.log(p)).sum()
    found = features.by_length(given, kernels.complexity, len(kernels.COMPLEXITY_FIELDS))
    moved = features.by_length(given, kernels.dynamics, len(kernels.DYNAMICS_FIELDS))
    for x, row, move in zip(given, found, moved):
        row, n = dict(zip(kernels.COMPLEXITY_FIELDS, row)), len(x)
        for r in (0.1, 0.9):
            got = row[f"approximate_entropy__m_2__r_{str(r).replace('.', '_')}"]
            if n > 3:
                phi = [np.log(near(x, m, r * x.std()) / (n - m + 1)).mean() for m in (2, 3)]
                assert np.isclose(got, abs(phi[0] - phi[1]))
            else:
                assert np.isnan(got)
        for d in (3, 7):
            got = row[f"permutation_entropy__dimension_{d}__tau_1"]
            assert np.isclose(got, entropy(x, d)) if n >= d else np.isnan(got)
        phrases, bins = {()}, np.minimum(np.maximum(np.ceil((x - x.min()) / max(np.ptp(x), 1) * 2), 1), 2)
        phrase = ()
        for symbol in bins:
            phrase += (symbol,)
            if phrase not in phrases:
                phrases.add(phrase)
                phrase = ()
        assert np.isclose(row["lempel_ziv_complexity__bins_2"], (len(phrases) - 1) / n)
        most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
        fits = [(kernels._dickey_fuller_fit(x, k, most)[1], k) for k in range(most + 1)] if n > 4 and x.std() else []
        fits = [f for f in fits if not np.isnan(f[0])]
        stat = kernels._dickey_fuller_fit(x, min(fits)[1], min(fits)[1])[0] if fits else np.nan
        assert np.isclose(move[0], stat, equal_nan=True) and (np.isnan(stat) or move[2] == min(fits)[1])


def test_levels(spark):
    rng = np.random.default_rng(9)
    given = {1: 10 ** rng.uniform(-4, 9, 200) * rng.choice([-1, 1], 200), 2: np.zeros(5), 3: np.arange(1.0, 10), 4: np.array([1e-7, -30.0])}
    first = datetime.date(2000, 1, 1)
    df = spark.createDataFrame([(k, first + datetime.timedelta(i), float(v)) for k, x in given.items() for i, v in enumerate(x)],
                               "sku_key bigint, tran_date date, sales double")
    got = {r["sku_key"]: r.asDict() for r in features.extract_features(df, "sales", ["levels"]).collect()}
    law = np.log10(1 + 1 / np.arange(1, 10))
    for key, x in given.items():
        row = got[key]
        assert np.isclose(row["sales__count_above__t_0"], (x >= 0).mean())
        assert np.isclose(row["sales__count_below__t_0"], (x <= 0).mean())
        top = row["sales__mean_n_absolute_max__number_of_maxima_7"]
        assert np.isclose(top, np.sort(np.abs(x))[-7:].mean()) if len(x) > 7 else top is None
        digits = np.array([int(np.format_float_scientific(abs(v))[0]) for v in x])
        shares = np.array([(digits == d).mean() for d in range(1, 10)])
        found = row["sales__benford_correlation"]
        assert found is None if shares.std() < 1e-12 else np.isclose(found, np.corrcoef(law, shares)[0, 1])
    assert got[1]["sales__benford_correlation"] > 0.8


def by_hand(x, lags):
    """Last coefficient of the Yule-Walker system of each order."""
    d, n = x - x.mean(), len(x)
    g = np.array([d[:n - k] @ d[k:] / (n - k) for k in range(lags + 1)])
    return [1.0] + [np.linalg.solve(g[np.abs(np.subtract.outer(range(k), range(k)))], g[1:k + 1])[-1]
                    for k in range(1, lags + 1)]


def test_spectrum_and_partial_autocorrelation(spark):
    rng = np.random.default_rng(4)
    noise = rng.normal(size=300)
    ar = np.zeros(300)
    for i in range(1, 300):
        ar[i] = 0.7 * ar[i - 1] + noise[i]
    given = {1: ar, 2: noise[:7], 3: np.full(9, 2.0), 4: noise[:2], 5: np.zeros(8),
             6: np.sin(np.arange(100) * 2 * np.pi / 20), 7: noise[:1], 8: noise[:12]}
    first = datetime.date(2000, 1, 1)
    df = spark.createDataFrame([(k, first + datetime.timedelta(i), float(v)) for k, x in given.items() for i, v in enumerate(x)],
                               "sku_key bigint, tran_date date, sales double")
    got = {r["sku_key"]: r.asDict() for r in features.extract_features(df, "sales", ["spectrum", "partial"]).collect()}
    assert set(got) == set(given)
    for key, x in given.items():
        row, c = got[key], np.fft.rfft(x)
        for k in range(features.DFT_COEFFICIENTS):
            want = c[k] if k < len(c) else None
            for part, value in (("real", np.real), ("imag", np.imag), ("abs", np.abs)):
                found = row[f"sales__fft_coefficient__attr_{part}__coeff_{k}"]
                assert found is None if want is None else np.isclose(found, value(want), atol=1e-9)
            if want is not None and abs(want) > 1e-6:
                assert np.isclose(row[f"sales__fft_coefficient__attr_angle__coeff_{k}"], np.degrees(np.angle(want)), atol=1e-5)
        size, at = np.abs(c), np.arange(len(c))
        if size.sum():
            mean = size @ at / size.sum()
            assert np.isclose(row["sales__fft_aggregated__aggtype_centroid"], mean, atol=1e-9)
            assert np.isclose(row["sales__fft_aggregated__aggtype_variance"], size @ (at - mean) ** 2 / size.sum(), atol=1e-9)
        lags = min(9, len(x) // 2 - 1) if np.var(x) > 0 else 0
        partial = [row[f"sales__partial_autocorrelation__lag_{i}"] for i in range(10)]
        if lags > 0:
            assert np.allclose(partial[:lags + 1], by_hand(x, lags), rtol=1e-6, atol=1e-9)
            assert partial[lags + 1:] == [None] * (9 - lags)
        else:
            assert partial == [None] * 10
    assert abs(got[1]["sales__partial_autocorrelation__lag_1"] - 0.7) < 0.1
    assert got[3]["sales__fft_coefficient__attr_angle__coeff_0"] == 0.0
    assert got[5]["sales__fft_aggregated__aggtype_centroid"] is None


def test_settled_kmeans_collects_only_cells_that_changed(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(3000, 2)) * 50, rng.random((3000, 6)) < 0.2])
    x = np.vstack([x, x[:200]])
    sent, real = [], kmeans._moved_rows

    def noted(blocks, before, centres):
        out = real(blocks, before, centres)
        sent.append((before is None, int((out[0] != 0).any(axis=1).sum()), centres))
        return out
    monkeypatch.setattr(kmeans, "_moved_rows", noted)
    fit = kmeans.fit_settled(frame(spark, x), 40, seed=3)
    centres = sent[0][2]
    while True:  # a plain run from the same start
        near = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        after = np.array([x[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
        still = ((after - centres) ** 2).sum(axis=1).max() <= kmeans.STAYS ** 2
        centres = after
        if still:
            break
    assert np.allclose(fit.centres, centres)
    changes = [n for whole, n, _ in sent if not whole]
    assert len(changes) > 5 and changes[-2] < 40 / 2


def test_map_epochs_read_rows_packed_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x, book = rng.normal(size=(700, 4)), rng.normal(size=(9, 4))
    sums, hits, gap = som.block_sums(som.packed_blocks(frame(spark, x)), book)
    d = ((x[:, None, :] - book) ** 2).sum(axis=2)
    near = d.argmin(axis=1)
    assert np.array_equal(hits, np.bincount(near, minlength=9)) and np.isclose(gap, np.sqrt(d.min(axis=1)).mean())
    assert np.allclose(sums, [x[near == c].sum(axis=0) for c in range(9)])
    packed, real = [], som.packed_blocks
    monkeypatch.setattr(som, "packed_blocks", lambda df: packed.append(1) or real(df))
    assert len(som.train_som(frame(spark, x), 3, 3, rough=3, fine=2).history) == 5 and packed == [1]


def test_wavelets_and_p_values_look_up_what_repeats():
    rng = np.random.default_rng(7)
    kernels._ricker.cache_clear()
    for _ in range(20):
        kernels.wavelets(rng.normal(size=30))
    assert kernels._ricker.cache_info().hits > kernels._ricker.cache_info().misses
    x = np.array([0.0, 2.0, 1.0, 1.0, 3.0, 0.0, 0.0, 4.0, 1.0])
    m = kernels.ricker_transform(x, 1)
    tops = [i for i in range(1, 8) if m[i - 1] < m[i] > m[i + 1]]
    noise = np.percentile(np.abs(m), 10)
    assert kernels.ridge_peaks(x, 1) == sum(m[i] >= noise for i in tops) and kernels.ridge_peaks(x[:2], 1) == 0
    sizes = np.array([0.5, 1.0, 0.5, 30.0])
    assert distributions._log_gamma(sizes).tolist() == [math.lgamma(v) for v in sizes]
    assert len(distributions._log_gamma(np.empty(0))) == 0
