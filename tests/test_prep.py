import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom import session, sources
from seriesloom.operators import prep, ranking, reports, scale, stats

D = [dt.date(2020, 1, i) for i in range(1, 10)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text("Unnamed: 0,sku_key,tran_date,sales,selling_price,avg_discount,stock_open,sku_department\n"
                    "0,1,2020-01-01,2.0,NaN,,5,A\n1,2,2020-01-02,3,1.5,0.1,7,\n")
    tx = sources.read_transactions(spark, str(path))
    assert tx.columns == ["sku_key", "tran_date", "sales", "selling_price", "avg_discount",
                          "stock_open", "sku_department"]
    first = tx.orderBy("sku_key").first()
    assert first["selling_price"] is None and first["avg_discount"] is None
    kept = sources.read_keep_blanks(spark, str(path), sources.TRANSACTIONS).orderBy("sku_key").collect()
    assert kept[1]["sku_department"] == "" and kept[0]["avg_discount"] is None
    narrow = tmp_path / "narrow.csv"
    narrow.write_text("Unnamed: 0,skukey,tran_date,quantity\n0,7,2020-01-01,4\n")
    got = sources.read_narrow(spark, str(narrow))
    assert rows(got) == [(7, D[0], 4.0)]
    for fmt, schema in (("parquet", None), ("csv", sources.ASSIGNMENTS)):
        df = spark.createDataFrame([(1, 2)], sources.ASSIGNMENTS)
        sources.write_table(df, str(tmp_path / fmt), fmt)
        assert rows(sources.read_table(spark, str(tmp_path / fmt), fmt, schema)) == [(1, 2)]


def test_product_day(spark):
    tx = spark.createDataFrame(
        [(1, D[0], 1.0, 2.0, 0.0, 4.0), (1, D[0], 2.0, 4.0, 0.0, 6.0), (1, D[1], None, None, None, None),
         (None, D[0], 9.0, 9.0, 9.0, 9.0)],
        "sku_key bigint, tran_date date, sales double, selling_price double, avg_discount double, stock_open double")
    assert rows(prep.product_day(tx)) == [(1, D[0], 3.0, 3.0, 0.0, 5.0), (1, D[1], 0.0, None, None, None)]
    assert rows(prep.product_day(tx, "sum").select("stock_open")) == [(0.0,), (10.0,)]
    with pytest.raises(ValueError):
        prep.product_day(tx, "max")


def test_first_labels_takes_whole_rows(spark):
    tx = spark.createDataFrame(
        [(1, D[0], "A"), (1, D[1], "B"), (2, D[0], None), (2, D[1], "C")],
        "sku_key bigint, tran_date date, sku_department string")
    got = prep.first_labels(tx, ["tran_date"], ["sku_department"])
    assert sorted((r[0], r[1]) for r in got.collect()) == [(1, "A"), (2, None)]


def test_pivot_and_splits(spark):
    days = spark.createDataFrame([("a", D[0], 1.0), ("b", D[1], None)],
                                 "sku_key string, tran_date date, sales double")
    cells = prep.pivot_long(days)
    assert prep.pivot_wide(cells).columns == ["sku_key", "2020-01-01"] and cells.count() == 1
    cells = spark.createDataFrame(
        [(1, D[0], 5.0), (1, D[2], 7.0), (2, D[1], 1.0)], "sku_key bigint, tran_date date, sales double")
    assert rows(prep.start_flags(cells)) == [(1, False), (2, True)]
    assert rows(prep.split_on_start(cells, prep.start_flags(cells), "nan").select("sku_key")) == [(2,)]
    with pytest.raises(ValueError):
        prep.split_on_start(cells, prep.start_flags(cells), "other")
    assert rows(prep.null_counts(cells)) == [(1, 1), (2, 2)]
    filled = {r[0]: r[1] for r in prep.series(cells, fill=True).collect()}
    assert filled == {1: [5.0, 0.0, 7.0], 2: [0.0, 1.0, 0.0]}
    assert {r[0]: r[1] for r in prep.series(cells).collect()} == {1: [5.0, 7.0], 2: [1.0]}
    grid = prep.coverage_map(cells)
    assert grid.count() == 6 and grid.where("is_missing").count() == 3


def test_run_series(spark):
    """Runs against arrays filled by hand: gaps, zeros, repeated values and nulls at any place."""
    rng = random.Random(6)
    days = [dt.date(2021, 1, 1) + dt.timedelta(2 * i) for i in range(9)]
    cells = {(k, d): rng.choice([0.0, 1.0, 1.0, 2.5, None]) for k in range(40) for d in rng.sample(days, rng.randint(1, 9))}
    cells |= {(90, d): 3.0 for d in days} | {(91, days[-1]): 1.0, (92, days[0]): 0.0}
    df = spark.createDataFrame([(k, d, v) for (k, d), v in cells.items()], "sku_key bigint, tran_date date, sales double")
    want = {k: [cells.get((k, d)) or 0.0 for d in days] for k in {k for k, _ in cells}}
    runs = {r["sku_key"]: [tuple(x) for x in r["runs"]] for r in prep.run_series(df).collect()}
    assert runs == {k: [(v, len(list(g))) for v, g in itertools.groupby(x)] for k, x in want.items()}
    assert {r["sku_key"]: r["series"] for r in prep.series(df, fill=True).collect()} == want
    assert runs[90] == [(3.0, 9)] and runs[92] == [(0.0, 9)]
    assert prep.run_series(df.limit(0)).collect() == []


def test_sampling(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    picked = prep.sample_exact(df, 700, ["k"], 3)
    assert picked.count() == 700 and picked.distinct().count() == 700
    train, test = prep.train_test_split(df, ["k"])
    assert train.count() + test.count() == 5000 and abs(train.count() - 3750) < 150


def test_one_hot_and_lookup(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k bigint, c string")
    assert rows(prep.one_hot(df, ["c"])) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    m = spark.createDataFrame([("x", 10)], "level string, code int")
    got = prep.lookup(df, "c", m, "level", "code", "code")
    assert {r["k"]: r["code"] for r in got.collect()} == {1: 10, 2: None, 3: None}


def test_sorted_rank_and_factorize(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert all(r["v"] == r["rank"] for r in ranking.sorted_rank(df, ["v"]).collect())
    f = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "k int, c string")
    got = {r["k"]: r["code"] for r in ranking.factorize(f, "c", ["k"], "code").collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(0)
    data = [("hot", float(v)) for v in rng.integers(0, 50, 3000)] + \
        [("real", float(v)) for v in rng.normal(size=400)] + [("one", 5.0), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "g string, v double")
    qs = [0.0, 0.025, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in ranking.exact_quantiles(df, ["g"], "v", qs).collect()}
    for g in ("hot", "real", "one", "two"):
        assert np.allclose(got[g], np.quantile([v for k, v in data if k == g], qs))
    whole = ranking.exact_quantiles(df, [], "v", [0.5]).first()
    assert np.isclose(whole["quantiles"][0], np.median([v for _, v in data]))


def test_scalers(spark):
    df = spark.createDataFrame([(1, 1.0, 7.0), (2, 2.0, 7.0), (3, 6.0, 7.0)], "sku_key bigint, a double, b double")
    for method, want in (("standard", (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])),
                         ("minmax", [0, 0.2, 1]), ("robust", [-0.4, 0, 1.6])):
        got = scale.scale(df, ["a", "b"], method).orderBy("sku_key").collect()
        assert np.allclose([r["a"] for r in got], want) and all(r["b"] == 0 for r in got)
    fitted = scale.fit_scaler(df, ["a"])
    back = fitted.inverse(fitted.transform(df)).orderBy("sku_key").collect()
    assert np.allclose([r["a"] for r in back], [1, 2, 6])
    holes = df.withColumn("c", F.when(F.col("sku_key") > 1, 1.0))
    assert scale.complete_columns(holes).columns == ["sku_key", "a", "b"]


def _reports(spark, values):
    days = spark.createDataFrame([(i, D[i % 9], v) for i, v in enumerate(values)],
                                 "sku_key bigint, tran_date date, sales double")
    asg = spark.createDataFrame([(i, 0) for i in range(len(values))], "sku_key bigint, cluster int")
    return reports.ClusterReports(asg, days)


def test_rolling_mean(spark):
    r = _reports(spark, [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0]).rolling_mean(["sales"], 3)
    assert [x[0] for x in r.orderBy("tran_date").select("rolling_sales").collect()] == \
        [None, None, 2.0, None, None, None, 6.0]


def test_box_and_histogram(spark):
    b = _reports(spark, [1.0, 2.0, 3.0, 4.0, 100.0]).box(["sales"]).first()
    assert (b["q1"], b["median"], b["q3"]) == (2.0, 3.0, 4.0)
    assert (b["whisker_low"], b["whisker_high"], b["n_outliers"]) == (2.0, 4.0, 2)
    h = _reports(spark, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 10.0]).histogram(["sales"]).collect()
    assert {r["bin"] for r in h if r["n"] == 1} == {1, 3, 5, 7, 9, 11, 20} and len(h) == 20
    flat = _reports(spark, [3.0, 3.0]).histogram(["sales"]).where("n > 0").first()
    assert flat["n"] == 2 and flat["bin"] == 11


def test_described_for_cluster_ids_above_nine(spark):
    days = spark.createDataFrame([(1, D[0], 2.0), (2, D[0], 3.0)], "sku_key bigint, tran_date date, sales double")
    asg = spark.createDataFrame([(1, 1), (2, 11)], "sku_key bigint, cluster int")
    got = rows(reports.ClusterReports(asg, days).described())
    assert got == [(1, 1, "2.0 sales per day"), (2, 11, "3.0 sales per day")]


def test_anova_and_tukey(spark):
    df = spark.createDataFrame([(c, float(v)) for c, vs in enumerate(((1, 2, 3), (2, 3, 4), (5, 6, 7)))
                                for v in vs], "cluster int, value double")
    a = stats.anova(df).first()
    assert np.allclose([a["ss_between"], a["ss_within"], a["f"], a["p"]], [26, 6, 13, 0.006591796875])
    assert (a["df_between"], a["df_within"]) == (2, 6)
    t = {(r["group1"], r["group2"]): r for r in stats.tukey(df).collect()}
    assert np.allclose([t[k]["q"] for k in ((0, 1), (0, 2), (1, 2))], [1.7320508, 6.9282032, 5.1961524])
    assert np.isclose(t[(0, 1)]["se"], 0.5773503) and not t[(0, 1)]["reject"] and t[(0, 2)]["reject"]
    assert np.isclose((t[(0, 1)]["upper"] - t[(0, 1)]["lower"]) / 2 / t[(0, 1)]["se"], 4.339, atol=2e-3)


@pytest.mark.parametrize("slice_rows", [7, 1_000_000])
def test_quantile_slices_grow_with_the_group(spark, slice_rows):
    values = [float(i * 37 % 1009) for i in range(1009)] + [5.0] * 300
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = ranking.exact_quantiles(df, [], "x", [0.0, 0.025, 0.5, 0.9, 1.0], slice_rows).first()
    assert got["n"] == len(values)
    assert np.allclose(got["quantiles"], np.quantile(values, [0.0, 0.025, 0.5, 0.9, 1.0]))


def test_sample_and_split_do_not_hang_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "sku_key")
    picked = {r[0] for r in prep.sample_exact(df, 300, ["sku_key"], 1).collect()}
    assert len(picked) == 300
    assert picked == {r[0] for r in prep.sample_exact(df.repartition(13), 300, ["sku_key"], 1).collect()}
    train, test = prep.train_test_split(df, ["sku_key"])
    assert train.count() + test.count() == 5000 and abs(train.count() - 3750) < 150


def test_coverage_grid_is_made_behind_the_last_sort(spark, capsys):
    cells = spark.createDataFrame(
        [(1, D[0], 5.0), (1, D[2], 7.0), (2, D[1], 1.0)], "sku_key bigint, tran_date date, sales double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with ranks too many to broadcast
    try:
        grid = prep.coverage_map(cells)
        grid.explain()
        lines = capsys.readouterr().out.splitlines()
        made = next(i for i, line in enumerate(lines) if "Generate explode(sequence" in line)
        assert not any("Exchange hash" in line or "SortMergeJoin" in line for line in lines[:made])
        got = sorted(tuple(r) for r in grid.select("rank", "sku_key", "tran_date", "sales").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(0, 1, D[0], 5.0), (0, 1, D[1], None), (0, 1, D[2], 7.0),
                   (1, 2, D[0], None), (1, 2, D[1], 1.0), (1, 2, D[2], None)]


def test_tasks_behind_a_shuffle_are_bounded(spark):
    key, size = session.TASK_INPUT
    assert spark.conf.get(key) == size
    try:
        spark.conf.unset(key)
        session.bound_tasks(spark)
        assert spark.conf.get(key) == size
        spark.conf.set(key, "64m")  # a size of the session's own stays
        session.bound_tasks(spark)
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.set(key, size)
