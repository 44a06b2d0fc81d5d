"""Scaling, maps, clustering, neighbours, warping and model quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from seriesloom.functions.columns import snap
from seriesloom.session import durable
from seriesloom.operators import (density, dtw, embed, features as feat, kmeans, neighbours, prep,
                                  quality, scale, som, supervised, vectors, ward)
from seriesloom.plans.binding import table

from . import register
from .views import TX, bands, cells, cells_sql, days, days_sql, snap_sql

# ------------------------------------------------------------------ scaling

P = f"""WITH {TX}, {days_sql()},
p AS (SELECT sku_key, sum(sales) AS sales, avg(selling_price) AS selling_price,
             CAST(count(*) AS DOUBLE) AS n_days, CAST(1 AS DOUBLE) AS one FROM pd GROUP BY 1)"""
SCALED = ["sales", "selling_price", "n_days", "one"]


def _products(spark, sf_dir):
    return days(spark, sf_dir).groupBy("sku_key").agg(
        F.sum("sales").alias("sales"), F.avg("selling_price").alias("selling_price"),
        F.count(F.lit(1)).cast("double").alias("n_days"), F.lit(1.0).alias("one"))


def _scaled_sql(center, width):
    out = ", ".join(
        f"{snap_sql('coalesce((%s - %s) / nullif(%s, 0), %s - %s)' % (c, center(c), width(c), c, center(c)))} AS {c}"
        for c in SCALED)
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS n_{c}, max({c}) AS x_{c}, "
                      f"quantile_cont({c}, 0.25) AS l_{c}, median({c}) AS m_{c}, quantile_cont({c}, 0.75) AS h_{c}"
                      for c in SCALED)
    return f"{P}, st AS (SELECT {stats} FROM p) SELECT sku_key, {out} FROM p, st"


def _scaled(spark, sf_dir, method):
    df = scale.scale(_products(spark, sf_dir), SCALED, method)
    return df.withColumns({c: snap(c) for c in SCALED})


@register("scale_standard", _scaled_sql(lambda c: f"a_{c}", lambda c: f"s_{c}"))
def scale_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@register("scale_minmax", _scaled_sql(lambda c: f"n_{c}", lambda c: f"(x_{c} - n_{c})"))
def scale_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@register("scale_robust", _scaled_sql(lambda c: f"m_{c}", lambda c: f"(h_{c} - l_{c})"))
def scale_robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


SEASONS = {"half_": "CAST((month(tran_date) + 5) // 6 AS VARCHAR)",
           "quarter_": "CAST(quarter(tran_date) AS VARCHAR)", "month_": "CAST(month(tran_date) AS VARCHAR)"}


@register("complete_features", f"""
WITH {TX}, {days_sql()}, f AS ({' UNION ALL '.join(
    f"SELECT sku_key, '{n}' || {e} AS feature, avg(sales) AS value FROM pd GROUP BY 1, 2" for n, e in SEASONS.items())})
SELECT * FROM f WHERE feature IN (SELECT feature FROM f GROUP BY 1
                                  HAVING count(value) = (SELECT count(DISTINCT sku_key) FROM f))""")
def complete_features(spark, sf_dir):
    """Seasonal means in long form; seasons in which a product has no sale drop out."""
    month = F.month("tran_date")
    parts = {"half_": F.floor((month + 5) / 6), "quarter_": F.quarter("tran_date"), "month_": month}
    names = F.array(*[F.concat(F.lit(n), e.cast("string")) for n, e in parts.items()])
    long = days(spark, sf_dir).select("sku_key", "sales", F.explode(names).alias("feature")).groupBy(
        "sku_key", "feature").agg(F.avg("sales").alias("value"))
    return scale.complete_features(long)


@register("complete_columns")
def complete_columns(spark, sf_dir):
    return scale.complete_columns(feat.extract_features(days(spark, sf_dir), "sales", ["shape", "lagged", "trend"]))


# ------------------------------------------------------------ vectors, codebook

E = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
BOOK = f"""{E}, u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
mu AS (SELECT label, i, avg(x) AS w FROM u GROUP BY 1, 2),
book AS (SELECT label AS node, label // 5 AS bx, label % 5 AS "by", list(w ORDER BY i) AS w FROM mu GROUP BY 1)"""
NEAR = f"""{BOOK}, d AS (SELECT vec_id, node, list_distance(v, w) AS dist FROM e CROSS JOIN book),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, node) AS rn FROM d),
bmu AS (SELECT a.vec_id, a.node, a.dist, b.node AS second FROM r a JOIN r b USING (vec_id)
        WHERE a.rn = 1 AND b.rn = 2)"""


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def _label_means(df) -> np.ndarray:
    """One mean vector per label, the codebook of the SQL-checked map queries."""
    mean = df.select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("w"))
    rows = mean.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("w")).orderBy("label")
    return np.array([[e["w"] for e in r["w"]] for r in rows.collect()])


def _map(df) -> som.SomModel:
    book = _label_means(df)
    return som.SomModel(2, 5, book, np.zeros(book.shape[1]), np.ones(book.shape[1]), "vec_id")


@register("som_best_units", f"{NEAR} SELECT vec_id, CAST(node AS INTEGER) AS node, {snap_sql('dist')} AS dist, CAST(second AS INTEGER) AS second FROM bmu")
def som_best_units(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    return som.best_units(df, _map(df)).withColumn("dist", snap("dist"))


@register("som_map_errors", f"""{NEAR}
SELECT {snap_sql('avg(dist)')} AS quantization_error,
       {snap_sql('avg(CAST(abs(node // 5 - second // 5) > 1 OR abs(node % 5 - second % 5) > 1 AS INTEGER))')} AS topographic_error
FROM bmu""")
def som_map_errors(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    model = _map(df)
    e = som.map_errors(som.best_units(df, model), model.columns)
    return e.select(*[snap(c).alias(c) for c in e.columns])


@register("som_hit_counts", f"""{NEAR}
SELECT CAST(b.node AS INTEGER) AS node, CAST(bx AS INTEGER) AS x, CAST("by" AS INTEGER) AS y, count(vec_id) AS hits
FROM book b LEFT JOIN bmu USING (node) GROUP BY 1, 2, 3""")
def som_hit_counts(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    model = _map(df)
    return som.hit_counts(som.best_units(df, model), model.codebook_table(spark))


@register("som_u_matrix", f"""{BOOK}
SELECT CAST(a.node AS INTEGER) AS node, {snap_sql('avg(list_distance(a.w, b.w))')} AS mean_gap
FROM book a JOIN book b ON a.node <> b.node AND abs(a.bx - b.bx) <= 1 AND abs(a."by" - b."by") <= 1 GROUP BY 1""")
def som_u_matrix(spark, sf_dir):
    model = _map(_vectors(spark, sf_dir))
    return som.u_matrix(model.codebook_table(spark)).withColumn("mean_gap", snap("mean_gap"))


@register("som_component_planes", f"""{BOOK}
SELECT CAST(label AS INTEGER) AS node, CAST(label // 5 AS INTEGER) AS x, CAST(label % 5 AS INTEGER) AS y,
       'f' || (i - 1) AS feature, {snap_sql('w')} AS weight FROM mu""")
def som_component_planes(spark, sf_dir):
    model = _map(_vectors(spark, sf_dir))
    names = [f"f{i}" for i in range(model.codebook.shape[1])]
    return som.component_planes(model.codebook_table(spark), names).withColumn("weight", snap("weight"))


@register("som_one_step", f"""{NEAR},
h AS (SELECT a.node, b.node AS other, exp(-((a.bx - b.bx) ** 2 + (a."by" - b."by") ** 2) / 2.0) AS h
      FROM book a CROSS JOIN book b),
s AS (SELECT node AS other, i, sum(x) AS s, count(*) AS n
      FROM (SELECT bmu.node, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e JOIN bmu USING (vec_id)) GROUP BY 1, 2)
SELECT CAST(h.node AS INTEGER) AS node, CAST(i - 1 AS INTEGER) AS i, {snap_sql('sum(h * s) / sum(h * n)')} AS weight
FROM h JOIN s USING (other) GROUP BY h.node, i""")
def som_one_step(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    model = _map(df)
    sums, hits, _ = som.batch_sums(df, model.codebook)
    model.codebook = som.update(model.codebook, sums, hits, model.grid, 1.0)
    return model.codebook_table(spark).select("node", F.posexplode("weights").alias("i", "w")).select(
        "node", "i", snap("w").alias("weight"))


@register("som_clusters")
def som_clusters(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    model = som.train_som(df, 15, 15, rough=20, fine=20, key="vec_id")
    return som.assign_clusters(som.best_units(df, model), som.cluster_nodes(model, spark, 4), "vec_id")


@register("som_product_clusters")
def som_product_clusters(spark, sf_dir):
    """The winning model on product features: complete columns, scaled, map, k-means."""
    table_ = durable(scale.complete_columns(feat.extract_features(
        days(spark, sf_dir), "sales")))
    v = vectors.to_vectors(table_, [c for c in table_.columns if c != "sku_key"])
    model = som.train_som(v, 15, 15)
    return som.assign_clusters(som.best_units(v, model), som.cluster_nodes(model, spark, 4))


# --------------------------------------------------------------------- k-means

@register("kmeans_given_centres", f"{NEAR} SELECT {snap_sql('sum(dist * dist)', 4)} AS inertia, count(*) AS n FROM bmu")
def kmeans_given_centres(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    found = vectors.nearest(df, _label_means(df), "vec_id", name="cluster")
    return found.agg(snap(F.sum(F.col("dist") * F.col("dist")), 4).alias("inertia"), F.count(F.lit(1)).alias("n"))


@register("elbow_single_cluster", f"""{E}, u AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e)
SELECT {snap_sql('sum(ss)', 4)} AS inertia FROM (SELECT i, var_pop(x) * count(*) AS ss FROM u GROUP BY 1)""")
def elbow_single_cluster(spark, sf_dir):
    return kmeans.single_cluster_inertia(_vectors(spark, sf_dir)).select(snap("inertia", 4).alias("inertia"))


@register("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    return kmeans.fit_kmeans(_vectors(spark, sf_dir), 4, n_init=2, key="vec_id").assigned


@register("kmeans_elbow")
def kmeans_elbow(spark, sf_dir):
    return kmeans.elbow(_vectors(spark, sf_dir), key="vec_id")


# ------------------------------------------------------------------ silhouettes

SIL = f"""{E}, d AS (SELECT a.vec_id, a.label AS cluster, b.label AS other, sum({{dist}}) AS s, count(*) AS n
  FROM e a CROSS JOIN e b GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, cluster, max(s / nullif(n - 1, 0)) FILTER (cluster = other) AS a,
              min(s / n) FILTER (cluster <> other) AS b FROM d GROUP BY 1, 2),
sil AS (SELECT vec_id, cluster, a, b, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""
EUCLID = SIL.format(dist="list_distance(a.v, b.v)")


def _by_label(spark, sf_dir):
    return _vectors(spark, sf_dir).withColumnRenamed("label", "cluster")


def _samples(spark, sf_dir, metric="euclidean"):
    s = quality.silhouette_samples(_by_label(spark, sf_dir), "vec_id", metric)
    return s.withColumns({c: snap(c) for c in ("a", "b", "silhouette")})


SAMPLES = f"SELECT vec_id, cluster, {snap_sql('a')} AS a, {snap_sql('b')} AS b, {snap_sql('s')} AS silhouette FROM sil"


@register("silhouette_samples", f"{EUCLID} {SAMPLES}")
def silhouette_samples(spark, sf_dir):
    return _samples(spark, sf_dir)


@register("silhouette_squared", f"{SIL.format(dist='list_distance(a.v, b.v) ** 2')} {SAMPLES}")
def silhouette_squared(spark, sf_dir):
    return _samples(spark, sf_dir, "sqeuclidean")


@register("silhouette_score", f"{EUCLID} SELECT {snap_sql('avg(s)')} AS silhouette FROM sil")
def silhouette_score(spark, sf_dir):
    samples = quality.silhouette_samples(_by_label(spark, sf_dir), "vec_id")
    return quality.silhouette_score(samples).select(snap("silhouette").alias("silhouette"))


@register("silhouette_bands", f"""{EUCLID}, z AS (SELECT vec_id, cluster, {snap_sql('s')} AS silhouette FROM sil),
k AS (SELECT cluster, row_number() OVER (ORDER BY cluster) AS band FROM (SELECT DISTINCT cluster FROM z))
SELECT vec_id, cluster, silhouette, row_number() OVER (PARTITION BY cluster ORDER BY silhouette, vec_id) AS rank,
       row_number() OVER (ORDER BY cluster, silhouette, vec_id) - 1 + band * 10 AS position FROM z JOIN k USING (cluster)""")
def silhouette_bands(spark, sf_dir):
    return quality.silhouette_bands(_samples(spark, sf_dir))


@register("silhouette_by_k")
def silhouette_by_k(spark, sf_dir):
    return quality.silhouette_by_k(_vectors(spark, sf_dir), n_init=10, key="vec_id")


# --------------------------------------------------------- neighbours, embedding

@register("nearest_neighbours", f"""{E},
d AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbour, {snap_sql('dist')} AS dist, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour) AS rank FROM d) WHERE rank <= 5""")
def nearest_neighbours(spark, sf_dir):
    return neighbours.knn(_vectors(spark, sf_dir), 5, "vec_id").withColumn("dist", snap("dist"))


@register("fuzzy_graph")
def fuzzy_graph(spark, sf_dir):
    return neighbours.fuzzy_edges(neighbours.knn(_vectors(spark, sf_dir), 15, "vec_id"), 15, "vec_id")


@register("pca_embedding")
def pca_embedding(spark, sf_dir):
    return embed.embed(_vectors(spark, sf_dir), 2, "pca", key="vec_id")


@register("spectral_embedding")
def spectral_embedding(spark, sf_dir):
    return embed.embed(_vectors(spark, sf_dir), 2, "spectral", neighbours=15, key="vec_id")


@register("embedding_by_factor", f"""{E}, c AS (
  SELECT label, row_number() OVER (ORDER BY min(vec_id)) - 1 AS factor_code FROM e GROUP BY 1)
SELECT vec_id, v[1] AS x, v[2] AS y, factor_code, label AS factor FROM e JOIN c USING (label)""")
def embedding_by_factor(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    return embed.by_factor(df, df, "label", "vec_id")


# ------------------------------------------------------------------------- Ward

@register("ward_clusters")
def ward_clusters(spark, sf_dir):
    return ward.ward_clusters(_vectors(spark, sf_dir), 6, micro=500, key="vec_id")


@register("ward_last_merges")
def ward_last_merges(spark, sf_dir):
    return ward.ward_tree(_vectors(spark, sf_dir), micro=500, key="vec_id").last_merges(18)


# --------------------------------------------------------------- density clusters

PLANE = f"""{P}, s AS (SELECT sku_key, (sales - a) / sa AS x, (selling_price - b) / sb AS y FROM p,
  (SELECT avg(sales) AS a, stddev_pop(sales) AS sa, avg(selling_price) AS b, stddev_pop(selling_price) AS sb FROM p))"""


def _plane(spark, sf_dir):
    df = scale.scale(durable(_products(spark, sf_dir)), ["sales", "selling_price"])
    return df.select("sku_key", F.col("sales").alias("x"), F.col("selling_price").alias("y"))


@register("density_neighbour_counts", f"""{PLANE}
SELECT a.sku_key, count(*) AS neighbours FROM s a JOIN s b
ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.15 * 0.15 GROUP BY 1""")
def density_neighbour_counts(spark, sf_dir):
    return density.neighbour_counts(_plane(spark, sf_dir), 0.15)


@register("density_clusters")
def density_clusters(spark, sf_dir):
    return density.density_clusters(_plane(spark, sf_dir), 0.15, 10, 50)


# ------------------------------------------------------------------ time warping

def _day_series(spark, sf_dir, fill=False):
    return prep.series(cells(spark, sf_dir, "day"), fill=fill, as_runs=fill)


@register("dtw_pairs")
def dtw_pairs(spark, sf_dir):
    return dtw.dtw_pairs(_day_series(spark, sf_dir, fill=True), 40.0)


@register("dtw_clusters")
def dtw_clusters(spark, sf_dir):
    return dtw.dtw_clusters(_day_series(spark, sf_dir, fill=True), 40.0)


#: Monthly series: a daily pair costs 50 to 110 ms to warp, so a daily limit that links anything is not run here (README).
MONTHLY_LIMIT = 75.0


def _month_series(spark, sf_dir):
    return prep.run_series(cells(spark, sf_dir, "month"))


@register("dtw_merge_tree")
def dtw_merge_tree(spark, sf_dir):
    return dtw.dtw_merge_tree(_month_series(spark, sf_dir), MONTHLY_LIMIT)


@register("dtw_inconsistent_clusters")
def dtw_inconsistent_clusters(spark, sf_dir):
    return dtw.dtw_inconsistent_clusters(_month_series(spark, sf_dir), MONTHLY_LIMIT)


@register("dtw_medoids")
def dtw_medoids(spark, sf_dir):
    return dtw.dtw_medoids(_day_series(spark, sf_dir, fill=True), 4)


# ------------------------------------------------------------------- supervised

@register("forest_importances")
def forest_importances(spark, sf_dir):
    d = days(spark, sf_dir)
    table_ = feat.extract_features(d, "sales").na.fill(0.0).join(bands(d), "sku_key")
    names = [c for c in table_.columns if c not in ("sku_key", "cluster")]
    scaled = durable(scale.scale(table_, names, "minmax"))
    return supervised.feature_importance(scaled, names)[0]


@register("forest_predictions")
def forest_predictions(spark, sf_dir):
    df = _by_label(spark, sf_dir)
    train, test = prep.train_test_split(df, ["vec_id"])
    return supervised.predict(supervised.fit_forest(train, trees=20), test).select("vec_id", "cluster", "prediction")


def _predicted(spark, sf_dir):
    df = _vectors(spark, sf_dir)
    near = vectors.nearest(df, _label_means(df), "vec_id", name="prediction")
    return df.select("vec_id", F.col("label").alias("cluster")).join(near, "vec_id")


@register("confusion_matrix", f"""{NEAR}
SELECT label, {', '.join(f"count(*) FILTER (node = {c}) AS predicted_{c}" for c in range(10))}
FROM bmu JOIN e USING (vec_id) GROUP BY 1""")
def confusion_matrix(spark, sf_dir):
    return supervised.confusion_matrix(_predicted(spark, sf_dir), list(range(10)))


@register("classification_report", f"""{NEAR}, z AS (SELECT label, node FROM bmu JOIN e USING (vec_id)),
c AS (SELECT k AS class, count(*) FILTER (label = k) AS support, count(*) FILTER (node = k) AS said,
             count(*) FILTER (label = k AND node = k) AS hits FROM z, (SELECT DISTINCT label AS k FROM z) GROUP BY 1),
q AS (SELECT *, coalesce(CAST(hits AS DOUBLE) / nullif(said, 0), 0) AS p, coalesce(CAST(hits AS DOUBLE) / nullif(support, 0), 0) AS r FROM c),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM q)
SELECT CAST(class AS VARCHAR) AS row, {snap_sql('p')} AS precision, {snap_sql('r')} AS recall, {snap_sql('f')} AS f1, support FROM f
UNION ALL SELECT 'accuracy', {snap_sql('sum(hits) / sum(support)')}, {snap_sql('sum(hits) / sum(support)')},
  {snap_sql('sum(hits) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', {snap_sql('avg(p)')}, {snap_sql('avg(r)')}, {snap_sql('avg(f)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', {snap_sql('sum(p * support) / sum(support)')}, {snap_sql('sum(r * support) / sum(support)')},
  {snap_sql('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(spark, sf_dir):
    report = supervised.classification_report(_predicted(spark, sf_dir))
    return report.withColumns({c: snap(c) for c in ("precision", "recall", "f1")})
