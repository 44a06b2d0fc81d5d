"""Cluster reports over an assignment by rule, so that SQL can reproduce them."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions.columns import snap
from seriesloom.operators import prep, stats
from seriesloom.operators.reports import (ClusterReports, cumulative_sales, profile,
                                          ranked_profile)
from seriesloom.plans.binding import transactions
from seriesloom.session import durable

from . import register
from .views import FIRST_LABELS, LABELS, ORDER, TX, bands, days, days_sql, reports_sql, snap_sql

BASE = f"WITH {reports_sql()}"
CATEGORIES = ["sku_department", "sku_category", "sku_subcategory"]
NUMBERS = ["sales", "selling_price", "avg_discount", "stock_open"]


def _reports(spark, sf_dir, labels: bool = False) -> ClusterReports:
    d = days(spark, sf_dir)
    asg = bands(d)
    if labels:
        d = prep.with_labels(d, prep.first_labels(transactions(spark, sf_dir), ORDER))
    return ClusterReports(asg, d)


def _pinned_reports(spark, sf_dir) -> ClusterReports:
    """The same over product-days that are made once; bands and reports read them several times."""
    d = durable(days(spark, sf_dir))
    return ClusterReports(bands(d), d)


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: snap(c, digits) for c in columns})


@register("clustered_days", f"{BASE} SELECT * FROM cs")
def clustered_days(spark, sf_dir):
    return _reports(spark, sf_dir).frame


@register("cluster_sizes", f"""{BASE}
SELECT cluster, count(DISTINCT sku_key) AS n_products, sum(sales) AS sales, count(*) AS n_events
FROM cs GROUP BY 1""")
def cluster_sizes(spark, sf_dir):
    return _reports(spark, sf_dir).sizes()


@register("cluster_daily_mean", f"""{BASE}
SELECT cluster, tran_date, avg(sales) AS mean FROM cs GROUP BY 1, 2""")
def cluster_daily_mean(spark, sf_dir):
    return _reports(spark, sf_dir).daily_mean()


@register("cluster_daily_median", f"""{BASE}
SELECT cluster, tran_date, median(sales) AS median FROM cs GROUP BY 1, 2""")
def cluster_daily_median(spark, sf_dir):
    return _reports(spark, sf_dir).daily_median()


@register("cluster_daily_count", f"""{BASE}
SELECT cluster, tran_date, count(sales) AS n_products FROM cs GROUP BY 1, 2""")
def cluster_daily_count(spark, sf_dir):
    return _reports(spark, sf_dir).daily_count()


ROLL = """CASE WHEN count({v}) OVER w = 7 THEN floor(avg({v}) OVER w * 1e6 + 0.5137) / 1e6 END"""


@register("cluster_rolling_mean", f"""{BASE},
d AS (SELECT cluster, tran_date, avg(sales) AS sales, count(sales) AS n_products FROM cs GROUP BY 1, 2)
SELECT cluster, tran_date, {ROLL.format(v='sales')} AS rolling_sales, n_products FROM d
WINDOW w AS (PARTITION BY cluster ORDER BY tran_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def cluster_rolling_mean(spark, sf_dir):
    return _rounded(_reports(spark, sf_dir).rolling_mean(["sales"], 7), "rolling_sales")


@register("cluster_double_rolling_mean", f"""{BASE},
d AS (SELECT cluster, tran_date, avg(stock_open) AS stock_open, avg(sales) AS sales,
             count(stock_open) AS n_products FROM cs GROUP BY 1, 2)
SELECT cluster, tran_date, {ROLL.format(v='stock_open')} AS rolling_stock_open,
       {ROLL.format(v='sales')} AS rolling_sales, n_products FROM d
WINDOW w AS (PARTITION BY cluster ORDER BY tran_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def cluster_double_rolling_mean(spark, sf_dir):
    rolled = _reports(spark, sf_dir).rolling_mean(["stock_open", "sales"], 7)
    return _rounded(rolled, "rolling_stock_open", "rolling_sales")


MONTHS = f"WITH {reports_sql('month')}"


def _month_reports(spark, sf_dir):
    d = days(spark, sf_dir, "month")
    return ClusterReports(bands(d), d)


START_COUNTS = """s AS (SELECT cluster, sku_key, min(tran_date) AS start FROM cs GROUP BY 1, 2)
SELECT cluster, start > first AS nan, count(*) AS n_products
FROM (SELECT *, min(start) OVER (PARTITION BY cluster) AS first FROM s) GROUP BY 1, 2"""
ALL_SERIES = "SELECT cluster, tran_date, sku_key, avg(sales) AS sales FROM cs GROUP BY 1, 2, 3"


@register("cluster_start_counts", f"{MONTHS}, {START_COUNTS}")
def cluster_start_counts(spark, sf_dir):
    return _month_reports(spark, sf_dir).start_counts()


@register("cluster_start_counts_daily", f"{BASE}, {START_COUNTS}")
def cluster_start_counts_daily(spark, sf_dir):
    return _reports(spark, sf_dir).start_counts()


@register("cluster_all_series", f"{MONTHS} {ALL_SERIES}")
def cluster_all_series(spark, sf_dir):
    return _month_reports(spark, sf_dir).all_series()


@register("cluster_all_series_daily", f"{BASE} {ALL_SERIES}")
def cluster_all_series_daily(spark, sf_dir):
    return _reports(spark, sf_dir).all_series()


@register("cluster_returns", f"""{BASE}
SELECT cluster, count(*) AS n_rows, count(*) FILTER (sales <= 0) AS n_events,
       CAST(count(*) FILTER (sales <= 0) AS DOUBLE) / count(sales) * 100 AS percent FROM cs GROUP BY 1""")
def cluster_returns(spark, sf_dir):
    return _reports(spark, sf_dir).returns()


@register("cluster_shortages", f"""{BASE}
SELECT cluster, count(*) AS n_rows, count(*) FILTER (stock_open < 0) AS n_events,
       CAST(count(*) FILTER (stock_open < 0) AS DOUBLE) / count(stock_open) * 100 AS percent
FROM cs GROUP BY 1""")
def cluster_shortages(spark, sf_dir):
    return _reports(spark, sf_dir).shortages()


@register("cluster_cumulative_sales", f"""{BASE}
SELECT asg.sku_key, total AS sales, CASE WHEN total > 0 THEN {snap_sql('log10(total)')} END AS sales_log,
       cluster FROM totals JOIN asg USING (sku_key)""")
def cluster_cumulative_sales(spark, sf_dir):
    d = days(spark, sf_dir)
    return _rounded(cumulative_sales(d).join(bands(d), "sku_key"), "sales_log")


@register("cluster_described", f"""{BASE},
m AS (SELECT cluster, {snap_sql('avg(sales)', 4)} AS mean FROM cs GROUP BY 1)
SELECT sku_key, asg.cluster, CAST(round(mean * 10000) AS BIGINT) AS description_e4, true AS unit_ok
FROM asg LEFT JOIN m USING (cluster)""")
def cluster_described(spark, sf_dir):
    df = _reports(spark, sf_dir).described()
    number = F.split("description", " ")[0].cast("double")
    return df.select("sku_key", "cluster", F.round(number * 10000).cast("bigint").alias("description_e4"),
                     F.col("description").endswith(" sales per day").alias("unit_ok"))


@register("cluster_histogram", f"""{BASE},
v AS (SELECT cluster, unnest(['sales', 'selling_price']) AS variable,
             unnest([sales, selling_price]) AS value FROM cs),
e AS (SELECT cluster, variable, min(value) AS lo, max(value) AS hi FROM v GROUP BY 1, 2),
c AS (SELECT v.cluster, v.variable, CAST(least(floor((value - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS bin,
             count(*) AS n FROM v JOIN e ON v.cluster = e.cluster AND v.variable = e.variable GROUP BY 1, 2, 3)
SELECT e.cluster, e.variable, CAST(g.bin AS INTEGER) AS bin, lo + (hi - lo) / 20 * (g.bin - 1) AS "left",
       lo + (hi - lo) / 20 * g.bin AS "right", coalesce(n, 0) AS n
FROM e CROSS JOIN (SELECT unnest(range(1, 21)) AS bin) g
LEFT JOIN c ON c.cluster = e.cluster AND c.variable = e.variable AND c.bin = g.bin""")
def cluster_histogram(spark, sf_dir):
    return _reports(spark, sf_dir).histogram(["sales", "selling_price"])


def _box_sql(base, low, high):
    return f"""{base},
v AS (SELECT cluster, unnest(['sales', 'selling_price', 'avg_discount']) AS variable,
             unnest([sales, selling_price, avg_discount]) AS value FROM cs),
p AS (SELECT cluster, variable, count(*) AS n, quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3,
             quantile_cont(value, 0.025) AS p1, quantile_cont(value, 0.975) AS p9 FROM v GROUP BY 1, 2),
b AS (SELECT *, {low} AS bl, {high} AS bh FROM p),
w AS (SELECT v.cluster, v.variable, least(min(value) FILTER (value >= bl), any_value(q1)) AS wl,
             greatest(max(value) FILTER (value <= bh), any_value(q3)) AS wh
      FROM v JOIN b ON v.cluster = b.cluster AND v.variable = b.variable GROUP BY 1, 2)
SELECT v.cluster, v.variable, any_value(n) AS n, {snap_sql('any_value(q1)')} AS q1,
       {snap_sql('any_value(median)')} AS median, {snap_sql('any_value(q3)')} AS q3,
       {snap_sql('any_value(wl)')} AS whisker_low, {snap_sql('any_value(wh)')} AS whisker_high,
       count(*) FILTER (value < wl OR value > wh) AS n_outliers
FROM v JOIN b ON v.cluster = b.cluster AND v.variable = b.variable
JOIN w ON v.cluster = w.cluster AND v.variable = w.variable GROUP BY 1, 2"""


BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@register("cluster_box", _box_sql(BASE, "p1", "p9"))
def cluster_box(spark, sf_dir):
    box = _pinned_reports(spark, sf_dir).box(["sales", "selling_price", "avg_discount"])
    return _rounded(box, *BOX)


@register("cluster_box_iqr", _box_sql(BASE, "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"))
def cluster_box_iqr(spark, sf_dir):
    box = _pinned_reports(spark, sf_dir).box(["sales", "selling_price", "avg_discount"], whiskers=None)
    return _rounded(box, *BOX)


@register("cluster_density", f"""{BASE},
s AS (SELECT cluster, count(*) AS n, min(sales) AS lo, max(sales) AS hi,
             stddev_samp(sales) * power(count(*), -0.2) AS h FROM cs GROUP BY 1),
c AS (SELECT cluster, sales AS value, count(*) AS c FROM cs GROUP BY 1, 2),
g AS (SELECT s.*, p.point, lo + (hi - lo) * p.point / 99 AS x
      FROM s CROSS JOIN (SELECT CAST(unnest(range(0, 100)) AS INTEGER) AS point) p)
SELECT g.cluster, 'sales' AS variable, point, {snap_sql('any_value(x)')} AS at,
       {snap_sql('sum(c * exp(-power((x - value) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 9)} AS density
FROM g JOIN c ON g.cluster = c.cluster GROUP BY g.cluster, point""")
def cluster_density(spark, sf_dir):
    d = _reports(spark, sf_dir).density(["sales"])
    return _rounded(_rounded(d, "at"), "density", digits=9)


LABELLED = f"WITH {TX}, {LABELS}, {days_sql()}, {FIRST_LABELS}"


def _categories_sql():
    from .views import BANDS
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS category, {c} AS level, cluster FROM j" for c in CATEGORIES)
    return f"""{LABELLED}, {BANDS},
j AS (SELECT cs.*, labels.* EXCLUDE (sku_key) FROM cs LEFT JOIN labels USING (sku_key)),
u AS (SELECT * FROM ({parts}) WHERE level IS NOT NULL)"""


@register("cluster_categories", f"""{_categories_sql()}
SELECT category, level, cluster, count(*) AS n FROM u GROUP BY 1, 2, 3""")
def cluster_categories(spark, sf_dir):
    return _reports(spark, sf_dir, labels=True).category_counts(CATEGORIES)


@register("cluster_category_matrix", f"""{_categories_sql()}
SELECT category, level, {', '.join(f"count(*) FILTER (cluster = {c}) AS cluster_{c}" for c in range(4))}
FROM u GROUP BY 1, 2""")
def cluster_category_matrix(spark, sf_dir):
    return _reports(spark, sf_dir, labels=True).category_matrix(CATEGORIES, list(range(4)))


MEANS = " UNION ALL ".join(f"SELECT cluster, '{v}' AS feature, {snap_sql(f'avg({v})')} AS mean FROM cs GROUP BY 1"
                           for v in NUMBERS)


@register("cluster_profile", f"""{BASE}, m AS ({MEANS})
SELECT feature, {', '.join(f"max(mean) FILTER (cluster = {c}) AS cluster_{c}" for c in range(4))}
FROM m GROUP BY 1""")
def cluster_profile(spark, sf_dir):
    wide = profile(_reports(spark, sf_dir).frame, NUMBERS, list(range(4)))
    return _rounded(wide, *[f"cluster_{c}" for c in range(4)])


@register("cluster_ranked_features", f"""{BASE}, m AS ({MEANS})
SELECT cluster, feature, mean, CAST(row_number() OVER (PARTITION BY cluster ORDER BY mean DESC, feature) AS INTEGER) AS rank
FROM m""")
def cluster_ranked_features(spark, sf_dir):
    return _rounded(ranked_profile(_reports(spark, sf_dir).frame, NUMBERS), "mean")


ANOVA = """g AS (SELECT cluster, count(*) AS n, avg(value) AS mean, var_pop(value) * count(*) AS ss FROM v GROUP BY 1),
t AS (SELECT sum(n * mean * mean) - power(sum(n * mean), 2) / sum(n) AS ss_between, sum(ss) AS ss_within,
             CAST(count(*) - 1 AS BIGINT) AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within,
             count(*) AS k FROM g)"""


def _anova(df):
    return (_rounded(stats.anova(df).drop("p"), "ss_between", "ss_within", digits=2)
            .withColumn("f", snap("f", 4)))


ANOVA_OUT = f"""SELECT {snap_sql('ss_between', 2)} AS ss_between, {snap_sql('ss_within', 2)} AS ss_within,
  df_between, df_within, {snap_sql('(ss_between / df_between) / (ss_within / df_within)', 4)} AS f FROM t"""


@register("anova_prices", f"{BASE}, v AS (SELECT cluster, selling_price AS value FROM cs), {ANOVA} {ANOVA_OUT}")
def anova_prices(spark, sf_dir):
    return _anova(_reports(spark, sf_dir).samples("selling_price"))


@register("anova_total_sales", f"{BASE}, v AS (SELECT cluster, total AS value FROM totals JOIN asg USING (sku_key)), {ANOVA} {ANOVA_OUT}")
def anova_total_sales(spark, sf_dir):
    d = days(spark, sf_dir)
    totals = cumulative_sales(d).join(bands(d), "sku_key")
    return _anova(totals.select("cluster", F.col("sales").alias("value")))


@register("anova_p")
def anova_p(spark, sf_dir):
    return stats.anova(_reports(spark, sf_dir).samples("sales"))


@register("tukey_pairs", f"""{BASE}, v AS (SELECT cluster, sales AS value FROM cs), {ANOVA},
p AS (SELECT a.cluster AS group1, b.cluster AS group2, b.mean - a.mean AS d,
             sqrt(ss_within / df_within / 2 * (1.0 / a.n + 1.0 / b.n)) AS se
      FROM g a JOIN g b ON a.cluster < b.cluster CROSS JOIN t)
SELECT group1, group2, {snap_sql('d')} AS mean_diff, {snap_sql('se')} AS se, {snap_sql('abs(d) / se', 4)} AS q FROM p""")
def tukey_pairs(spark, sf_dir):
    pairs = stats.tukey_pairs(_reports(spark, sf_dir).samples("sales")).drop("_k", "_df")
    return _rounded(pairs, "mean_diff", "se").withColumn("q", snap("q", 4))


@register("tukey_hsd")
def tukey_hsd(spark, sf_dir):
    return stats.tukey(_reports(spark, sf_dir).samples("sales"))
