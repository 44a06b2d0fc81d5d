"""Product-day table, labels, pivot, coverage, splits, series and row operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions.columns import snap
from seriesloom.operators import prep, ranking
from seriesloom.plans.binding import table, transactions

from . import ORACLES, register
from .views import (FIRST_LABELS, LABELS, ORDER, STORES, TX, YEAR_PIVOT, cells, cells_sql, days,
                    days_sql, snap_sql, year_pivot)


@register("labelled_product_days", f"""
WITH {TX}, {LABELS}, {days_sql()}, {FIRST_LABELS}
SELECT pd.*, labels.* EXCLUDE (sku_key) FROM pd LEFT JOIN labels USING (sku_key)""")
def labelled_product_days(spark, sf_dir):
    # measures need no label join, so the aggregate reads the order lines alone
    return prep.with_labels(days(spark, sf_dir), prep.first_labels(transactions(spark, sf_dir), ORDER))


@register("product_day_mean_stock", f"WITH {TX}, {days_sql()} SELECT * FROM pd")
def product_day_mean_stock(spark, sf_dir):
    return days(spark, sf_dir)


@register("product_day_sum_stock", f"""
WITH {TX} SELECT sku_key, tran_date, coalesce(sum(sales), 0) AS sales,
       avg(selling_price) AS selling_price, avg(avg_discount) AS avg_discount,
       coalesce(sum(stock_open), 0) AS stock_open
FROM tx GROUP BY 1, 2""")
def product_day_sum_stock(spark, sf_dir):
    return prep.product_day(transactions(spark, sf_dir, labels=False), stock_agg="sum")


@register("first_labels", f"WITH {TX}, {LABELS}, {FIRST_LABELS} SELECT * FROM labels")
def first_labels(spark, sf_dir):
    return prep.first_labels(transactions(spark, sf_dir), ORDER)


@register("store_transactions", f"""
WITH {TX}, {LABELS}, {STORES}
SELECT tx.*, l_suppkey AS store_key, labels_raw.* EXCLUDE (sku_key), store_region, store_grading
FROM (SELECT tx.*, l.l_suppkey FROM tx JOIN lineitem l
      ON tx.l_orderkey = l.l_orderkey AND tx.l_linenumber = l.l_linenumber
     AND tx.sku_key = l.l_partkey AND tx.tran_date = CAST(l.l_shipdate AS DATE)) tx
LEFT JOIN labels_raw USING (sku_key) LEFT JOIN stores ON store_key = l_suppkey""".replace(
    "SELECT tx.*, l_suppkey AS store_key", "SELECT tx.* EXCLUDE (l_suppkey), l_suppkey AS store_key"))
def store_transactions(spark, sf_dir):
    return transactions(spark, sf_dir, stores=True)


@register("narrow_feed", """
SELECT l_partkey AS sku_key, CAST(l_shipdate AS DATE) AS tran_date, sum(l_quantity) AS sales
FROM lineitem GROUP BY 1, 2""")
def narrow_feed(spark, sf_dir):
    feed = (table(spark, sf_dir, "lineitem")
            .select(F.col("l_partkey").alias("skukey"),
                    F.col("l_shipdate").cast("date").alias("tran_date"),
                    F.col("l_quantity").alias("quantity"))
            .groupBy("skukey", "tran_date").agg(F.sum("quantity").alias("quantity")))
    return feed.toDF("sku_key", "tran_date", "sales")


@register("pivot_cells", f"WITH {cells_sql()} SELECT * FROM cells")
def pivot_cells(spark, sf_dir):
    return cells(spark, sf_dir)


@register("pivot_wide_year", YEAR_PIVOT)
def pivot_wide_year(spark, sf_dir):
    return year_pivot(spark, sf_dir)


@register("null_counts", f"""
WITH {cells_sql()}
SELECT sku_key, CAST((SELECT count(DISTINCT tran_date) FROM cells) - count(*) AS BIGINT) AS nas
FROM cells GROUP BY 1""")
def null_counts(spark, sf_dir):
    return prep.null_counts(cells(spark, sf_dir))


@register("below_half_coverage", f"""
WITH {cells_sql()}, t AS (SELECT count(DISTINCT tran_date) AS n FROM cells),
p AS (SELECT sku_key, (SELECT n FROM t) - count(*) AS nas FROM cells GROUP BY 1)
SELECT count(*) FILTER (nas > ((SELECT n FROM t) + 1) / 2.0) AS n_below, count(*) AS n_products FROM p""")
def below_half_coverage(spark, sf_dir):
    return prep.below_half_coverage(cells(spark, sf_dir))


@register("start_flags", f"""
WITH {cells_sql()}
SELECT sku_key, min(tran_date) > (SELECT min(tran_date) FROM cells) AS nan FROM cells GROUP BY 1""")
def start_flags(spark, sf_dir):
    return prep.start_flags(cells(spark, sf_dir))


SPLIT = f"""
WITH {cells_sql()}, f AS (SELECT sku_key, min(tran_date) > (SELECT min(tran_date) FROM cells) AS nan
                          FROM cells GROUP BY 1)
SELECT * FROM cells WHERE sku_key IN (SELECT sku_key FROM f WHERE """


@register("pivot_started_inside", SPLIT + "nan)")
def pivot_started_inside(spark, sf_dir):
    c = cells(spark, sf_dir)
    return prep.split_on_start(c, prep.start_flags(c), "nan")


@register("pivot_started_before", SPLIT + "NOT nan)")
def pivot_started_before(spark, sf_dir):
    c = cells(spark, sf_dir)
    return prep.split_on_start(c, prep.start_flags(c), "no_nans")


@register("coverage_map", f"""
WITH {cells_sql()}, d AS (SELECT DISTINCT tran_date FROM cells),
p AS (SELECT sku_key, row_number() OVER (ORDER BY (SELECT count(*) FROM d) - count(*), sku_key) - 1 AS rank
      FROM cells GROUP BY sku_key)
SELECT rank, p.sku_key, d.tran_date, sales, sales IS NULL AS is_missing
FROM p CROSS JOIN d LEFT JOIN cells c ON c.sku_key = p.sku_key AND c.tran_date = d.tran_date""")
def coverage_map(spark, sf_dir):
    return prep.coverage_map(cells(spark, sf_dir))


@register("series_ragged", f"""
WITH {cells_sql()}
SELECT sku_key, array_to_string(list(CAST(CAST(sales AS BIGINT) AS VARCHAR) ORDER BY tran_date), ',') AS series
FROM cells GROUP BY 1""")
def series_ragged(spark, sf_dir):
    return _as_text(prep.series(cells(spark, sf_dir)))


@register("series_filled", f"""
WITH {cells_sql()}, d AS (SELECT DISTINCT tran_date FROM cells), p AS (SELECT DISTINCT sku_key FROM cells)
SELECT p.sku_key, array_to_string(list(CAST(CAST(coalesce(sales, 0) AS BIGINT) AS VARCHAR)
                                       ORDER BY d.tran_date), ',') AS series
FROM p CROSS JOIN d LEFT JOIN cells c ON c.sku_key = p.sku_key AND c.tran_date = d.tran_date
GROUP BY 1""")
def series_filled(spark, sf_dir):
    return _as_text(prep.series(cells(spark, sf_dir), fill=True))


# the same over daily cells, the grain of the original pivot
def _halves(c, part):
    return prep.split_on_start(c, prep.start_flags(c), part)


for _name, _build in {
        "pivot_cells": lambda c: c, "null_counts": prep.null_counts, "below_half_coverage": prep.below_half_coverage,
        "start_flags": prep.start_flags, "pivot_started_inside": lambda c: _halves(c, "nan"),
        "pivot_started_before": lambda c: _halves(c, "no_nans"), "coverage_map": prep.coverage_map,
        "series_ragged": lambda c: _as_text(prep.series(c)),
        "series_filled": lambda c: _as_text(prep.series(c, fill=True))}.items():
    register(f"{_name}_daily", ORACLES[_name].replace(cells_sql(), cells_sql("day")))(
        lambda spark, sf_dir, build=_build: build(cells(spark, sf_dir, "day")))


def _as_text(s):
    whole = F.transform("series", lambda v: v.cast("bigint").cast("string"))
    return s.select("sku_key", F.array_join(whole, ",").alias("series"))


@register("log_total_sales", f"""
WITH {TX}, {days_sql()}, t AS (SELECT sku_key, sum(sales) AS sales FROM pd GROUP BY 1)
SELECT sku_key, sales, CASE WHEN sales > 0 THEN {snap_sql('log10(sales)')} END AS sales_log FROM t""")
def log_total_sales(spark, sf_dir):
    from seriesloom.operators.reports import cumulative_sales
    return cumulative_sales(days(spark, sf_dir)).withColumn("sales_log", snap("sales_log"))


@register("one_hot_products", f"""
WITH {TX}, {LABELS}, {FIRST_LABELS}
SELECT sku_key, {', '.join(f"CAST(coalesce(sku_department = '{d}', false) AS INTEGER) AS sku_department_{d}"
                           for d in ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'))}
FROM labels""")
def one_hot_products(spark, sf_dir):
    labels = prep.first_labels(transactions(spark, sf_dir), ORDER)
    return prep.one_hot(labels.select("sku_key", "sku_department"), ["sku_department"])


@register("one_hot_store_rows", f"""
WITH {STORES}
SELECT l_orderkey, l_linenumber, l_partkey AS sku_key, CAST(l_shipdate AS DATE) AS tran_date, dummy
FROM (SELECT l.*, unnest(['store_region_' || store_region, 'store_grading_' || store_grading]) AS dummy
      FROM lineitem l LEFT JOIN stores ON l_suppkey = store_key) WHERE dummy IS NOT NULL""")
def one_hot_store_rows(spark, sf_dir):
    tx = transactions(spark, sf_dir, labels=False, stores=True)
    return prep.one_hot_long(tx, ["l_orderkey", "l_linenumber", "sku_key", "tran_date"],
                             ["store_region", "store_grading"])


@register("factor_codes", f"""
WITH {TX}, {LABELS}, {FIRST_LABELS},
codes AS (SELECT sku_department, row_number() OVER (ORDER BY first) - 1 AS code
          FROM (SELECT sku_department, min(sku_key) AS first FROM labels GROUP BY 1))
SELECT sku_key, sku_department, code FROM labels LEFT JOIN codes USING (sku_department)""")
def factor_codes(spark, sf_dir):
    labels = prep.first_labels(transactions(spark, sf_dir), ORDER)
    return ranking.factorize(labels.select("sku_key", "sku_department"),
                             "sku_department", ["sku_key"], "code")


def hash_sql(keys: list[str], seed: int) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, '{seed}')), 1, 15) AS BIGINT)"


@register("train_rows", f"""WITH {TX}, {days_sql()}
SELECT sku_key, sum(sales) AS sales FROM pd GROUP BY 1 HAVING {hash_sql(['sku_key'], 0)} % 100 < 75""")
def train_rows(spark, sf_dir):
    totals = days(spark, sf_dir).groupBy("sku_key").agg(F.sum("sales").alias("sales"))
    return prep.train_test_split(totals, ["sku_key"])[0]


ROW_KEYS = ["sku_key", "tran_date", "l_orderkey", "l_linenumber"]


@register("sampled_rows", f"""WITH {TX}
SELECT sku_key, tran_date, l_orderkey, l_linenumber, sales, selling_price, avg_discount, stock_open
FROM tx ORDER BY {hash_sql(ROW_KEYS, 7)}, {', '.join(ROW_KEYS)} LIMIT 4000""")
def sampled_rows(spark, sf_dir):
    tx = transactions(spark, sf_dir, labels=False)
    return prep.sample_exact(tx, 4000, ROW_KEYS, seed=7).select(
        *ROW_KEYS, "sales", "selling_price", "avg_discount", "stock_open")


@register("head_product_days", f"""
WITH {TX}, {days_sql()} SELECT * FROM pd ORDER BY sku_key, tran_date LIMIT 5""")
def head_product_days(spark, sf_dir):
    return days(spark, sf_dir).orderBy("sku_key", "tran_date").limit(5)
