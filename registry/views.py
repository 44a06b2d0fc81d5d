"""Common tables of the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import prep
from seriesloom.plans.binding import transactions

ORDER = ["tran_date", "l_orderkey", "l_linenumber"]

TX = """tx AS (
  SELECT l_partkey AS sku_key, CAST(l_shipdate AS DATE) AS tran_date, l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS sales,
         l_extendedprice / nullif(l_quantity, 0) AS selling_price,
         l_discount * l_extendedprice / nullif(l_quantity, 0) AS avg_discount,
         CAST(l_orderkey % 41 AS DOUBLE) - 4 AS stock_open
  FROM lineitem)"""

LABELS = """labels_raw AS (
  SELECT p_partkey AS sku_key, p_type AS sku_department, p_brand AS sku_subdepartment,
         split_part(p_name, ' ', -1) AS sku_category, split_part(p_name, ' ', 1) AS sku_subcategory,
         p_name AS sku_label
  FROM part)"""

STORES = """stores AS (
  SELECT s_suppkey AS store_key, r_name AS store_region,
         CASE WHEN s_acctbal >= 5000 THEN 'A' WHEN s_acctbal >= 0 THEN 'B' ELSE 'C' END AS store_grading
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""


def days_sql(grain: str = "day", name: str = "pd") -> str:
    date = "tran_date" if grain == "day" else f"CAST(date_trunc('{grain}', tran_date) AS DATE)"
    return f"""{name} AS (
  SELECT sku_key, {date} AS tran_date, coalesce(sum(sales), 0) AS sales,
         avg(selling_price) AS selling_price, avg(avg_discount) AS avg_discount,
         avg(stock_open) AS stock_open
  FROM tx WHERE sku_key IS NOT NULL AND tran_date IS NOT NULL GROUP BY 1, 2)"""


FIRST_LABELS = """labels AS (
  SELECT sku_key, sku_department, sku_subdepartment, sku_category, sku_subcategory, sku_label
  FROM (SELECT tx.*, l.* EXCLUDE (sku_key),
               row_number() OVER (PARTITION BY tx.sku_key
                                  ORDER BY tran_date, l_orderkey, l_linenumber) AS rn
        FROM tx LEFT JOIN labels_raw l USING (sku_key)) WHERE rn = 1)"""


def days(spark, sf_dir, grain: str = "day") -> DataFrame:
    return prep.product_day(transactions(spark, sf_dir, labels=False), grain=grain)


def cells(spark, sf_dir, grain: str = "month") -> DataFrame:
    return prep.pivot_long(days(spark, sf_dir, grain))


def cells_sql(grain: str = "month") -> str:
    return f"""{TX}, {days_sql(grain)}, cells AS (
  SELECT sku_key, tran_date, avg(sales) AS sales FROM pd GROUP BY 1, 2 HAVING avg(sales) IS NOT NULL)"""


def bands(product_days: DataFrame) -> DataFrame:
    """Assignment by rule, for reports that SQL must reproduce: products banded by
    how many standard deviations their total sales lie from the mean total."""
    totals = product_days.groupBy("sku_key").agg(F.sum("sales").alias("total"))
    stats = totals.agg(F.struct(F.avg("total").alias("m"), F.stddev_pop("total").alias("s"))).scalar()
    far = totals.withColumn("_s", stats)
    t, m, s = F.col("total"), F.col("_s.m"), F.col("_s.s")
    return far.select("sku_key", F.when(t < m - s, 0).when(t < m, 1).when(t < m + s, 2)
                      .otherwise(3).cast("int").alias("cluster"))


BANDS = """totals AS (SELECT sku_key, sum(sales) AS total FROM pd GROUP BY 1),
asg AS (SELECT sku_key, CAST(CASE WHEN total < m - s THEN 0 WHEN total < m THEN 1
                             WHEN total < m + s THEN 2 ELSE 3 END AS INTEGER) AS cluster
        FROM totals, (SELECT avg(total) AS m, stddev_pop(total) AS s FROM totals)),
cs AS (SELECT asg.cluster, pd.* FROM pd JOIN asg USING (sku_key))"""


def reports_sql(grain: str = "day") -> str:
    return f"{TX}, {days_sql(grain)}, {BANDS}"


def snap_sql(expr: str, digits: int = 6) -> str:
    s = f"1e{digits}"
    return f"floor(({expr}) * {s} + 0.5137) / {s}"


#: The product x year pivot. SQL names its columns; the query takes them from the data.
YEAR_PIVOT = f"""WITH {cells_sql('year')}
SELECT sku_key, {', '.join(f"max(sales) FILTER (tran_date = DATE '{y}-01-01') AS y{y}" for y in range(1995, 2002))}
FROM cells GROUP BY 1"""


def year_pivot(spark, sf_dir) -> DataFrame:
    c = cells(spark, sf_dir, "year")
    dates = prep.date_list(c)
    return prep.pivot_wide(c, dates=dates).toDF("sku_key", *[f"y{d.year}" for d in dates])
