"""One-way analysis of variance and Tukey's pairwise test over clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ratio
from ..functions import distributions as dist


def group_stats(df: DataFrame, cluster: str = "cluster", value: str = "value") -> DataFrame:
    """n, mean and within sum of squares per cluster: all that both tests need."""
    rows = df.where(F.col(value).isNotNull() & F.col(cluster).isNotNull())
    return rows.groupBy(cluster).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("ss"))


@F.pandas_udf(T.DoubleType())
def _f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([dist.f_tail(*v) for v in zip(f, df1, df2)], dtype=float)


def anova(df: DataFrame, cluster: str = "cluster", value: str = "value") -> DataFrame:
    """The type-2 table `value ~ cluster` as one row."""
    every = W.partitionBy()  # one row per cluster
    grand = F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every)
    table = group_stats(df, cluster, value).withColumn("_far", F.col("mean") - grand).agg(
        F.count(F.lit(1)).alias("_k"), F.sum("n").alias("_n"), F.sum("ss").alias("ss_within"),
        F.sum(F.col("n") * F.col("_far") * F.col("_far")).alias("ss_between"))
    table = table.select(
        "ss_between", "ss_within", (F.col("_k") - 1).alias("df_between"),
        (F.col("_n") - F.col("_k")).alias("df_within"))
    table = table.withColumn("f", ratio(ratio("ss_between", "df_between"),
                                        ratio("ss_within", "df_within")))
    return table.withColumn("p", _f_tail("f", F.col("df_between").cast("double"),
                                         F.col("df_within").cast("double")))


def tukey_pairs(df: DataFrame, cluster: str = "cluster", value: str = "value") -> DataFrame:
    """Mean difference, Tukey-Kramer standard error and q for every cluster pair.

    The self-join runs over one row per cluster.
    """
    stats = group_stats(df, cluster, value)
    pooled = stats.agg(F.struct(
        ratio(F.sum("ss"), F.sum("n") - F.count(F.lit(1))).alias("ms"),
        (F.sum("n") - F.count(F.lit(1))).alias("df"),
        F.count(F.lit(1)).alias("k")).alias("p")).scalar()
    a = stats.select(F.col(cluster).alias("group1"), F.col("n").alias("n1"), F.col("mean").alias("m1"))
    b = stats.select(F.col(cluster).alias("group2"), F.col("n").alias("n2"), F.col("mean").alias("m2"))
    pairs = a.join(b, F.col("group1") < F.col("group2")).withColumn("_p", pooled)
    se = F.sqrt(F.col("_p.ms") / 2 * (F.lit(1.0) / F.col("n1") + F.lit(1.0) / F.col("n2")))
    return (pairs.withColumn("mean_diff", F.col("m2") - F.col("m1")).withColumn("se", se)
            .withColumn("q", ratio(F.abs("mean_diff"), "se"))
            .select("group1", "group2", "mean_diff", "se", "q",
                    F.col("_p.k").alias("_k"), F.col("_p.df").alias("_df")))


def tukey(df: DataFrame, cluster: str = "cluster", value: str = "value",
          alpha: float = 0.05) -> DataFrame:
    """Tukey's honest significant difference with p, interval and decision."""

    @F.pandas_udf("p double, critical double")
    def tail(q: pd.Series, k: pd.Series, df_: pd.Series) -> pd.DataFrame:
        known: dict = {}
        out = []
        for row in zip(q, k, df_):
            key = (int(row[1]), float(row[2]))
            if key not in known:
                known[key] = dist.studentized_range_critical(alpha, *key)
            out.append((dist.studentized_range_tail(float(row[0]), *key), known[key]))
        return pd.DataFrame(out, columns=["p", "critical"], dtype=float)

    tested = tukey_pairs(df, cluster, value).withColumn("_t", tail("q", "_k", "_df"))
    half = F.col("_t.critical") * F.col("se")
    return tested.select("group1", "group2", "mean_diff", "se", "q", F.col("_t.p").alias("p"),
                         (F.col("mean_diff") - half).alias("lower"),
                         (F.col("mean_diff") + half).alias("upper"),
                         (F.col("_t.p") < alpha).alias("reject"))
