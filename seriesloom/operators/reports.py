"""The tables behind the cluster plots.

Every report is one aggregate over (cluster, ...) for all clusters together.
Where a report first needs a few numbers per cluster (range, bandwidth,
percentiles), they join back as a side whose size is counted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import is_small, join_checked, q, ratio
from ..session import durable
from . import prep
from .ranking import counted_values, exact_quantiles, quantiles_of


def cumulative_sales(days: DataFrame) -> DataFrame:
    """Total sales per product with log10, NULL where the total is not positive."""
    totals = days.groupBy("sku_key").agg(F.sum("sales").alias("sales"))
    return totals.withColumn("sales_log", F.when(F.col("sales") > 0, F.log10("sales")))


def profile_long(df: DataFrame, variables: list[str], cluster: str = "cluster") -> DataFrame:
    """(`cluster`, `feature`, `mean`) of every variable."""
    means = df.groupBy(cluster).agg(*[F.avg(q(v)).alias(v) for v in variables])
    return means.unpivot([cluster], variables, "feature", "mean")


def profile(df: DataFrame, variables: list[str], clusters: list[int],
            cluster: str = "cluster") -> DataFrame:
    """Features as rows, clusters as columns."""
    wide = (profile_long(df, variables, cluster).groupBy("feature")
            .pivot(cluster, clusters).agg(F.first("mean")))
    return wide.select("feature", *[F.col(str(c)).alias(f"cluster_{c}") for c in clusters])


def ranked_profile(df: DataFrame, variables: list[str], cluster: str = "cluster") -> DataFrame:
    """Features ordered by mean inside each cluster, highest first."""
    w = W.partitionBy(cluster).orderBy(F.desc("mean"), "feature")
    return profile_long(df, variables, cluster).withColumn("rank", F.row_number().over(w))


class ClusterReports:
    """Assignments joined once to the product-days they describe."""

    def __init__(self, assignments: DataFrame, days: DataFrame, pin: bool = False):
        """`pin` writes the joined table once, for many reports over it."""
        self.assignments = assignments.select("sku_key", "cluster")
        joined = self.assignments.join(days, "sku_key")
        self.frame = durable(joined) if pin else joined
        self._few: bool | None = None

    @property
    def few_clusters(self) -> bool:
        """Counted on the assignment table, which has one row per product."""
        if self._few is None:
            self._few = is_small(self.assignments.select("cluster").distinct(), 10_000)
        return self._few

    def _attach(self, df: DataFrame, stats: DataFrame, on) -> DataFrame:
        return df.join(F.broadcast(stats) if self.few_clusters else stats, on)

    def _long(self, variables: list[str]) -> DataFrame:
        """(`cluster`, `variable`, `value`) without missing values."""
        return (self.frame.select("cluster", *[F.col(v).cast("double") for v in variables])
                .unpivot(["cluster"], variables, "variable", "value")
                .where(F.col("value").isNotNull()))

    def clusters(self) -> list:
        return sorted(r[0] for r in self.assignments.select("cluster").distinct().collect())

    def sizes(self) -> DataFrame:
        per_product = self.frame.groupBy("cluster", "sku_key").agg(
            F.sum("sales").alias("_s"), F.count(F.lit(1)).alias("_c"))
        return per_product.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n_products"), F.sum("_s").alias("sales"),
            F.sum("_c").alias("n_events"))

    def daily_mean(self, variable: str = "sales") -> DataFrame:
        return self.frame.groupBy("cluster", "tran_date").agg(F.avg(variable).alias("mean"))

    def daily_median(self, variable: str = "sales") -> DataFrame:
        """Exact median per cluster and date, also where one date holds most rows."""
        found = exact_quantiles(self.frame, ["cluster", "tran_date"], variable, [0.5])
        return found.select("cluster", "tran_date", F.col("quantiles")[0].alias("median"))

    def daily_count(self, variable: str = "sales") -> DataFrame:
        return self.frame.groupBy("cluster", "tran_date").agg(F.count(variable).alias("n_products"))

    def rolling_mean(self, variables: list[str] = ("sales",), period: int = 7) -> DataFrame:
        """Rolling mean of the daily means: over rows, NULL until `period` of them
        are present. One window row per cluster and date."""
        daily = self.frame.groupBy("cluster", "tran_date").agg(
            *[F.avg(v).alias(v) for v in variables],
            F.count(variables[0]).alias("n_products"))
        w = W.partitionBy("cluster").orderBy("tran_date").rowsBetween(1 - period, 0)
        rolled = [F.when(F.count(v).over(w) == period, F.avg(v).over(w)).alias(f"rolling_{v}")
                  for v in variables]
        return daily.select("cluster", "tran_date", *rolled, "n_products")

    def start_counts(self) -> DataFrame:
        """Products that start inside or before the period; the period is the cluster's."""
        cells = (self.frame.where(F.col("sales").isNotNull())
                 .select("cluster", "sku_key", "tran_date"))
        flags = prep.start_flags(cells, ["cluster"])
        return flags.groupBy("cluster", "nan").agg(F.count(F.lit(1)).alias("n_products"))

    def all_series(self) -> DataFrame:
        return (self.frame.groupBy("cluster", "tran_date", "sku_key")
                .agg(F.avg("sales").alias("sales")).where(F.col("sales").isNotNull()))

    def events(self, condition, variable: str) -> DataFrame:
        """Count and percent of the rows of each cluster that meet `condition`."""
        counted = self.frame.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(condition).alias("n_events"),
            F.count(variable).alias("_n"))
        return counted.select("cluster", "n_rows", "n_events",
                              (ratio("n_events", "_n") * 100).alias("percent"))

    def returns(self) -> DataFrame:
        return self.events(F.col("sales") <= 0, "sales")

    def shortages(self) -> DataFrame:
        return self.events(F.col("stock_open") < 0, "stock_open")

    def cluster_means(self, variable: str = "sales") -> DataFrame:
        return self.frame.groupBy("cluster").agg(F.avg(variable).alias("mean"))

    def described(self) -> DataFrame:
        """Assignments with a text such as '12.5 sales per day'."""
        text = F.concat(F.round("mean", 4).cast("string"), F.lit(" sales per day"))
        texts = self.cluster_means().select("cluster", text.alias("description"))
        joined = self.assignments.join(
            F.broadcast(texts) if self.few_clusters else texts, "cluster", "left")
        return joined.select("sku_key", "cluster", "description")

    def histogram(self, variables: list[str], bins: int = 20) -> DataFrame:
        """Equal-width counts between each cluster's own minimum and maximum; the
        last bin is closed, empty bins are listed."""
        values = self._long(variables)
        ends = values.groupBy("cluster", "variable").agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"))
        flat = F.col("lo") == F.col("hi")
        ends = durable(ends.select(
            "cluster", "variable", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")))
        width = (F.col("hi") - F.col("lo")) / bins
        spot = F.least(F.floor((F.col("value") - F.col("lo")) / width) + 1, F.lit(bins))
        counts = (self._attach(values, ends, ["cluster", "variable"])
                  .groupBy("cluster", "variable", spot.cast("int").alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n")))
        grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
        return grid.join(counts, ["cluster", "variable", "bin"], "left").select(
            "cluster", "variable", "bin", (F.col("lo") + width * (F.col("bin") - 1)).alias("left"),
            (F.col("lo") + width * F.col("bin")).alias("right"),
            F.coalesce("n", F.lit(0)).alias("n"))

    def box(self, variables: list[str], whiskers: tuple | None = (2.5, 97.5)) -> DataFrame:
        """Quartiles, whisker ends and outlier count; `whiskers=None` means 1.5 IQR."""
        keys = ["cluster", "variable"]
        counted = counted_values(self._long(variables), keys, "value")
        low_p, high_p = whiskers or (25.0, 75.0)
        p = F.col("quantiles")
        marks = quantiles_of(counted, keys, [low_p / 100, 0.25, 0.5, 0.75, high_p / 100]).select(
            *keys, "n", p[1].alias("q1"), p[2].alias("median"), p[3].alias("q3"),
            p[0].alias("_low"), p[4].alias("_high"))
        if whiskers is None:
            reach = 1.5 * (F.col("q3") - F.col("q1"))
            marks = marks.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
        marks = durable(marks)
        v = F.col("_v")
        # a whisker never ends inside the box; as it ends at a value, what lies beyond it lies beyond its mark
        beyond = (v < F.least("_low", "q1")) | (v > F.greatest("_high", "q3"))
        ends = self._attach(counted, marks, keys).groupBy(*keys).agg(
            *[F.first(c).alias(c) for c in ("n", "q1", "median", "q3")],
            F.min(F.when(v >= F.col("_low"), v)).alias("_wl"),
            F.max(F.when(v <= F.col("_high"), v)).alias("_wh"),
            F.coalesce(F.sum(F.when(beyond, F.col("_c"))), F.lit(0)).alias("n_outliers"))
        return ends.select(
            *keys, "n", "q1", "median", "q3", F.least(F.coalesce("_wl", "q1"), "q1").alias("whisker_low"),
            F.greatest(F.coalesce("_wh", "q3"), "q3").alias("whisker_high"), "n_outliers")

    def density(self, variables: list[str], points: int = 100) -> DataFrame:
        """Gaussian kernel density on an even grid (Scott's bandwidth).

        Values are counted first; a counted value meets the grid inside its own
        task and only the grid sums are shuffled.
        """
        values = self._long(variables)
        stats = values.groupBy("cluster", "variable").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
            (F.stddev_samp("value") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"))
        stats = durable(stats.where(F.col("h") > 0))
        counted = values.groupBy("cluster", "variable", "value").agg(F.count(F.lit(1)).alias("_c"))
        at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)
        z = (at - F.col("value")) / F.col("h")
        spread = self._attach(counted, stats, ["cluster", "variable"]).withColumn(
            "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        sums = spread.groupBy("cluster", "variable", "point").agg(
            F.sum(F.col("_c") * F.exp(-z * z / 2)).alias("_k"))
        return self._attach(sums, stats, ["cluster", "variable"]).select(
            "cluster", "variable", "point", at.alias("at"),
            (F.col("_k") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))

    def category_counts(self, categories: list[str]) -> DataFrame:
        """Rows per (`category`, `level`, `cluster`), all categories in one pass."""
        return (self.frame.select("cluster", *categories)
                .unpivot(["cluster"], categories, "category", "level")
                .where(F.col("level").isNotNull())
                .groupBy("category", "level", "cluster").agg(F.count(F.lit(1)).alias("n")))

    def category_matrix(self, categories: list[str], clusters: list | None = None) -> DataFrame:
        """Levels as rows, clusters as columns, 0 where a level does not occur."""
        clusters = clusters if clusters is not None else self.clusters()
        wide = (self.category_counts(categories).groupBy("category", "level")
                .pivot("cluster", clusters).agg(F.sum("n")).na.fill(0))
        return wide.select("category", "level",
                           *[F.col(str(c)).alias(f"cluster_{c}") for c in clusters])

    def samples(self, variable: str) -> DataFrame:
        """(`cluster`, `value`) rows for the tests; missing values left out."""
        return self._long([variable]).select("cluster", "value")
