"""Ranks and exact quantiles that never sort a whole group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import as_col, join_checked, q
from ..session import durable

# A quantile's group is cut into slices of about so many distinct values, and at least so many slices.
SLICE_ROWS, LEAST_SLICES = 1_000_000, 32
_ROW_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | row


def sorted_rank(df: DataFrame, by: list, name: str = "rank") -> DataFrame:
    """Add the 0-based position of every row in the order `by` (a total order).

    A range-partitioned sort is written once; each row's position is its place
    inside its partition plus the rows in the partitions before. Only one count
    per partition reaches the driver.
    """
    spark = df.sparkSession
    pinned = durable(df.orderBy(*by).withColumn("_id", F.monotonically_increasing_id()))
    placed = pinned.select(
        *[q(c) for c in df.columns],
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"))
    offsets, total = [], 0
    for part, rows in sorted(placed.groupBy("_part").count().collect()):
        offsets.append((part, total))
        total += rows
    table = spark.createDataFrame(offsets, "_part bigint, _offset bigint")
    return (placed.join(F.broadcast(table), "_part")
            .withColumn(name, F.col("_row") + F.col("_offset"))
            .drop("_part", "_row", "_offset"))


def factorize(df: DataFrame, column: str, order: list, name: str) -> DataFrame:
    """Code the levels of `column` 0, 1, ... by first appearance in `order`."""
    levels = df.where(as_col(column).isNotNull()).groupBy(column).agg(
        F.min(F.struct(*order)).alias("_first"))
    coded = sorted_rank(levels, ["_first", column], name).drop("_first")
    return join_checked(df, coded, column, "left")


def counted_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each distinct value of a group once, as `_v` with its count `_c`.

    Written once because quantiles read it several times.
    """
    return durable(df.where(as_col(value).isNotNull())
                   .groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: list[float],
                    slice_rows: int = SLICE_ROWS, out: str = "quantiles") -> DataFrame:
    return quantiles_of(counted_values(df, keys, value), keys, quantiles, slice_rows, out)


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("n") - 1)


def _ranks(p: float) -> tuple[Column, Column]:
    """The two ranks that a linear quantile lies between."""
    low = F.floor(_position(p))
    return low, F.least(low + 1, F.col("n") - 1)


def quantiles_of(counted: DataFrame, keys: list[str], quantiles: list[float],
                 slice_rows: int = SLICE_ROWS, out: str = "quantiles") -> DataFrame:
    """Linear-interpolated quantiles per group as an array column, plus `n`.

    Equal values are one counted row. Each group is cut into value slices at
    approximate quantiles, so a task sorts one slice and not one group. There are as
    many slices as keep each near `slice_rows` values in the largest group. Slice
    counts are exact, so the result is exact however rough the cuts are.
    """
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    slices = max(LEAST_SLICES, -(-(sizes.agg(F.max("rows")).first()[0] or 0) // slice_rows))
    cuts = durable(counted.groupBy(*keys).agg(
        F.percentile_approx("_v", [i / slices for i in range(1, slices)], max(1000, 30 * slices)).alias("_cuts"),
        F.sum("_c").alias("n")))
    if keys:
        cut = join_checked(counted, cuts, keys)
    else:
        whole = cuts.select(F.struct("_cuts", "n").alias("_w")).scalar()
        cut = counted.withColumn("_w", whole).select("_v", "_c", "_w.*")
    sliced = cut.withColumn("_s", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    per_slice = sliced.groupBy(*keys, "_s").agg(F.sum("_c").alias("_rows"), F.max("n").alias("n"))
    before = W.partitionBy(*keys).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    starts = per_slice.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    # only slices that hold a wanted rank are sorted
    wanted_ranks = [r for p in quantiles for r in _ranks(p)]
    holds = [(F.col("_start") <= r) & (r < F.col("_start") + F.col("_rows")) for r in wanted_ranks]
    needed = durable(starts.where(reduce(lambda x, y: x | y, holds)).select(*keys, "_s", "_start"))
    inside = W.partitionBy(*keys, "_s").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = join_checked(sliced, needed, [*keys, "_s"]).withColumn(
        "_hi", F.col("_start") + F.sum("_c").over(inside)).withColumn("_lo", F.col("_hi") - F.col("_c"))

    def at(rank: Column) -> Column:
        hit = (F.col("_lo") <= rank) & (rank < F.col("_hi"))
        return F.max(F.when(hit, F.col("_v")))

    picks = []
    for i, p in enumerate(quantiles):
        low, high = _ranks(p)
        picks += [at(low).alias(f"_a{i}"), at(high).alias(f"_b{i}")]
    wanted = placed.groupBy(*keys).agg(F.first("n").alias("n"), *picks)
    result = []
    for i, p in enumerate(quantiles):
        part = _position(p) - F.floor(_position(p))
        low, high = F.col(f"_a{i}"), F.col(f"_b{i}")
        result.append(low + (high - low) * part)
    return wanted.select(*keys, "n", F.array(*result).alias(out))
