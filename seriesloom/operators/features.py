"""Statistical features per series, one row per product.

Input is the long series (`sku_key`, `tran_date`, value) with one row per product
and date, so a series is at most as long as the calendar. The SQL families share
one prepared frame: a single shuffle on the product, one sort, and window columns
(neighbours, position, series statistics). Everything after it, joins included,
is hashed on the product already and shuffles nothing more.

Feature names are `<value>__<calculator>__<parameter>_<v>` with dots in numbers
written as underscores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import distributions as dist
from ..functions import kernels
from ..functions.columns import q, ratio

ID = "sku_key"
QUANTILES = [i / 10 for i in range(1, 10)]
# fixed parameter values of the default feature set
PEAK_SUPPORTS = [1, 3, 5, 10, 50]
CROSSINGS = [0, -1, 1]
COUNTED_VALUES = [0, -1, 1]
COUNTED_RANGES = [(-1, 1), (-10**12, 0), (0, 10**12)]
SIGMAS = [0.5, 1, 1.5, 2, 2.5, 3, 5, 6, 7, 10]
CORRIDOR = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
CHUNKS = [5, 10, 50]
LEVELS = [0]
LARGEST = 7
MAX_LAG = 40
PARTIAL_LAGS = 10
DFT_COEFFICIENTS = 100


def _t(v) -> str:
    return str(v).replace(".", "_").replace("-", "minus_")


def sql_name(feature: str, value: str = "sales") -> str:
    return f"{value}__{feature}"


# --------------------------------------------------------------- prepared frame

def prepare(series: DataFrame, value: str, families: set[str]) -> DataFrame:
    """Series rows with the window columns that the chosen families read."""
    rows = series.where(F.col(value).isNotNull()).select(
        ID, "tran_date", F.col(value).cast("double").alias("x"))
    ordered = W.partitionBy(ID).orderBy("tran_date")
    whole = W.partitionBy(ID)
    cols: dict[str, Column] = {"pos": F.row_number().over(ordered) - 1}
    lags, leads = 0, 0
    if families & {"changes", "runs", "corridors"}:
        lags = 1
    if "partial" in families:
        lags = PARTIAL_LAGS - 1
    if "autocorrelation" in families:
        lags = MAX_LAG
    if "changes" in families:
        leads = 2
    if "lagged" in families:
        leads = 6
    cols.update({f"lag{i}": F.lag("x", i).over(ordered) for i in range(1, lags + 1)})
    cols.update({f"lead{i}": F.lead("x", i).over(ordered) for i in range(1, leads + 1)})
    if "runs" in families:
        for n in PEAK_SUPPORTS:
            back, ahead = ordered.rowsBetween(-n, -1), ordered.rowsBetween(1, n)
            cols[f"peak{n}"] = ((F.count("x").over(back) == n) & (F.count("x").over(ahead) == n)
                                & (F.max("x").over(back) < F.col("x"))
                                & (F.max("x").over(ahead) < F.col("x")))
    if "positions" in families:
        cols["cum"] = F.sum(F.abs("x")).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    frame = rows.withColumns(cols)
    frame = frame.withColumns({
        "n": F.count("x").over(whole), "mu": F.avg("x").over(whole),
        "sd": F.stddev_pop("x").over(whole), "mn": F.min("x").over(whole),
        "mx": F.max("x").over(whole), "mass": F.sum(F.abs("x")).over(whole)})
    if "corridors" in families:
        marks = F.array(*[F.lit(p) for p in CORRIDOR])
        frame = frame.withColumn("marks", F.percentile("x", marks).over(whole))
    return frame


# ----------------------------------------------------- families of one aggregate

def _moments() -> dict[str, Column]:
    x = F.col("x")
    return {
        "length": F.count(x), "sum_values": F.sum(x), "mean": F.avg(x),
        "minimum": F.min(x), "maximum": F.max(x), "absolute_maximum": F.max(F.abs(x)),
        "variance": F.var_pop(x), "standard_deviation": F.stddev_pop(x),
        "root_mean_square": F.sqrt(F.avg(x * x)), "abs_energy": F.sum(x * x),
        "variation_coefficient": ratio(F.stddev_pop(x), F.avg(x)),
    }


def _shape() -> dict[str, Column]:
    """Bias-corrected skewness and kurtosis, NULL for too short or flat series."""
    d = F.col("x") - F.col("mu")
    n = F.count("x").cast("double")
    m2, m3, m4 = F.avg(d * d), F.avg(d * d * d), F.avg(d * d * d * d)
    g1 = ratio(m3, F.pow(m2, F.lit(1.5)))
    g2 = ratio(m4, m2 * m2) - 3
    return {
        "skewness": F.when(n > 2, ratio(g1 * F.sqrt(n * (n - 1)), n - 2)),
        "kurtosis": F.when(n > 3, ratio((n - 1) * ((n + 1) * g2 + 6), (n - 2) * (n - 3))),
    }


def _counts() -> dict[str, Column]:
    x, mu, sd = F.col("x"), F.col("mu"), F.col("sd")
    out = {
        "count_above_mean": F.count_if(x > mu), "count_below_mean": F.count_if(x < mu),
        "variance_larger_than_standard_deviation": (F.var_pop(x) > F.stddev_pop(x)).cast("int"),
    }
    for v in COUNTED_VALUES:
        out[f"value_count__value_{_t(v)}"] = F.count_if(x == v)
    for lo, hi in COUNTED_RANGES:
        out[f"range_count__max_{_t(hi)}__min_{_t(lo)}"] = F.count_if((x >= lo) & (x < hi))
    for r in SIGMAS:
        out[f"ratio_beyond_r_sigma__r_{_t(r)}"] = ratio(
            F.count_if(F.abs(x - mu) > r * sd), F.count(x))
    spread = F.max(x) - F.min(x)
    for r in range(1, 20):
        r = round(0.05 * r, 2)
        out[f"large_standard_deviation__r_{_t(r)}"] = (F.stddev_pop(x) > r * spread).cast("int")
    return out


def _levels() -> dict[str, Column]:
    """Shares of values on either side of a level, mean of the largest sizes, and how far first
    digits follow Benford's law (NULL if all nine are equally frequent)."""
    x, n = F.col("x"), F.count("x")
    largest = F.slice(F.sort_array(F.collect_list(F.abs(x)), asc=False), 1, LARGEST)  # as long as the series
    out = {f"mean_n_absolute_max__number_of_maxima_{LARGEST}": F.when(
        n > LARGEST, F.aggregate(largest, F.lit(0.0), lambda s, v: s + v) / LARGEST)}
    for v in LEVELS:
        out[f"count_above__t_{_t(v)}"] = ratio(F.count_if(x >= v), n)
        out[f"count_below__t_{_t(v)}"] = ratio(F.count_if(x <= v), n)
    digit = F.regexp_extract(F.abs(x).cast("string"), "[1-9]", 0)
    some = F.count_if(digit != "")
    law = [math.log10(1 + 1 / d) for d in range(1, 10)]
    away = [b - sum(law) / 9 for b in law]
    counts = [F.count_if(digit == str(d)) * 9 - some for d in range(1, 10)]  # whole numbers: equal counts are 0
    both = sum((c * F.lit(b) for c, b in zip(counts[1:], away[1:])), counts[0] * F.lit(away[0]))
    spread = sum((c * c for c in counts[1:]), counts[0] * counts[0])
    out["benford_correlation"] = ratio(both, F.sqrt(spread * F.lit(sum(b * b for b in away))))
    return out


def _changes() -> dict[str, Column]:
    x, step = F.col("x"), F.col("x") - F.col("lag1")
    bend = (F.col("lead2") - 2 * F.col("lead1") + x) / 2
    energy = F.sqrt(F.sum(step * step))
    return {
        "mean_change": F.avg(step), "mean_abs_change": F.avg(F.abs(step)),
        "absolute_sum_of_changes": F.coalesce(F.sum(F.abs(step)), F.lit(0.0)),
        "mean_second_derivative_central": F.avg(bend),
        "cid_ce__normalize_False": F.coalesce(energy, F.lit(0.0)),
        "cid_ce__normalize_True": F.coalesce(ratio(energy, F.stddev_pop(x)), F.lit(0.0)),
    }


def _positions() -> dict[str, Column]:
    x, pos, n = F.col("x"), F.col("pos"), F.count("x")
    at_max, at_min = F.when(x == F.col("mx"), pos), F.when(x == F.col("mn"), pos)
    out = {
        "first_location_of_maximum": ratio(F.min(at_max), n),
        "last_location_of_maximum": ratio(F.max(at_max) + 1, n),
        "first_location_of_minimum": ratio(F.min(at_min), n),
        "last_location_of_minimum": ratio(F.max(at_min) + 1, n),
    }
    for p in QUANTILES:
        reached = F.when(ratio("cum", "mass") >= p, pos + 1)
        out[f"index_mass_quantile__q_{_t(p)}"] = ratio(F.min(reached), n)
    return out


def _peaks() -> dict[str, Column]:
    out = {f"number_peaks__n_{n}": F.count_if(f"peak{n}") for n in PEAK_SUPPORTS}
    for m in CROSSINGS:
        crossed = (F.col("x") > m) != (F.col("lag1") > m)
        out[f"number_crossing_m__m_{_t(m)}"] = F.count_if(crossed)
    return out


def _lag_sum(lag: int) -> Column:
    n, v = F.count("x"), F.var_pop("x")
    total = F.sum((F.col("x") - F.col("mu")) * (F.col(f"lag{lag}") - F.col("mu")))
    return F.when((n > lag) & (v > 0), ratio(total, (n - lag) * v))


def _autocorrelation() -> dict[str, Column]:
    out = {"autocorrelation__lag_0": F.when(F.var_pop("x") > 0, F.lit(1.0))}
    sums = []
    for lag in range(1, MAX_LAG + 1):
        value = _lag_sum(lag)
        sums.append(value)
        if lag < 10:
            out[f"autocorrelation__lag_{lag}"] = value
    out["_acf"] = F.filter(F.array(*sums), lambda a: a.isNotNull())
    return out


def _partial() -> dict[str, Column]:
    """What `_partial_autocorrelation` reads: the correlations and how many lags the series allows."""
    lags = F.least(F.lit(PARTIAL_LAGS - 1), F.floor(F.count("x") / 2) - 1).cast("int")
    return {"_lag_sums": F.array(*[_lag_sum(lag) for lag in range(1, PARTIAL_LAGS)]),
            "_lags": F.when(F.var_pop("x") > 0, lags)}


def _lagged() -> dict[str, Column]:
    x, out = F.col("x"), {}
    for lag in (1, 2, 3):
        b, c = F.col(f"lead{lag}"), F.col(f"lead{2 * lag}")
        out[f"c3__lag_{lag}"] = F.coalesce(F.avg(c * b * x), F.lit(0.0))
        out[f"time_reversal_asymmetry_statistic__lag_{lag}"] = F.coalesce(
            F.avg(c * c * b - b * x * x), F.lit(0.0))
    return out


def _line(prefix: str, y: Column, at: Column, suffix: str = "") -> dict[str, Column]:
    """Least squares attributes of y over `at`."""
    n, sxx, syy, sxy = F.regr_count(y, at), F.regr_sxx(y, at), F.regr_syy(y, at), F.regr_sxy(y, at)
    slope = ratio(sxy, sxx)
    r = F.when(syy > 0, ratio(sxy, F.sqrt(sxx * syy))).when(n > 1, F.lit(0.0))
    left = F.greatest(ratio(syy - ratio(sxy * sxy, sxx), sxx), F.lit(0.0))

    def named(attr: str) -> str:
        return f'{prefix}__attr_{attr}{suffix}'
    return {
        named("slope"): slope,
        named("intercept"): F.regr_avgy(y, at) - slope * F.regr_avgx(y, at),
        named("rvalue"): r,
        named("stderr"): F.when(n > 2, F.sqrt(ratio(left, n - 2))),
        f"_n_{prefix}{suffix}": n,
    }


def _trend() -> dict[str, Column]:
    out = _line("linear_trend", F.col("x"), F.col("pos").cast("double"))
    days = F.unix_date("tran_date").cast("double")
    hours = _line("linear_trend_timewise", F.col("x"), days * 24)
    # hours count from the first date of the series
    slope = hours["linear_trend_timewise__attr_slope"]
    hours["linear_trend_timewise__attr_intercept"] = (
        F.regr_avgy(F.col("x"), days) - slope * (F.regr_avgx(F.col("x"), days)
                                                 - F.min(days)) * 24)
    return {**out, **hours}


def _corridors() -> dict[str, Column]:
    """Changes between neighbours that both lie between two quantiles."""
    out: dict[str, Column] = {}
    x, before = F.col("x"), F.col("lag1")
    for i, low in enumerate(CORRIDOR):
        for j in range(i + 1, len(CORRIDOR)):
            lo, hi = F.col("marks")[i], F.col("marks")[j]
            inside = (x >= lo) & (x <= hi) & (before >= lo) & (before <= hi) & (lo < hi)
            for absolute in (False, True):
                step = F.when(inside, F.abs(x - before) if absolute else x - before)
                base = f"change_quantiles__isabs_{absolute}__qh_{_t(CORRIDOR[j])}__ql_{_t(low)}"
                out[f"{base}__f_agg_mean"] = F.coalesce(F.avg(step), F.lit(0.0))
                out[f"{base}__f_agg_var"] = F.coalesce(F.var_pop(step), F.lit(0.0))
    return out


def _segments(segments: int = 10) -> dict[str, Column]:
    """Share of the energy in each of ten position segments (first ones longer)."""
    n, pos = F.col("n"), F.col("pos")
    size, longer = F.floor(n / segments), n % segments
    head = longer * (size + 1)
    place = F.when(pos < head, F.floor(pos / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(pos - head, size)))
    return {f"energy_ratio_by_chunks__num_segments_{segments}__segment_focus_{i}":
            ratio(F.coalesce(F.sum(F.when(place == i, F.col("x") * F.col("x"))), F.lit(0.0)),
                  F.sum(F.col("x") * F.col("x")))
            for i in range(segments)}


ONE_PASS = {
    "moments": _moments, "shape": _shape, "counts": _counts, "levels": _levels, "changes": _changes,
    "positions": _positions, "runs": _peaks, "autocorrelation": _autocorrelation,
    "partial": _partial, "lagged": _lagged, "trend": _trend, "corridors": _corridors, "segments": _segments,
}


# ------------------------------------------- families with an aggregate in between

def _quantiles(frame: DataFrame) -> DataFrame:
    marks = F.percentile("x", F.array(*[F.lit(p) for p in [*QUANTILES, 0.5]]))
    found = frame.groupBy(ID).agg(marks.alias("_q"), F.avg("x").alias("_m"),
                                  (F.max("x") - F.min("x")).alias("_w"))
    cols = {f"quantile__q_{_t(p)}": F.col("_q")[i] for i, p in enumerate(QUANTILES)}
    cols["median"] = F.col("_q")[9]
    gap = F.abs(F.col("_m") - F.col("_q")[9])
    for r in range(20):
        r = round(0.05 * r, 2)
        cols[f"symmetry_looking__r_{_t(r)}"] = (gap < r * F.col("_w")).cast("int")
    return found.select(ID, *[c.alias(n) for n, c in cols.items()])


def _duplicates(frame: DataFrame) -> DataFrame:
    per_value = frame.groupBy(ID, "x").agg(
        F.count(F.lit(1)).alias("c"), F.first("mn").alias("mn"), F.first("mx").alias("mx"))
    c, x, again = F.col("c"), F.col("x"), F.col("c") > 1
    zero = F.lit(0.0)
    return per_value.groupBy(ID).agg(
        F.max(again.cast("int")).alias("has_duplicate"),
        F.max((again & (x == F.col("mx"))).cast("int")).alias("has_duplicate_max"),
        F.max((again & (x == F.col("mn"))).cast("int")).alias("has_duplicate_min"),
        F.coalesce(F.sum(F.when(again, x)), zero).alias("sum_of_reoccurring_values"),
        F.coalesce(F.sum(F.when(again, x * c)), zero).alias("sum_of_reoccurring_data_points"),
        ratio(F.count_if(again), F.count(F.lit(1))).alias(
            "percentage_of_reoccurring_values_to_all_values"),
        ratio(F.coalesce(F.sum(F.when(again, c)), F.lit(0)), F.sum(c)).alias(
            "percentage_of_reoccurring_datapoints_to_all_datapoints"),
        ratio(F.count(F.lit(1)), F.sum(c)).alias("ratio_value_number_to_time_series_length"))


def _strikes(frame: DataFrame) -> DataFrame:
    """Longest run above and below the mean: islands of equal sign, then their length."""
    ordered = W.partitionBy(ID).orderBy("pos")

    def sign(c):
        return F.signum(F.col(c) - F.col("mu"))
    changed = F.coalesce((sign("x") != sign("lag1")).cast("int"), F.lit(1))
    islands = frame.select(ID, "pos", sign("x").alias("side"), changed.alias("new")) \
        .withColumn("island", F.sum("new").over(ordered))
    runs = islands.groupBy(ID, "island").agg(F.count(F.lit(1)).alias("len"),
                                             F.first("side").alias("side"))
    return runs.groupBy(ID).agg(
        F.coalesce(F.max(F.when(F.col("side") > 0, F.col("len"))), F.lit(0))
        .alias("longest_strike_above_mean"),
        F.coalesce(F.max(F.when(F.col("side") < 0, F.col("len"))), F.lit(0))
        .alias("longest_strike_below_mean"))


def _chunk_trend(frame: DataFrame) -> DataFrame:
    """Lines through the max, min, mean and variance of consecutive chunks."""
    cut = frame.select(ID, "x", "pos", F.explode(F.array(*map(F.lit, CHUNKS))).alias("size"))
    chunks = cut.groupBy(ID, "size", F.floor(F.col("pos") / F.col("size")).alias("chunk")).agg(
        F.max("x").alias("max"), F.min("x").alias("min"),
        F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    aggs: dict[str, Column] = {}
    for size in CHUNKS:
        for f in ("max", "min", "mean", "var"):
            y = F.when(F.col("size") == size, F.col(f))
            aggs.update(_line("agg_linear_trend", y, F.col("chunk").cast("double"),
                              f"__chunk_len_{size}__f_agg_{f}"))
    return chunks.groupBy(ID).agg(*[c.alias(n) for n, c in aggs.items()])


def _binned_entropy(frame: DataFrame, bins: int = 10) -> DataFrame:
    place = F.when(F.col("mx") > F.col("mn"), F.least(
        F.floor((F.col("x") - F.col("mn")) / ((F.col("mx") - F.col("mn")) / bins)),
        F.lit(bins - 1))).otherwise(F.lit(bins // 2))
    p = ratio("c", "n")
    return (frame.groupBy(ID, place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
            .groupBy(ID).agg((-F.sum(p * F.ln(p))).alias(f"binned_entropy__max_bins_{bins}")))


def _spectrum(frame: DataFrame) -> DataFrame:
    """Fourier coefficients 0 to n / 2 of each series, as sums over its rows, and moments of their
    sizes. A series of n rows costs n * n / 2 terms, spread over (series, coefficient) sums
    inside its partition; what is gathered per series are its n / 2 sums."""
    n, k = F.col("n"), F.col("k")
    turn = k * F.col("pos") % n  # whole numbers, so quarter turns are exact
    angle = 2 * math.pi * turn / n
    cos = (F.when(turn * 2 == n, F.lit(-1.0)).when((turn * 4 == n) | (turn * 4 == n * 3), F.lit(0.0))
           .otherwise(F.cos(angle)))
    sin = (F.when(turn * 2 == n, F.lit(0.0)).when(turn * 4 == n, F.lit(1.0)).when(turn * 4 == n * 3, F.lit(-1.0))
           .otherwise(F.sin(angle)))
    terms = frame.select(ID, "n", "pos", "x", "mass", F.explode(F.sequence(F.lit(0), F.floor(n / 2).cast("int"))).alias("k"))
    sums = terms.groupBy(ID, "k").agg(
        F.sum(F.col("x") * cos).alias("re"), (-F.sum(F.col("x") * sin)).alias("im"), (F.first("mass") * 1e-9).alias("tiny"))
    re, im = (F.when(F.abs(F.col(c)) > F.col("tiny"), F.col(c)).otherwise(F.lit(0.0)) for c in ("re", "im"))
    sums = sums.select(ID, F.struct("k", "re", "im", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2).alias("abs"),
                                    F.degrees(F.atan2(im, re)).alias("angle")).alias("c"))
    table = sums.groupBy(ID).agg(F.array_sort(F.collect_list("c")).alias("c"))

    def moment(power: int) -> Column:
        total = F.aggregate("c", F.lit(0.0), lambda s, c: s + F.pow(c["k"] - F.col("centroid"), F.lit(power)) * c["abs"])
        return ratio(total, F.col("weight"))

    table = table.withColumn("weight", F.aggregate("c", F.lit(0.0), lambda s, c: s + c["abs"]))
    table = table.withColumn("centroid", ratio(F.aggregate("c", F.lit(0.0), lambda s, c: s + c["k"] * c["abs"]), "weight"))
    table = table.withColumn("spread", moment(2))
    wide = F.col("spread") >= 0.5
    return table.select(
        ID, *[F.get("c", F.lit(i))[a].alias(f"fft_coefficient__attr_{name}__coeff_{i}")
              for name, a in (("real", "re"), ("imag", "im"), ("abs", "abs"), ("angle", "angle"))
              for i in range(DFT_COEFFICIENTS)],
        F.col("centroid").alias("fft_aggregated__aggtype_centroid"), F.col("spread").alias("fft_aggregated__aggtype_variance"),
        F.when(wide, moment(3) / F.pow("spread", F.lit(1.5))).alias("fft_aggregated__aggtype_skew"),
        F.when(wide, moment(4) / F.pow("spread", F.lit(2.0))).alias("fft_aggregated__aggtype_kurtosis"))


STAGED = {
    "quantiles": [_quantiles], "duplicates": [_duplicates], "runs": [_strikes],
    "trend": [_chunk_trend], "segments": [_binned_entropy], "spectrum": [_spectrum],
}


# ------------------------------------------------------------- per-series kernels

def _kernel(name: str, fields: list[str], fn):
    """A vectorized UDF over series arrays; `fn(array) -> dict`, missing keys are NULL."""
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in fields])

    @F.pandas_udf(schema)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fn(v) for v in s], columns=fields, dtype=float)
    return run


def by_length(series, fn, width: int) -> np.ndarray:
    """`fn` on tables of series of equal length; a row of `width` values for each series, in the given order."""
    out, lengths = np.full((len(series), width), np.nan), np.array([len(v) for v in series], dtype=int)
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        many = max(1, NUMBERS_AT_ONCE // n)
        for s in range(0, len(rows), many):
            at = rows[s:s + many]
            out[at] = fn(np.stack([np.asarray(series[i], dtype=float) for i in at]))
    return out


def _table_kernel(fields: list[str], fn):
    """The same for `fn(table of series of one length) -> table of values`; NaN is NULL."""
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in fields])

    @F.pandas_udf(schema)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(by_length(s.to_list(), fn, len(fields)), columns=fields)
    return run


KERNELS = {
    "autoregression": (kernels.AUTOREGRESSION_FIELDS, kernels.autoregression),
    "wavelets": (kernels.WAVELET_FIELDS, kernels.wavelets),
    "complexity": (kernels.COMPLEXITY_FIELDS, kernels.complexity),
    "dynamics": (kernels.DYNAMICS_FIELDS, kernels.dynamics),
}
TABLE_KERNELS = ("complexity", "dynamics")
NUMBERS_AT_ONCE = 100_000  # of the series in a table
SQL_FAMILIES = ["moments", "shape", "quantiles", "counts", "levels", "duplicates", "changes", "positions",
                "runs", "autocorrelation", "partial", "lagged", "trend", "corridors", "segments", "spectrum"]
FAMILIES = SQL_FAMILIES + list(KERNELS)


def series_arrays(frame: DataFrame) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return frame.groupBy(ID).agg(F.transform(entries, lambda e: e["x"]).alias("series"))


@F.pandas_udf(T.DoubleType())
def _slope_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(dist.slope_p_values(r.to_numpy(float), n.to_numpy(float)))


def _with_p_values(df: DataFrame) -> DataFrame:
    """p of each line's slope from its r and n; drops the helper counts."""
    added = {}
    for name in df.columns:
        if "__attr_rvalue" in name:
            count = "_n_" + name.replace("__attr_rvalue", "")
            p = _slope_p(F.col(q(name)), F.col(q(count)).cast("double"))
            added[name.replace("rvalue", "pvalue")] = F.when(F.isnan(p), None).otherwise(p)
    return df.withColumns(added)


def extract_features(series: DataFrame, value: str = "sales",
                     families: list[str] | None = None, p_values: bool = True) -> DataFrame:
    """One row per product, one column per feature of the chosen families."""
    chosen = list(families or FAMILIES)
    unknown = set(chosen) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown feature families {sorted(unknown)}")
    frame = prepare(series, value, set(chosen))
    parts = []
    one_pass: dict[str, Column] = {}
    for family in chosen:
        if family in ONE_PASS:
            one_pass.update(ONE_PASS[family]())
    if one_pass:
        parts.append(frame.groupBy(ID).agg(*[c.alias(n) for n, c in one_pass.items()]))
    for family in chosen:
        parts += [stage(frame) for stage in STAGED.get(family, [])]
    picked = [f for f in chosen if f in KERNELS]
    if picked:
        arrays = series_arrays(frame)
        for family in picked:
            fields, fn = KERNELS[family]
            kernel = _table_kernel(fields, fn) if family in TABLE_KERNELS else _kernel(family, fields, fn)
            arrays = arrays.withColumn(f"_{family}", kernel("series"))
        parts.append(arrays.select(ID, *[
            F.nullif(F.col(f"_{f}").getField(n), F.lit(math.nan)).alias(n)
            for f in picked for n in KERNELS[f][0]]))
    table = parts[0]
    for part in parts[1:]:
        table = table.join(part, ID)
    if "autocorrelation" in chosen:
        table = table.withColumns(_agg_autocorrelation()).drop("_acf")
    if "partial" in chosen:
        table = _with_partial_autocorrelation(table)
    if p_values and "trend" in chosen:
        table = _with_p_values(table)
    kept = [c for c in table.columns if c != ID and not c.startswith("_")]
    return table.select(ID, *[F.col(q(c)).cast("double").alias(sql_name(c, value)) for c in kept])


def _agg_autocorrelation() -> dict[str, Column]:
    acf, zero = F.col("_acf"), F.lit(0.0)
    n = F.size(acf)
    mean = F.aggregate(acf, zero, lambda s, a: s + a) / n
    ranked = F.array_sort(acf)
    middle = (F.get(ranked, F.floor((n - 1) / 2).cast("int"))
              + F.get(ranked, F.floor(n / 2).cast("int"))) / 2
    spread = F.aggregate(acf, zero, lambda s, a: s + (a - mean) * (a - mean)) / n
    name = "agg_autocorrelation__f_agg_{}__maxlag_" + str(MAX_LAG)
    # flat and one-point series have an all-zero correlation
    return {name.format(f): F.when(n > 0, v).otherwise(zero)
            for f, v in (("mean", mean), ("median", middle), ("var", spread))}


def _with_partial_autocorrelation(table: DataFrame) -> DataFrame:
    """Durbin-Levinson recursion over the lag sums; stops where nothing is left to explain."""
    r, lags, zero = F.col("_lag_sums"), F.col("_lags"), F.lit(0.0)

    def step(state: Column, k: Column) -> Column:
        phi, error = state["phi"], state["error"]
        past = F.reverse(F.slice(r, F.lit(1), k - 1))
        known = F.aggregate(F.zip_with(phi, past, lambda a, b: a * b), zero, lambda s, x: s + x)
        new = F.transform(F.array(ratio(F.get(r, k - 1) - known, error)), lambda d: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - d * b), F.array(d)).alias("phi"),
            (error * (1 - d * d)).alias("error"), F.concat(state["found"], F.array(d)).alias("found")))
        return F.when(F.abs(error) < 1e-14, state).otherwise(F.get(new, F.lit(0)))

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.lit(1.0).alias("error"),
                     F.array(F.lit(1.0)).alias("found"))
    found = F.aggregate(F.sequence(F.lit(1), lags), start, step)["found"]
    table = table.withColumn("_found", F.when(lags > 0, found))
    return table.withColumns({f"partial_autocorrelation__lag_{i}": F.get("_found", F.lit(i))
                              for i in range(PARTIAL_LAGS)})


def to_long(features: DataFrame, key: str = ID) -> DataFrame:
    names = [c for c in features.columns if c != key]
    return features.unpivot([key], [F.col(q(c)) for c in names], "feature", "value")


def from_long(long: DataFrame, names: list[str], key: str = ID) -> DataFrame:
    return long.groupBy(key).pivot("feature", names).agg(F.first("value"))
