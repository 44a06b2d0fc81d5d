"""Feature families per product over the daily sales series."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions.columns import q, snap
from seriesloom.operators import features as feat

from . import register
from .views import TX, days, days_sql, snap_sql

S = f"""WITH {TX}, {days_sql()},
s AS (SELECT sku_key, tran_date, sales AS x, row_number() OVER o - 1 AS pos, count(*) OVER p AS n,
        avg(sales) OVER p AS mu, stddev_pop(sales) OVER p AS sd, var_pop(sales) OVER p AS vr,
        min(sales) OVER p AS mn, max(sales) OVER p AS mx, sum(abs(sales)) OVER p AS mass,
        sum(abs(sales)) OVER (PARTITION BY sku_key ORDER BY tran_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        {', '.join(f'lag(sales, {i}) OVER o AS lag{i}' for i in range(1, 41))},
        {', '.join(f'lead(sales, {i}) OVER o AS lead{i}' for i in range(1, 7))}
      FROM pd WINDOW o AS (PARTITION BY sku_key ORDER BY tran_date), p AS (PARTITION BY sku_key))"""


def _sql(exprs: dict[str, str], source: str = "s", pre: str = "", group: str = "GROUP BY sku_key") -> str:
    out = ",\n  ".join(f'{snap_sql(f"CAST({e} AS DOUBLE)")} AS "sales__{n}"' for n, e in exprs.items())
    return f"{S}{pre} SELECT sku_key, {out} FROM {source} {group}"


def _features(spark, sf_dir, family, **options):
    df = feat.extract_features(days(spark, sf_dir), "sales", [family], **options)
    return df.select("sku_key", *[snap(F.col(q(c))).alias(c) for c in df.columns if c != "sku_key"])


t = feat._t
_N = "count(*)"
MOMENTS = {
    "length": _N, "sum_values": "sum(x)", "mean": "avg(x)", "minimum": "min(x)",
    "maximum": "max(x)", "absolute_maximum": "max(abs(x))", "variance": "var_pop(x)",
    "standard_deviation": "stddev_pop(x)", "root_mean_square": "sqrt(avg(x * x))",
    "abs_energy": "sum(x * x)", "variation_coefficient": "stddev_pop(x) / nullif(avg(x), 0)",
}


@register("ts_moments", _sql(MOMENTS))
def ts_moments(spark, sf_dir):
    return _features(spark, sf_dir, "moments")


@register("ts_shape", _sql({
    "skewness": f"CASE WHEN {_N} > 2 AND var_pop(x) > 0 THEN skewness(x) END",
    "kurtosis": f"CASE WHEN {_N} > 3 AND var_pop(x) > 0 THEN kurtosis(x) END"}))
def ts_shape(spark, sf_dir):
    return _features(spark, sf_dir, "shape")


QUANTILES = {f"quantile__q_{t(p)}": f"quantile_cont(x, {p})" for p in feat.QUANTILES}
QUANTILES["median"] = "median(x)"
for _r in range(20):
    _r = round(0.05 * _r, 2)
    QUANTILES[f"symmetry_looking__r_{t(_r)}"] = (
        f"CAST(abs(avg(x) - median(x)) < CAST({_r} AS DOUBLE) * (max(x) - min(x)) AS INTEGER)")


@register("ts_quantiles", _sql(QUANTILES))
def ts_quantiles(spark, sf_dir):
    return _features(spark, sf_dir, "quantiles")


COUNTS = {
    "count_above_mean": "count(*) FILTER (x > mu)", "count_below_mean": "count(*) FILTER (x < mu)",
    "variance_larger_than_standard_deviation": "CAST(var_pop(x) > stddev_pop(x) AS INTEGER)",
}
for _v in feat.COUNTED_VALUES:
    COUNTS[f"value_count__value_{t(_v)}"] = f"count(*) FILTER (x = {_v})"
for _lo, _hi in feat.COUNTED_RANGES:
    COUNTS[f"range_count__max_{t(_hi)}__min_{t(_lo)}"] = f"count(*) FILTER (x >= {_lo} AND x < {_hi})"
for _r in feat.SIGMAS:
    COUNTS[f"ratio_beyond_r_sigma__r_{t(_r)}"] = (
        f"CAST(count(*) FILTER (abs(x - mu) > {_r} * sd) AS DOUBLE) / count(*)")
for _r in range(1, 20):
    _r = round(0.05 * _r, 2)
    COUNTS[f"large_standard_deviation__r_{t(_r)}"] = (
        f"CAST(stddev_pop(x) > {_r} * (max(x) - min(x)) AS INTEGER)")


@register("ts_counts", _sql(COUNTS))
def ts_counts(spark, sf_dir):
    return _features(spark, sf_dir, "counts")


@register("ts_duplicates", _sql({
    "has_duplicate": "max(CAST(c > 1 AS INTEGER))",
    "has_duplicate_max": "max(CAST(c > 1 AND x = mx AS INTEGER))",
    "has_duplicate_min": "max(CAST(c > 1 AND x = mn AS INTEGER))",
    "sum_of_reoccurring_values": "coalesce(sum(x) FILTER (c > 1), 0)",
    "sum_of_reoccurring_data_points": "coalesce(sum(x * c) FILTER (c > 1), 0)",
    "percentage_of_reoccurring_values_to_all_values": "CAST(count(*) FILTER (c > 1) AS DOUBLE) / count(*)",
    "percentage_of_reoccurring_datapoints_to_all_datapoints":
        "CAST(coalesce(sum(c) FILTER (c > 1), 0) AS DOUBLE) / sum(c)",
    "ratio_value_number_to_time_series_length": "CAST(count(*) AS DOUBLE) / sum(c)",
}, "d", ", d AS (SELECT sku_key, x, count(*) AS c, any_value(mx) AS mx, any_value(mn) AS mn FROM s GROUP BY 1, 2)"))
def ts_duplicates(spark, sf_dir):
    return _features(spark, sf_dir, "duplicates")


@register("ts_changes", _sql({
    "mean_change": "avg(x - lag1)", "mean_abs_change": "avg(abs(x - lag1))",
    "absolute_sum_of_changes": "coalesce(sum(abs(x - lag1)), 0)",
    "mean_second_derivative_central": "avg((lead2 - 2 * lead1 + x) / 2)",
    "cid_ce__normalize_False": "coalesce(sqrt(sum((x - lag1) * (x - lag1))), 0)",
    "cid_ce__normalize_True":
        "coalesce(sqrt(sum((x - lag1) * (x - lag1))) / nullif(stddev_pop(x), 0), 0)"}))
def ts_changes(spark, sf_dir):
    return _features(spark, sf_dir, "changes")


POSITIONS = {
    "first_location_of_maximum": "CAST(min(pos) FILTER (x = mx) AS DOUBLE) / count(*)",
    "last_location_of_maximum": "CAST(max(pos) FILTER (x = mx) + 1 AS DOUBLE) / count(*)",
    "first_location_of_minimum": "CAST(min(pos) FILTER (x = mn) AS DOUBLE) / count(*)",
    "last_location_of_minimum": "CAST(max(pos) FILTER (x = mn) + 1 AS DOUBLE) / count(*)"}
for _p in feat.QUANTILES:
    POSITIONS[f"index_mass_quantile__q_{t(_p)}"] = (
        f"CAST(min(pos + 1) FILTER (cum / nullif(mass, 0) >= {_p}) AS DOUBLE) / count(*)")


@register("ts_positions", _sql(POSITIONS))
def ts_positions(spark, sf_dir):
    return _features(spark, sf_dir, "positions")


PEAKS_PRE = ", k AS (SELECT *, " + ", ".join(
    f"""(count(x) OVER b{n} = {n} AND count(x) OVER a{n} = {n}
         AND max(x) OVER b{n} < x AND max(x) OVER a{n} < x) AS peak{n}""" for n in feat.PEAK_SUPPORTS) + \
    " FROM s WINDOW " + ", ".join(
    f"""b{n} AS (PARTITION BY sku_key ORDER BY pos ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING),
        a{n} AS (PARTITION BY sku_key ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"""
    for n in feat.PEAK_SUPPORTS) + """),
i AS (SELECT sku_key, sign(x - mu) AS side,
             pos - row_number() OVER (PARTITION BY sku_key, sign(x - mu) ORDER BY pos) AS island FROM s),
r AS (SELECT sku_key, side, island, count(*) AS len FROM i GROUP BY 1, 2, 3),
st AS (SELECT sku_key, coalesce(max(len) FILTER (side > 0), 0) AS above,
              coalesce(max(len) FILTER (side < 0), 0) AS below FROM r GROUP BY 1)"""
RUNS = {f"number_peaks__n_{n}": f"count(*) FILTER (peak{n})" for n in feat.PEAK_SUPPORTS}
for _m in feat.CROSSINGS:
    RUNS[f"number_crossing_m__m_{t(_m)}"] = f"count(*) FILTER ((x > {_m}) <> (lag1 > {_m}))"
RUNS["longest_strike_above_mean"] = "any_value(above)"
RUNS["longest_strike_below_mean"] = "any_value(below)"


@register("ts_runs", _sql(RUNS, "k JOIN st USING (sku_key)", PEAKS_PRE))
def ts_runs(spark, sf_dir):
    return _features(spark, sf_dir, "runs")


_acf = {lag: f"CASE WHEN count(*) > {lag} AND var_pop(x) > 0 THEN sum((x - mu) * (lag{lag} - mu)) / ((count(*) - {lag}) * var_pop(x)) END"
        for lag in range(1, 41)}
ACF = {"autocorrelation__lag_0": "CASE WHEN v > 0 THEN 1.0 END"}
ACF.update({f"autocorrelation__lag_{i}": f"a{i}" for i in range(1, 10)})
for _f, _e in (("mean", "list_avg"), ("median", "list_median"), ("var", "list_var_pop")):
    ACF[f"agg_autocorrelation__f_agg_{_f}__maxlag_40"] = f"coalesce({_e}(l), 0)"


@register("ts_autocorrelation", _sql(ACF, "g", f""",
f AS (SELECT sku_key, var_pop(x) AS v, {', '.join(f'{e} AS a{i}' for i, e in _acf.items())} FROM s GROUP BY 1),
g AS (SELECT *, list_filter([{', '.join(f'a{i}' for i in _acf)}], lambda z: z IS NOT NULL) AS l FROM f)""",
                                     group=""))
def ts_autocorrelation(spark, sf_dir):
    return _features(spark, sf_dir, "autocorrelation")


_law = [f"log10(1 + 1 / {d}::DOUBLE)" for d in range(1, 10)]
_mid = f"(({' + '.join(_law)}) / 9)"
_whole = [f"(9 * count(*) FILTER (digit = '{d}') - count(*) FILTER (digit <> ''))" for d in range(1, 10)]
LEVELS = {
    f"mean_n_absolute_max__number_of_maxima_{feat.LARGEST}":
        f"CASE WHEN count(*) > {feat.LARGEST} THEN list_sum(max(abs(x), {feat.LARGEST})) / {feat.LARGEST} END",
    **{f"count_above__t_{t(v)}": f"count(*) FILTER (x >= {v}) / count(*)" for v in feat.LEVELS},
    **{f"count_below__t_{t(v)}": f"count(*) FILTER (x <= {v}) / count(*)" for v in feat.LEVELS},
    "benford_correlation": f"({' + '.join(f'{c} * ({b} - {_mid})' for c, b in zip(_whole, _law))}) / nullif(sqrt(("
                           f"{' + '.join(f'{c} * {c}' for c in _whole)}) * ({' + '.join(f'({b} - {_mid}) ** 2' for b in _law)})), 0)"}


@register("ts_levels", _sql(LEVELS, "g", """,
g AS (SELECT sku_key, x, regexp_extract(CAST(abs(x) AS VARCHAR), '[1-9]') AS digit FROM s)"""))
def ts_levels(spark, sf_dir):
    return _features(spark, sf_dir, "levels")


LAGGED = {}
for _l in (1, 2, 3):
    LAGGED[f"c3__lag_{_l}"] = f"coalesce(avg(lead{2 * _l} * lead{_l} * x), 0)"
    LAGGED[f"time_reversal_asymmetry_statistic__lag_{_l}"] = (
        f"coalesce(avg(lead{2 * _l} * lead{2 * _l} * lead{_l} - lead{_l} * x * x), 0)")


@register("ts_lagged_products", _sql(LAGGED))
def ts_lagged_products(spark, sf_dir):
    return _features(spark, sf_dir, "lagged")


def _line_sql(prefix, y, at, suffix=""):
    xx, yy, xy, n = (f"regr_sxx({y}, {at})", f"regr_syy({y}, {at})", f"regr_sxy({y}, {at})",
                     f"regr_count({y}, {at})")
    slope = f"{xy} / nullif({xx}, 0)"
    return {
        f"{prefix}__attr_slope{suffix}": slope,
        f"{prefix}__attr_intercept{suffix}": f"regr_avgy({y}, {at}) - {slope} * regr_avgx({y}, {at})",
        f"{prefix}__attr_rvalue{suffix}":
            f"CASE WHEN {yy} > 0 THEN {xy} / nullif(sqrt({xx} * {yy}), 0) WHEN {n} > 1 THEN 0 END",
        f"{prefix}__attr_stderr{suffix}":
            f"CASE WHEN {n} > 2 THEN sqrt(greatest(({yy} - {xy} * {xy} / nullif({xx}, 0)) / nullif({xx}, 0), 0) / ({n} - 2)) END",
    }


TREND = {n: e for n, e in _line_sql("linear_trend", "x", "CAST(pos AS DOUBLE)").items()}
TREND.update(_line_sql("linear_trend_timewise", "x",
                       "CAST(24 * date_diff('day', DATE '1970-01-01', tran_date) AS DOUBLE)"))
_days = "date_diff('day', DATE '1970-01-01', tran_date)"
TREND["linear_trend_timewise__attr_intercept"] = (
    f"avg(x) - {TREND['linear_trend_timewise__attr_slope']} * (avg({_days}) - min({_days})) * 24")


@register("ts_linear_trend", _sql(TREND))
def ts_linear_trend(spark, sf_dir):
    df = _features(spark, sf_dir, "trend", p_values=False)
    return df.select("sku_key", *[q(f"sales__{n}") for n in TREND])


CHUNKED = {}
for _c in feat.CHUNKS:
    for _f in ("max", "min", "mean", "var"):
        CHUNKED.update(_line_sql("agg_linear_trend", f"CASE WHEN size = {_c} THEN v_{_f} END",
                                 "CAST(chunk AS DOUBLE)", f"__chunk_len_{_c}__f_agg_{_f}"))


@register("ts_chunk_trend", _sql(CHUNKED, "c", """,
z AS (SELECT *, unnest([5, 10, 50]) AS size FROM s),
c AS (SELECT sku_key, size, CAST(floor(pos / size) AS BIGINT) AS chunk, max(x) AS v_max, min(x) AS v_min,
             avg(x) AS v_mean, var_pop(x) AS v_var FROM z GROUP BY 1, 2, 3)"""))
def ts_chunk_trend(spark, sf_dir):
    df = _features(spark, sf_dir, "trend", p_values=False)
    return df.select("sku_key", *[q(f"sales__{n}") for n in CHUNKED])


@register("ts_trend_p_values")
def ts_trend_p_values(spark, sf_dir):
    df = _features(spark, sf_dir, "trend")
    return df.select("sku_key", *[q(c) for c in df.columns if "pvalue" in c])


CORRIDORS = {}
for _i, _lo in enumerate(feat.CORRIDOR):
    for _j in range(_i + 1, len(feat.CORRIDOR)):
        _a, _b = f"m[{_i + 1}]", f"m[{_j + 1}]"
        _in = f"x >= {_a} AND x <= {_b} AND lag1 >= {_a} AND lag1 <= {_b} AND {_a} < {_b}"
        for _abs in (False, True):
            _d = "abs(x - lag1)" if _abs else "(x - lag1)"
            _n = f"change_quantiles__isabs_{_abs}__qh_{t(feat.CORRIDOR[_j])}__ql_{t(_lo)}"
            CORRIDORS[f"{_n}__f_agg_mean"] = f"coalesce(avg({_d}) FILTER ({_in}), 0)"
            CORRIDORS[f"{_n}__f_agg_var"] = f"coalesce(var_pop({_d}) FILTER ({_in}), 0)"


@register("ts_change_quantiles", _sql(CORRIDORS, "s JOIN m USING (sku_key)", """,
m AS (SELECT sku_key, quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS m FROM s GROUP BY 1)"""))
def ts_change_quantiles(spark, sf_dir):
    return _features(spark, sf_dir, "corridors")


SEGMENTS = {f"energy_ratio_by_chunks__num_segments_10__segment_focus_{i}":
            f"coalesce(sum(x * x) FILTER (seg = {i}), 0) / nullif(sum(x * x), 0)" for i in range(10)}
SEGMENTS["binned_entropy__max_bins_10"] = "any_value(h)"


@register("ts_segments", _sql(SEGMENTS, "g JOIN e USING (sku_key)", """,
g AS (SELECT sku_key, x, ntile(10) OVER (PARTITION BY sku_key ORDER BY pos) - 1 AS seg FROM s),
b AS (SELECT sku_key, CASE WHEN mx > mn THEN least(floor((x - mn) / ((mx - mn) / 10)), 9) ELSE 5 END AS bin,
             count(*) AS c, any_value(n) AS n FROM s GROUP BY 1, 2),
e AS (SELECT sku_key, -sum(CAST(c AS DOUBLE) / n * ln(CAST(c AS DOUBLE) / n)) AS h FROM b GROUP BY 1)"""))
def ts_segments(spark, sf_dir):
    return _features(spark, sf_dir, "segments")


_tiny = "CASE WHEN abs({0}) > 1e-9 * mass THEN {0} ELSE 0 END"
_DFT = {f"fft_coefficient__attr_{a}__coeff_{k}": f"max({e}) FILTER (k = {k})"
        for a, e in (("real", "re"), ("imag", "im"), ("abs", "size"), ("angle", "angle"))
        for k in range(feat.DFT_COEFFICIENTS)}
_SIZES = {"centroid": "any_value(mean)", "variance": "any_value(spread)",
          "skew": "CASE WHEN any_value(spread) >= 0.5 THEN sum(size * (k - mean) ** 3) / any_value(total * spread ** 1.5) END",
          "kurtosis": "CASE WHEN any_value(spread) >= 0.5 THEN sum(size * (k - mean) ** 4) / any_value(total * spread ** 2) END"}
_SIZES = {f"fft_aggregated__aggtype_{a}": e for a, e in _SIZES.items()}
_DFT_PRE = f""",
a AS (SELECT sku_key, x, mass, n, k, (k * pos) % n AS r, 2 * pi() * ((k * pos) % n) / n AS w
      FROM s, (SELECT unnest(range(0, 5000)) AS k) WHERE k <= n // 2),
b AS (SELECT sku_key, k, any_value(mass) AS mass,
             sum(x * CASE WHEN 2 * r = n THEN -1 WHEN 4 * r IN (n, 3 * n) THEN 0 ELSE cos(w) END) AS re,
             -sum(x * CASE WHEN 2 * r = n THEN 0 WHEN 4 * r = n THEN 1 WHEN 4 * r = 3 * n THEN -1 ELSE sin(w) END) AS im
      FROM a GROUP BY 1, 2),
c AS (SELECT *, sqrt(re * re + im * im) AS size, degrees(atan2({_tiny.format('im')}, {_tiny.format('re')})) AS angle FROM b),
t AS (SELECT sku_key, sum(size) AS total, sum(k * size) / nullif(sum(size), 0) AS mean FROM c GROUP BY 1),
v AS (SELECT sku_key, sum(size * (k - mean) ** 2) / nullif(any_value(total), 0) AS spread FROM c JOIN t USING (sku_key) GROUP BY 1),
f AS (SELECT * FROM c JOIN t USING (sku_key) JOIN v USING (sku_key))"""


@register("ts_spectrum", _sql(_DFT, "f", _DFT_PRE))
def ts_spectrum(spark, sf_dir):
    df = _features(spark, sf_dir, "spectrum")
    return df.select("sku_key", *[q(f"sales__{n}") for n in _DFT])


@register("ts_spectrum_all", _sql(_DFT | _SIZES, "f", _DFT_PRE))
def ts_spectrum_all(spark, sf_dir):
    return _features(spark, sf_dir, "spectrum")


_ACF_ROWS = f"f AS (SELECT sku_key, count(*) AS n, var_pop(x) AS v, [{', '.join(_acf[i] for i in range(1, 10))}] AS r FROM s GROUP BY 1)"
_STEPS = """d AS (
  SELECT sku_key, r, least(9, n // 2 - 1) AS l, 0 AS k, CAST([] AS DOUBLE[]) AS phi, 1.0::DOUBLE AS error, [1.0::DOUBLE] AS found
  FROM f WHERE v > 0 AND n // 2 - 1 > 0
  UNION ALL
  SELECT sku_key, r, l, k + 1,
         list_append(list_transform(list_zip(phi, list_reverse(phi)), lambda z: z[1] - step * z[2]), step),
         error * (1 - step * step), list_append(found, step)
  FROM (SELECT *, (r[k + 1] - CASE WHEN k = 0 THEN 0 ELSE list_inner_product(phi, list_reverse(r[1:k])) END) / error AS step
        FROM d WHERE k < l AND abs(error) >= 1e-14)),
e AS (SELECT sku_key, arg_max(found, k) AS found FROM d GROUP BY 1),
g AS (SELECT f.sku_key, found FROM f LEFT JOIN e USING (sku_key))"""


@register("ts_partial_autocorrelation", _sql(
    {f"partial_autocorrelation__lag_{i}": f"found[{i + 1}]" for i in range(feat.PARTIAL_LAGS)}, "g",
    f", {_ACF_ROWS}, {_STEPS}", group="").replace("WITH", "WITH RECURSIVE", 1))
def ts_partial_autocorrelation(spark, sf_dir):
    return _features(spark, sf_dir, "partial")


@register("ts_autoregression")
def ts_autoregression(spark, sf_dir):
    return feat.extract_features(days(spark, sf_dir), "sales", ["autoregression"])


@register("ts_wavelets")
def ts_wavelets(spark, sf_dir):
    return feat.extract_features(days(spark, sf_dir), "sales", ["wavelets"])


_PE = ", ".join(f"lead(x, {i}) OVER o AS b{i}" for i in (1, 2))


@register("ts_permutation_entropy", f"""{S},
w AS (SELECT sku_key, x AS b0, {_PE} FROM s WINDOW o AS (PARTITION BY sku_key ORDER BY pos)),
r AS (SELECT sku_key, (CAST(b1 < b0 AS INT) + CAST(b2 < b0 AS INT)) * 9 + (CAST(b0 <= b1 AS INT) + CAST(b2 < b1 AS INT)) * 3
             + CAST(b0 <= b2 AS INT) + CAST(b1 <= b2 AS INT) AS pattern FROM w WHERE b2 IS NOT NULL),
c AS (SELECT sku_key, pattern, count(*) AS c FROM r GROUP BY 1, 2),
p AS (SELECT sku_key, c / sum(c) OVER (PARTITION BY sku_key) AS p FROM c)
SELECT sku_key, {snap_sql('-sum(p * ln(p))')} AS "sales__permutation_entropy__dimension_3__tau_1" FROM p GROUP BY 1""")
def ts_permutation_entropy(spark, sf_dir):
    df = _features(spark, sf_dir, "complexity")
    return df.select("sku_key", "sales__permutation_entropy__dimension_3__tau_1")


@register("ts_complexity")
def ts_complexity(spark, sf_dir):
    return feat.extract_features(days(spark, sf_dir), "sales", ["complexity"])


@register("ts_dynamics")
def ts_dynamics(spark, sf_dir):
    return feat.extract_features(days(spark, sf_dir), "sales", ["dynamics"])
