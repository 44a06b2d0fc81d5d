"""Numeric kernels on series: small numpy helpers called from vectorized UDFs.

One kind takes a 1-d array and returns a dict of feature values; a feature that the
series is too short for is left out and becomes NULL. `complexity` and `dynamics` take
series of one length as the rows of a table and return a row of values for each, NaN for NULL.
"""

from __future__ import annotations

import functools
import math

import numpy as np

# ------------------------------------------------------------- autoregression
AR_ORDER = 10
AUTOREGRESSION_FIELDS = [f"ar_coefficient__coeff_{i}__k_{AR_ORDER}" for i in range(AR_ORDER + 1)]


def autoregression(x: np.ndarray) -> dict:
    n, out = len(x), {}
    if n >= 2 * AR_ORDER + 1:
        past = [x[AR_ORDER - i: n - i] for i in range(1, AR_ORDER + 1)]
        design = np.column_stack([np.ones(n - AR_ORDER), *past])
        beta = np.linalg.lstsq(design, x[AR_ORDER:], rcond=None)[0]
        out.update({f"ar_coefficient__coeff_{i}__k_{AR_ORDER}": b for i, b in enumerate(beta)})
    return out


# ------------------------------------------------------------------- wavelets
WAVELET_WIDTHS = (2, 5, 10, 20)
WAVELET_POSITIONS = 15
WELCH_COEFFICIENTS = (2, 5, 8)
WAVELET_FIELDS = [f"cwt_coefficients__coeff_{i}__w_{w}"
                  for w in WAVELET_WIDTHS for i in range(WAVELET_POSITIONS)]
WAVELET_FIELDS += [f"number_cwt_peaks__n_{n}" for n in (1, 5)]
WAVELET_FIELDS += [f"spkt_welch_density__coeff_{k}" for k in WELCH_COEFFICIENTS]


@functools.lru_cache(maxsize=256)
def _ricker(width: int, size: int) -> np.ndarray:
    t = np.arange(size) - (size - 1) / 2.0
    u = (t / width) ** 2
    return 2.0 / (math.sqrt(3.0 * width) * math.pi**0.25) * (1.0 - u) * np.exp(-u / 2.0)


def ricker_transform(x: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(x, _ricker(width, min(10 * width, len(x)))[::-1], mode="same")


def ridge_peaks(x: np.ndarray, widest: int, noise_percentile: float = 10.0) -> int:
    """Peaks that persist over the wavelet widths 1..widest and rise over the noise.

    A ridge starts at a maximum of the widest transform (or any narrower one that
    no ridge claims) and continues to the nearest maximum one width down, at most
    a quarter of the width away.
    """
    n = len(x)
    if n < 3:
        return 0
    maps = [ricker_transform(x, w) for w in range(1, widest + 1)]
    open_ridges: list[list[tuple[int, int]]] = []
    for row in range(widest - 1, -1, -1):
        m = maps[row]
        tops = (np.flatnonzero((m[1:-1] > m[:-2]) & (m[1:-1] > m[2:])) + 1).tolist()
        reach = max(1.0, (row + 1) / 4.0)
        for ridge in open_ridges:
            level, at = ridge[-1]
            near = [i for i in tops if abs(i - at) <= reach] if level == row + 1 else []
            if near:
                best = min(near, key=lambda i: abs(i - at))
                tops.remove(best)
                ridge.append((row, best))
        open_ridges += [[(row, i)] for i in tops]
    noise = np.percentile(np.abs(maps[0]), noise_percentile)
    least = math.ceil(widest / 4)
    return sum(1 for r in open_ridges
               if len(r) >= least and maps[r[-1][0]][r[-1][1]] >= noise)


def welch_density(x: np.ndarray, segment: int = 256) -> np.ndarray:
    """One-sided power density averaged over half-overlapping Hann windows."""
    size = min(segment, len(x))
    window = 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(size) / size)
    starts = range(0, len(x) - size + 1, max(1, size - size // 2))
    power = np.mean([np.abs(np.fft.rfft((x[s:s + size] - x[s:s + size].mean()) * window)) ** 2
                     for s in starts], axis=0) / (window @ window)
    power[1:] *= 2.0
    if size % 2 == 0:
        power[-1] /= 2.0
    return power


def wavelets(x: np.ndarray) -> dict:
    out = {}
    for w in WAVELET_WIDTHS:
        c = ricker_transform(x, w)
        out.update({f"cwt_coefficients__coeff_{i}__w_{w}": c[i]
                    for i in range(min(WAVELET_POSITIONS, len(c)))})
    for n in (1, 5):
        out[f"number_cwt_peaks__n_{n}"] = ridge_peaks(x, n)
    if len(x) > 1:
        p = welch_density(x)
        out.update({f"spkt_welch_density__coeff_{k}": p[k]
                    for k in WELCH_COEFFICIENTS if k < len(p)})
    return out


# ----------------------------------------------------------------- complexity
ENTROPY_RADII = (0.1, 0.3, 0.5, 0.7, 0.9)
PERMUTATION_SIZES = (3, 4, 5, 6, 7)
LEMPEL_ZIV_BINS = (2, 3, 5, 10, 100)
COMPLEXITY_FIELDS = [f"approximate_entropy__m_2__r_{str(r).replace('.', '_')}"
                     for r in ENTROPY_RADII]
COMPLEXITY_FIELDS += ["sample_entropy"]
COMPLEXITY_FIELDS += [f"permutation_entropy__dimension_{d}__tau_1" for d in PERMUTATION_SIZES]
COMPLEXITY_FIELDS += [f"lempel_ziv_complexity__bins_{b}" for b in LEMPEL_ZIV_BINS]
_CELLS_AT_ONCE = 200_000


def _of_table(fn):
    """`fn` on the rows of a table; a single series gets the result of its row."""
    @functools.wraps(fn)
    def run(x: np.ndarray, *args, **options):
        return fn(x[None], *args, **options)[0] if x.ndim == 1 else fn(x, *args, **options)
    return run


def _near(table: np.ndarray, m: int, limits: np.ndarray) -> np.ndarray:
    """Per series, window of m values and radius (a column of `limits`), how many windows of the
    series lie within it (itself included).

    Series and windows go through in slices: memory stays linear in the series length.
    """
    n = table.shape[1] - m + 1
    counts = np.empty((len(table), n, limits.shape[1]))
    many, rows = max(1, _CELLS_AT_ONCE // (n * n)), max(1, _CELLS_AT_ONCE // n)
    for s in range(0, len(table), many):
        part, radii = table[s:s + many], limits[s:s + many]
        for r in range(0, n, rows):
            end, gap = min(r + rows, n), None
            for k in range(m):
                step = np.abs(part[:, r + k:end + k, None] - part[:, None, k:n + k])
                gap = step if gap is None else np.maximum(gap, step, out=gap)
            for i in range(radii.shape[1]):
                counts[s:s + many, r:end, i] = np.count_nonzero(gap <= radii[:, i, None, None], axis=2)
    return counts


@_of_table
def approximate_entropy(table: np.ndarray, radii: tuple = ENTROPY_RADII, m: int = 2) -> np.ndarray:
    limits = np.array(radii) * table.std(axis=1)[:, None]

    def phi(size: int) -> np.ndarray:
        return np.log(_near(table, size, limits) / (table.shape[1] - size + 1)).mean(axis=1)
    return np.abs(phi(m) - phi(m + 1))


@_of_table
def sample_entropy(table: np.ndarray, m: int = 2) -> np.ndarray:
    limits, windows = 0.2 * table.std(axis=1)[:, None], table.shape[1] - m
    b, a = (_near(x, size, limits).sum(axis=(1, 2)) - windows for x, size in ((table[:, :-1], m), (table, m + 1)))
    known = (a > 0) & (b > 0)
    return np.where(known, -np.log(np.where(known, a, 1) / np.where(known, b, 1)), np.nan)


@_of_table
def permutation_entropy(table: np.ndarray, size: int) -> np.ndarray:
    order = np.argsort(np.lib.stride_tricks.sliding_window_view(table, size, axis=1), axis=2, kind="stable")
    codes = order @ size ** np.arange(size)
    rows = np.arange(len(table))[:, None]
    found, counts = np.unique(rows * size**size + codes, return_counts=True)  # a code is below size ** size
    p = counts / codes.shape[1]
    return -np.bincount(found // size**size, p * np.log(p), len(table))


def _phrases(symbols: list[int]) -> int:
    root: dict = {}
    node, phrases = root, 0
    for symbol in symbols:
        if symbol in node:
            node = node[symbol]
        else:  # a phrase is a known one and a symbol more
            node[symbol] = {}
            node, phrases = root, phrases + 1
    return phrases


@_of_table
def lempel_ziv(table: np.ndarray, bins: int) -> np.ndarray:
    """Distinct phrases of the binned series over its length."""
    low, high = table.min(axis=1), table.max(axis=1)
    symbols, varied = np.zeros(table.shape, dtype="int64"), np.flatnonzero(low != high)
    many = max(1, _CELLS_AT_ONCE // (bins * table.shape[1]))
    for s in range(0, len(varied), many):
        rows = varied[s:s + many]
        edges = np.linspace(low[rows], high[rows], bins + 1, axis=1)[:, 1:]
        symbols[rows] = np.count_nonzero(edges[:, None, :] < table[rows][:, :, None], axis=2)
    return np.array([_phrases(row) for row in symbols.tolist()]) / table.shape[1]


def complexity(table: np.ndarray) -> np.ndarray:
    n, out = table.shape[1], {}
    if n > 3:
        out.update(zip(COMPLEXITY_FIELDS, approximate_entropy(table).T))
        out["sample_entropy"] = sample_entropy(table)
    for d in PERMUTATION_SIZES:
        if n >= d:
            out[f"permutation_entropy__dimension_{d}__tau_1"] = permutation_entropy(table, d)
    for b in LEMPEL_ZIV_BINS:
        out[f"lempel_ziv_complexity__bins_{b}"] = lempel_ziv(table, b)
    missing = np.full(len(table), np.nan)
    return np.column_stack([out.get(f, missing) for f in COMPLEXITY_FIELDS])


# ------------------------------------------------------------------- dynamics
DRIFT_DEGREE, DRIFT_BINS = 3, 30
DYNAMICS_FIELDS = [f"augmented_dickey_fuller__attr_{a}" for a in ("teststat", "pvalue", "usedlag")]
DYNAMICS_FIELDS += [f"friedrich_coefficients__coeff_{i}__m_3__r_30" for i in range(DRIFT_DEGREE + 1)]
DYNAMICS_FIELDS += ["max_langevin_fixed_point__m_3__r_30"]

# MacKinnon (1994) response surface, constant, one series.
TAU_MAX, TAU_MIN, TAU_SPLIT = 2.74, -18.83, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def _dickey_fuller_fit(x: np.ndarray, lags: int, first: int) -> tuple[float, float]:
    """(t of the level, AIC) of the regression with `lags` differences from row `first`."""
    d = np.diff(x)
    target = d[first:]
    columns = [x[first:-1], *[d[first - i: len(d) - i] for i in range(1, lags + 1)],
               np.ones(len(target))]
    design = np.column_stack(columns)
    beta, _, rank, _ = np.linalg.lstsq(design, target, rcond=None)
    rows, width = design.shape
    rss = float(((target - design @ beta) ** 2).sum())
    if rows <= width or rank < width or rss <= 0:
        return math.nan, math.nan
    cov = np.linalg.inv(design.T @ design) * rss / (rows - width)
    aic = rows * (math.log(2 * math.pi) + math.log(rss / rows) + 1) + 2 * width
    return float(beta[0] / math.sqrt(cov[0, 0])), aic


def _design(table: np.ndarray, lags: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Target, level, and the other columns of that regression, for every series."""
    d = np.diff(table)
    shifted = [d[:, first - i: d.shape[1] - i] for i in range(1, lags + 1)]
    return d[:, first:], table[:, first:-1], np.stack([np.ones_like(d[:, first:]), *shifted], axis=2)


def _fitted(columns: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the regressions on the first, first two, ... columns: the target along each new direction, the
    residuals' squares and the diagonal of R; and whether all of that is far from rounding errors."""
    directions, r = np.linalg.qr(columns)
    along = np.einsum("srk,sr->sk", directions, target)
    whole = (target ** 2).sum(axis=1)[:, None]
    rss = whole - np.cumsum(along ** 2, axis=1)
    diagonal = np.diagonal(r, axis1=1, axis2=2)
    size = np.abs(diagonal)
    clear = (size.min(axis=1) > 1e-7 * size.max(axis=1)) & (rss > 1e-6 * whole).all(axis=1)
    return along, rss, diagonal, clear


def _best_lags(table: np.ndarray, most: int) -> np.ndarray:
    """Lags of the least AIC, -1 without any. The regressions are nested: one QR has them all."""
    def one_by_one(x: np.ndarray) -> int:
        scored = [(_dickey_fuller_fit(x, k, most)[1], k) for k in range(most + 1)]
        return min((s for s in scored if not math.isnan(s[0])), default=(0.0, -1))[1]
    rows = table.shape[1] - 1 - most
    widths = np.arange(2, min(most + 2, rows - 1) + 1)  # of regressions with more rows than columns
    if not len(widths):
        return np.full(len(table), -1)
    target, level, others = _design(table, most, most)
    _, rss, _, clear = _fitted(np.concatenate([level[:, :, None], others], axis=2)[:, :, :widths[-1]], target)
    aic = rows * (math.log(2 * math.pi) + np.log(np.where(clear[:, None], rss[:, 1:], 1.0) / rows) + 1) + 2 * widths
    lags = aic.argmin(axis=1)
    for i in np.flatnonzero(~clear):
        lags[i] = one_by_one(table[i])
    return lags


def _level_t(table: np.ndarray, lags: int) -> np.ndarray:
    """t of the level in the regression with `lags` differences; the level is its last column here."""
    target, level, others = _design(table, lags, lags)
    rows, width = target.shape[1], lags + 2
    if rows <= width:
        return np.full(len(table), np.nan)
    along, rss, diagonal, clear = _fitted(np.concatenate([others, level[:, :, None]], axis=2), target)
    spread = np.where(clear, rss[:, -1], 1.0) / (rows - width)
    t = np.sign(diagonal[:, -1]) * along[:, -1] / np.sqrt(spread)
    for i in np.flatnonzero(~clear):
        t[i] = _dickey_fuller_fit(table[i], lags, lags)[0]
    return t


def _unit_root_p(stat: float) -> float:
    if math.isnan(stat):
        return math.nan
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    z = sum(c * stat**i for i, c in enumerate(TAU_SMALL if stat <= TAU_SPLIT else TAU_LARGE))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


@_of_table
def dickey_fuller(table: np.ndarray) -> np.ndarray:
    """Rows of (statistic, p, lags)."""
    n = table.shape[1]
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    out = np.full((len(table), 3), np.nan)
    varied = np.flatnonzero(table.std(axis=1) != 0)
    if most < 0 or not len(varied):
        return out
    lags = _best_lags(table[varied], most)
    for k in np.unique(lags[lags >= 0]):
        rows = varied[lags == k]
        stat = _level_t(table[rows], int(k))
        out[rows] = np.column_stack([stat, [_unit_root_p(t) for t in stat], np.where(np.isnan(stat), np.nan, k)])
    return out


def drift_polynomial(x: np.ndarray, edges: np.ndarray) -> np.ndarray | None:
    """Cubic fit of the mean next change over the mean level of the bins between `edges`."""
    level, change = x[:-1], np.diff(x)
    place = np.clip(np.searchsorted(edges, level, side="left") - 1, 0, DRIFT_BINS - 1)
    rows = np.bincount(place, minlength=DRIFT_BINS)
    used = rows > 0
    if used.sum() <= DRIFT_DEGREE:
        return None
    mean_level = np.bincount(place, level, DRIFT_BINS)[used] / rows[used]
    mean_change = np.bincount(place, change, DRIFT_BINS)[used] / rows[used]
    return np.polyfit(mean_level, mean_change, DRIFT_DEGREE)


def drift(table: np.ndarray) -> np.ndarray:
    """Rows of that fit's coefficients over 30 quantile bins and its largest root; none where bins coincide."""
    out = np.full((len(table), DRIFT_DEGREE + 2), np.nan)
    edges = np.quantile(table[:, :-1], np.linspace(0, 1, DRIFT_BINS + 1), axis=1).T
    for i in np.flatnonzero((np.diff(np.sort(edges, axis=1)) != 0).all(axis=1)):
        fit = drift_polynomial(table[i], edges[i])
        if fit is not None:
            out[i, :-1] = fit
            roots = np.roots(fit)
            if len(roots):
                out[i, -1] = np.max(roots.real)
    return out


def dynamics(table: np.ndarray) -> np.ndarray:
    if table.shape[1] <= 4:
        return np.full((len(table), len(DYNAMICS_FIELDS)), np.nan)
    return np.column_stack([dickey_fuller(table), drift(table)])


# --------------------------------------------------------------- time warping

def dtw_batch(a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray,
              window: int | None = None, limit: float = np.inf) -> np.ndarray:
    """Warping distance of many pairs at once: root of the cheapest path of squared
    differences. Rows of `a` and `b` are padded; `window` limits |i - j|. Pairs beyond
    `limit` are given up (infinite)."""
    n, m = a.shape[1], b.shape[1]
    a_t, b_t = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    alive = np.arange(len(a))
    above = np.full((m + 1, len(a)), np.inf)
    above[0] = 0.0
    out = np.full(len(a), np.inf)
    most = limit * limit * (1 + 1e-9)
    for i in range(n):
        row = np.full((m + 1, len(alive)), np.inf)
        low, high = (0, m) if window is None else (max(0, i - window), min(m, i + window + 1))
        for j in range(low, high):
            step = np.minimum(np.minimum(above[j + 1], row[j]), above[j])
            row[j + 1] = (a_t[i] - b_t[j]) ** 2 + step
        ends = np.flatnonzero(len_a[alive] == i + 1)
        out[alive[ends]] = row[len_b[alive[ends]], ends]
        above = row
        if i % 2 and np.isfinite(limit):
            keep = (above.min(axis=0) <= most) & (len_a[alive] > i + 1)
            if keep.sum() < 0.8 * len(keep):
                alive, above, a_t, b_t = alive[keep], above[:, keep], a_t[:, keep], b_t[:, keep]
                if not len(alive):
                    break
    out[out > most] = np.inf
    return np.sqrt(out)


STEPS = 90  # a limit has so many whole steps at least and fewer than twice as many: their square fits 16 bits
_MOST_STEPS = 16_000


def in_steps(limit: float, *tables: np.ndarray) -> tuple[list[np.ndarray], float, int]:
    """The tables in whole steps of a power of two, the limit in steps, and by how many steps two
    values may be nearer than their steps are (0 if all values are whole steps)."""
    step = 2.0 ** math.floor(math.log2(max(limit, 1e-290) / STEPS))
    with np.errstate(over="ignore"):
        exact = [np.nan_to_num(t / step) for t in tables]
    whole = [np.rint(t) for t in exact]
    loss = 0 if all(np.array_equal(t, w) for t, w in zip(exact, whole)) else 1
    return [np.clip(w, -_MOST_STEPS, _MOST_STEPS).astype("int16") for w in whole], limit / step, loss


def dtw_begins_near(a: np.ndarray, b: np.ndarray, last: np.ndarray, limit: float) -> np.ndarray:
    """Whether the distance of each pair may be within `limit`, by the cheapest beginnings of paths. Columns of
    `a` and `b` are series, or the beginnings of them; `last` is i + j at the end of a pair's paths."""
    (a, b), reach, loss = in_steps(limit, a, b)
    return dtw_steps_near(a, b, last, reach, loss)


def dtw_steps_near(a: np.ndarray, b: np.ndarray, last: np.ndarray, reach: float, loss: int,
                   len_a: np.ndarray | None = None) -> np.ndarray:
    """The same of series `in_steps`; with the lengths of the series in `a`, all columns are whole series, and paths are
    followed to their ends. Gaps and costs beyond the limit count as just beyond it, so that costs fit 16 bits.

    Costs go by diagonals i + j = k. A step leads to the next one or the one after, so each path meets one
    of two neighbouring diagonals, and a pair whose costs there all exceed the limit is left out.
    """
    most = int(reach * reach * (1 + 1e-9))
    (n, pairs), m = a.shape, len(b)
    near, alive = np.ones(pairs, dtype=bool), np.arange(pairs)
    # row i + 1 is the cell (i, k - i); rows of one number, as numpy is slow with a scalar beside 16 bits
    held = [np.full((n + 1, pairs), most + 1, dtype="uint16") for _ in range(3)]
    room, top, far = (np.empty((n, pairs), dtype="int16"), np.full(pairs, most + 1, dtype="uint16"),
                      np.full(pairs, int(reach) + 2, dtype="int16"))
    for k in range(min(n, m) if len_a is None else int(last.max(initial=-1)) + 1):
        step, now, before = (held[(k - i) % 3] for i in range(3))
        low, high = max(0, k - m + 1), min(k, n - 1) + 1
        gap = room[:high - low, :len(alive)]
        np.abs(np.subtract(a[low:high], b[k - high + 1:k - low + 1][::-1], out=gap), out=gap)
        if loss:
            gap -= np.minimum(gap, np.int16(loss))
        np.minimum(gap, far[:len(alive)], out=gap)
        cost, cells = gap.view("uint16"), step[low + 1:high + 1]
        np.multiply(cost, cost, out=cost)
        if k:
            np.minimum(now[low + 1:high + 1], now[low:high], out=cells)
            np.minimum(cells, before[low:high], out=cells)
            cells += cost
            np.minimum(cells, top[:len(alive)], out=cells)
        else:
            np.minimum(cost, top, out=cells)
        if len_a is not None:
            ends = np.flatnonzero(last == k)
            near[alive[ends]] = step[len_a[ends], ends] <= most
        if k and k % 3 == 0:
            earlier = now[max(0, k - m) + 1:min(k - 1, n - 1) + 2]
            done = (cells.min(axis=0) > most) & (earlier.min(axis=0) > most) & (last >= k)
            near[alive[done & (last > k)]] = False
            if len_a is None:
                near[alive[done]] = False
            else:
                done |= last <= k
            if done.sum() > 0.25 * len(done):
                kept = np.flatnonzero(~done)
                alive, last, a, b, *held = (x.take(kept, axis=-1) for x in (alive, last, a, b, *held))
                len_a = None if len_a is None else len_a[kept]
            if not len(alive) or k >= last.max():
                break
    return near


def dtw_diagonals(a: np.ndarray, len_a: np.ndarray, b: np.ndarray, len_b: np.ndarray, limit: float = np.inf) -> np.ndarray:
    """The distances of `dtw_batch` by diagonals; columns of `a` and `b` are padded series."""
    (n, pairs), m = a.shape, b.shape[0]
    out, alive, last = np.full(pairs, np.inf), np.arange(pairs), len_a + len_b - 2
    most = limit * limit * (1 + 1e-9)
    held = [np.full((n + 1, pairs), np.inf) for _ in range(3)]  # row i + 1 is the cell (i, k - i)
    for k in range(int(last.max(initial=-1)) + 1):
        step, now, before = (held[(k - i) % 3] for i in range(3))
        low, high = max(0, k - m + 1), min(k, n - 1) + 1
        cost = a[low:high] - b[k - high + 1:k - low + 1][::-1]
        cost *= cost
        if k:
            least = np.minimum(now[low + 1:high + 1], now[low:high])
            cost += np.minimum(least, before[low:high], out=least)
        step[low + 1:high + 1] = cost
        ends = np.flatnonzero(last == k)
        out[alive[ends]] = step[len_a[ends], ends]
        if k % 4 == 3:
            done = last <= k
            if np.isfinite(limit):
                done |= (cost.min(axis=0) > most) & (now[max(0, k - m) + 1:min(k - 1, n - 1) + 2].min(axis=0) > most)
            if done.sum() > 0.25 * len(done):
                kept = np.flatnonzero(~done)
                alive, last, len_a, len_b, a, b, *held = (x.take(kept, axis=-1) for x in (alive, last, len_a, len_b, a, b, *held))
    out[out > most] = np.inf
    return np.sqrt(out)


def runs_of(series: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the runs of equal neighbours, and how long each is."""
    starts = np.concatenate([[0], np.flatnonzero(series[1:] != series[:-1]) + 1])
    return series[starts], np.diff(np.append(starts, len(series)))


def dtw_runs(a: np.ndarray, table: np.ndarray, lengths: np.ndarray, limit: float = np.inf) -> np.ndarray:
    """Warping distance of one series to many (padded rows); infinite where it exceeds `limit`.

    All days of a run of `a` update the row of path costs in the same way, so a run is left as
    soon as a day changes nothing (small values make that late: paths may wait at them). A row is one pass, cost so far plus the least of (arrival - cost before it). Series whose whole
    row is beyond the limit are given up.
    """
    out = np.full(len(table), np.inf)
    if not len(a) or not len(table):
        return out
    alive = np.arange(len(table))
    most = limit * limit * (1 + 1e-9)
    past = np.full((len(table), table.shape[1] + 1), np.inf)  # column 0 lies before the first day
    past[:, 0] = 0.0
    part = table
    for value, length in zip(*runs_of(np.asarray(a, dtype=float))):
        cost = (part - value) ** 2
        total = np.cumsum(cost, axis=1)
        before = total - cost
        for _ in range(int(length)):
            now = np.minimum(past[:, 1:], past[:, :-1])
            now -= before
            np.minimum.accumulate(now, axis=1, out=now)
            now += total
            same = np.array_equal(now, past[:, 1:])
            past[:, 1:] = now
            past[:, 0] = np.inf
            if same:
                break
        if np.isfinite(limit):
            keep = past[:, 1:].min(axis=1) <= most
            if keep.sum() < 0.8 * len(keep):
                alive, past, part = alive[keep], past[keep], part[keep]
                if not len(alive):
                    return out
    out[alive] = np.sqrt(np.maximum(past[np.arange(len(alive)), lengths[alive]], 0.0))
    out[out > limit * (1 + 1e-12)] = np.inf
    return out


def padded(series: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in series], dtype="int64")
    table = np.zeros((len(series), int(lengths.max()) if len(series) else 0))
    for row, s in zip(table, series):
        row[: len(s)] = s
    return table, lengths
