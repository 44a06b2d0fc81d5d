"""From transactions to product-days, pivots, splits and series."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_col, is_small, join_checked, q
from ..sources.tables import LABEL_COLUMNS
from ..session import durable
from .ranking import sorted_rank

GRAINS = ("day", "week", "month", "quarter", "year")


def clean(df: DataFrame) -> DataFrame:
    """Drop the saved index, cast keys and measures, parse dates written as text."""
    df = df.drop("Unnamed: 0")
    if "sku_key" in df.columns:
        df = df.withColumn("sku_key", F.expr("try_cast(sku_key AS bigint)"))
    for measure in ("sales", "selling_price", "avg_discount", "stock_open"):
        if measure in df.columns:
            df = df.withColumn(measure, F.expr(f"try_cast({measure} AS double)"))
    if "tran_date" in df.columns:
        df = df.withColumn("tran_date", F.expr("try_cast(tran_date AS date)"))
    return df


def at_grain(date: str | Column, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    day = as_col(date).cast("date")
    return day if grain == "day" else F.date_trunc(grain, day).cast("date")


def product_day(tx: DataFrame, stock_agg: str = "mean", grain: str = "day") -> DataFrame:
    """Sum of sales and mean price, discount and stock per product and date.

    Rows without a key are left out and a sum over nothing is 0. One hash
    aggregate with a map-side partial, so a hot product costs one row per day
    and task in the shuffle.
    """
    if stock_agg not in ("mean", "sum"):
        raise ValueError("stock_agg must be 'mean' or 'sum'")
    stock = F.avg("stock_open") if stock_agg == "mean" \
        else F.coalesce(F.sum("stock_open"), F.lit(0.0))
    measures = {
        "sales": F.coalesce(F.sum("sales"), F.lit(0.0)),
        "selling_price": F.avg("selling_price"),
        "avg_discount": F.avg("avg_discount"),
        "stock_open": stock,
    }
    keyed = tx.where(F.col("sku_key").isNotNull() & F.col("tran_date").isNotNull())
    return (keyed.withColumn("tran_date", at_grain("tran_date", grain))
            .groupBy("sku_key", "tran_date")
            .agg(*[e.alias(m) for m, e in measures.items() if m in tx.columns]))


# digits that an order column takes, and the shift that makes it positive
_ORDER_DIGITS = {"date": (7, 1_000_000), "int": (10, 2**31 + 1), "bigint": (20, 2**63 + 1)}


def order_code(df: DataFrame, order: list[str]) -> Column:
    """The order columns as one comparable value, missing values first.

    Dates and integers become the digits of a decimal: a hash aggregate can keep
    the minimum of a decimal, while that of a struct needs every row sorted.
    """
    types = [df.schema[c].dataType.simpleString() for c in order]
    if any(t not in _ORDER_DIGITS for t in types) or sum(_ORDER_DIGITS[t][0] for t in types) > 38:
        return F.struct(*order)
    code, place = F.lit(0).cast("decimal(38,0)"), 0
    for column, kind in reversed(list(zip(order, types))):
        digits, shift = _ORDER_DIGITS[kind]
        number = F.unix_date(column) if kind == "date" else F.col(column)
        part = F.coalesce(number.cast("decimal(20,0)") + F.lit(Decimal(shift)), F.lit(Decimal(0)))
        code = code + part.cast("decimal(38,0)") * F.lit(Decimal(10**place))
        place += digits
    return code.cast("decimal(38,0)")


def first_labels(tx: DataFrame, order: list[str],
                 labels: list[str] = LABEL_COLUMNS) -> DataFrame:
    """The labels of each product's first row in `order`, a whole row at a time.

    Rows first collapse to the distinct label rows of a product with their
    earliest position, in a hash aggregate with map-side partials. A row_number
    over the product would sort all of its rows in one task.
    """
    variants = (tx.where(F.col("sku_key").isNotNull()).groupBy("sku_key", *labels)
                .agg(F.min(order_code(tx, order)).alias("_at")))
    first = F.min_by(F.struct(*labels), F.struct("_at", *labels)).alias("_row")
    return variants.groupBy("sku_key").agg(first).select("sku_key", "_row.*")


def with_labels(days: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of product-days to labels; both sides are hashed on the product."""
    return days.join(labels, "sku_key", "left")


def labelled_days(tx: DataFrame, order: list[str], stock_agg: str = "mean",
                  grain: str = "day") -> DataFrame:
    return with_labels(product_day(tx, stock_agg, grain), first_labels(tx, order))


def pivot_long(days: DataFrame, variable: str = "sales") -> DataFrame:
    """The product x date pivot in long form: mean per cell, empty cells absent."""
    return (days.groupBy("sku_key", "tran_date").agg(F.avg(variable).alias(variable))
            .where(F.col(variable).isNotNull()))


def calendar(cells: DataFrame) -> DataFrame:
    """The pivot's dates in order with their position and, as last, their number."""
    dates = cells.select("tran_date").distinct()
    listed = dates.agg(F.array_sort(F.collect_set("tran_date")).alias("_all"))
    return listed.select(F.size("_all").alias("n_dates"),
                         F.posexplode("_all").alias("date_pos", "tran_date"))


def date_list(cells: DataFrame) -> list:
    """Pivot columns; one entry per calendar date."""
    return [r[0] for r in cells.select("tran_date").distinct().orderBy("tran_date").collect()]


def pivot_wide(cells: DataFrame, variable: str = "sales", dates: list | None = None) -> DataFrame:
    """Products x dates as columns, sorted by date. For sinks; work on the long form."""
    dates = dates if dates is not None else date_list(cells)
    names = [str(d) for d in dates]
    return (cells.withColumn("_d", F.col("tran_date").cast("string"))
            .groupBy("sku_key").pivot("_d", names).agg(F.first(variable)))


def _n_dates(cells: DataFrame) -> Column:
    return cells.agg(F.count_distinct("tran_date")).scalar()


def null_counts(cells: DataFrame) -> DataFrame:
    """Missing dates per product. Order by (`nas`, `sku_key`) for the sorted table."""
    per_product = cells.groupBy("sku_key").agg(F.count(F.lit(1)).alias("_have"))
    return per_product.select("sku_key", (_n_dates(cells) - F.col("_have")).alias("nas"))


def below_half_coverage(cells: DataFrame) -> DataFrame:
    """How many products miss more than half of the table.

    The width counts the added `nas` column, hence the (dates + 1) / 2 limit.
    """
    return null_counts(cells).agg(
        F.count_if(F.col("nas") > (_n_dates(cells) + 1) / 2).alias("n_below"),
        F.count(F.lit(1)).alias("n_products"))


def start_flags(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`nan` is true for products without a value on the first date.

    `by` makes the first date that of a group (such as the cluster).
    """
    by = by or []
    starts = cells.groupBy(*by, "sku_key").agg(F.min("tran_date").alias("_start"))
    if by:
        starts = durable(starts)
        firsts = starts.groupBy(*by).agg(F.min("_start").alias("_first"))
        starts = join_checked(starts, firsts, by)
    else:
        starts = starts.withColumn("_first", cells.agg(F.min("tran_date")).scalar())
    return starts.select(*by, "sku_key", (F.col("_start") > F.col("_first")).alias("nan"))


def split_on_start(df: DataFrame, flags: DataFrame, subset: str = "none") -> DataFrame:
    """`df` for the products that start inside ('nan') or before ('no_nans') the period."""
    if subset == "none":
        return df
    if subset not in ("nan", "no_nans"):
        raise ValueError("subset must be 'nan', 'no_nans' or 'none'")
    keep = F.col("nan") if subset == "nan" else ~F.col("nan")
    return df.join(flags.where(keep).select("sku_key"), "sku_key", "left_semi")


def missing_products(flags: DataFrame, features: DataFrame) -> DataFrame:
    """Products of the split that have no features (a key error in a dense index)."""
    return flags.join(features.select("sku_key"), "sku_key", "left_anti").select("sku_key")


def _spans(cells: DataFrame, variable: str, dates: DataFrame) -> DataFrame:
    """Each observed cell with the positions it stands for: its own and the gap behind it,
    the first one also the gap before it."""
    placed = join_checked(cells, dates, "tran_date")
    w = W.partitionBy("sku_key").orderBy("date_pos")
    return placed.select(
        "sku_key", "date_pos", "n_dates", F.col(variable).alias("_v"),
        F.when(F.row_number().over(w) == 1, F.lit(0)).otherwise(F.col("date_pos")).alias("_from"),
        (F.coalesce(F.lead("date_pos").over(w), F.col("n_dates")) - 1).alias("_to"))


def _stretched(spans: DataFrame, dates: DataFrame, keys: list[str], variable: str) -> DataFrame:
    grid = spans.select(*keys, "date_pos", "_v", F.explode(F.sequence("_from", "_to")).alias("_p"))
    hit = F.col("_p") == F.col("date_pos")
    grid = grid.select(*keys, F.col("_p").alias("date_pos"),
                       F.when(hit, F.col("_v")).alias(variable), (~hit).alias("is_missing"))
    return join_checked(grid, dates.select("date_pos", "tran_date"), "date_pos")


def filled_cells(cells: DataFrame, variable: str = "sales") -> DataFrame:
    """Every product x date cell with `is_missing`, by stretching each observed
    cell over the gap behind it: the work stays inside the product's partition."""
    dates = durable(calendar(cells))
    return _stretched(_spans(cells, variable, dates), dates, ["sku_key"], variable)


def coverage_map(cells: DataFrame, variable: str = "sales") -> DataFrame:
    """The picture of missing cells as a table: products ranked by missing dates. Ranks meet
    the observed cells; the grid of all cells is made behind the last shuffle and sort."""
    dates = durable(calendar(cells))
    ranked = sorted_rank(null_counts(cells), ["nas", "sku_key"]).select("sku_key", "rank")
    spans = _spans(cells, variable, dates).join(ranked, "sku_key")
    return _stretched(spans, dates, ["rank", "sku_key"], variable).select(
        "rank", "sku_key", "tran_date", variable, "is_missing")


def series(cells: DataFrame, variable: str = "sales", fill: bool = False, as_runs: bool = False) -> DataFrame:
    """One ordered array per product, gaps left out or filled with 0 (made from `run_series`, and
    with `as_runs` left in its form)."""
    if as_runs and not fill:
        raise ValueError("runs are made of series filled with 0")
    if as_runs:
        return run_series(cells, variable)
    if fill:
        return run_series(cells, variable).select("sku_key", F.flatten(F.transform(
            "runs", lambda r: F.array_repeat(r["value"], r["length"]))).alias("series"))
    entries = F.array_sort(F.collect_list(F.struct("tran_date", F.col(variable).alias("v"))))
    return cells.where(F.col(variable).isNotNull()).groupBy("sku_key").agg(
        F.transform(entries, lambda e: e["v"]).alias("series"))


def run_series(cells: DataFrame, variable: str = "sales") -> DataFrame:
    """(`sku_key`, `runs`): the zero-filled series of each product as runs (value, length) in order
    of dates, neighbours never of the same value.

    Runs follow from the observed cells alone: a cell stands for itself and for the gap before
    it, the last one also for the gap behind it. No row or array grows with the calendar.
    A NULL cell counts as a gap.
    """
    dates = durable(calendar(cells))
    placed = join_checked(cells, dates, "tran_date")
    by_date, by_place = (W.partitionBy("sku_key").orderBy(c) for c in ("date_pos", "at"))
    value, pos, zero = F.coalesce(F.col(variable), F.lit(0)).cast("double"), F.col("date_pos"), F.lit(0.0)
    behind = F.when(F.lead("date_pos").over(by_date).isNull(), F.col("n_dates") - pos - 1).otherwise(F.lit(0))
    stretched = placed.select("sku_key", pos, value.alias("v"), behind.alias("behind"),
                              F.coalesce(F.lag("date_pos").over(by_date) + 1, F.lit(0)).alias("free"))
    pieces = F.array(*[F.struct(at.alias("at"), v.alias("v"), n.alias("n")) for at, v, n in (
        (F.col("free"), zero, pos - F.col("free")), (pos, F.col("v"), F.lit(1)), (pos + 1, zero, F.col("behind")))])
    rows = stretched.select("sku_key", F.inline(F.filter(pieces, lambda p: p["n"] > 0)))
    marked = rows.withColumn("turn", (F.lag("v").over(by_place) != F.col("v")).cast("int"))
    numbered = marked.withColumn("run", F.coalesce(F.sum("turn").over(by_place), F.lit(0)))
    runs = numbered.groupBy("sku_key", "run").agg(F.first("v").alias("value"), F.sum("n").cast("int").alias("length"))
    entries = F.array_sort(F.collect_list(F.struct("run", "value", "length")))
    return runs.groupBy("sku_key").agg(F.transform(
        entries, lambda e: F.struct(e["value"].alias("value"), e["length"].alias("length"))).alias("runs"))


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop()


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, subset=columns)


def lookup(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str,
           name: str) -> DataFrame:
    """Map a column through a two-column table; unknown keys give NULL."""
    pairs = mapping.select(F.col(key).alias("_key"), F.col(value).alias(name))
    joined = join_checked(df, pairs, df[column] == pairs["_key"], "left")
    return joined.drop("_key")


def one_hot_long(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(`keys`, `dummy`) with one row per set level; no width limit."""
    return df.select(*keys, F.explode(F.array(*[
        F.concat(F.lit(c + "_"), F.col(c)) for c in columns])).alias("dummy")
    ).where(F.col("dummy").isNotNull())


def levels_of(df: DataFrame, columns: list[str], limit: int = 10_000) -> dict[str, list[str]]:
    """Sorted levels per column; they become columns, so their number is checked."""
    levels = durable(df.select(*columns).unpivot([], columns, "column", "level")
                     .where(F.col("level").isNotNull()).distinct())
    if not is_small(levels, limit):
        raise ValueError(f"over {limit} levels do not fit a row: use one_hot_long")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for column, level in sorted(tuple(r) for r in levels.collect()):
        found[column].append(level)
    return found


def one_hot(df: DataFrame, columns: list[str], levels: dict | None = None) -> DataFrame:
    """Replace text columns by 0/1 columns `<column>_<level>`, all levels kept."""
    levels = levels or levels_of(df, columns)
    dummies = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
               for c in columns for v in levels[c]]
    kept = [q(c) for c in df.columns if c not in columns]
    return df.select(*kept, *dummies)


def hash_order(keys: list[str], seed: int) -> Column:
    """A number below 16**15 from the keys' text, the same on any engine that has MD5."""
    text = F.concat_ws("|", *[F.col(q(k)).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def train_test_split(df: DataFrame, keys: list[str], train: int = 75,
                     seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """A split by hashed key: stable under re-runs and repartitioning."""
    side = hash_order(keys, seed) % 100 < train
    return df.where(side), df.where(~side)


def sample_exact(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """Exactly n rows without replacement, chosen by hashed key.

    A hash threshold lets slightly more than n rows through, and those are ranked by
    a sort over all tasks, so neither the table nor the sample meets in one task.
    """
    total = df.count()
    if n >= total:
        return df
    share = min(1.0, (n + 6 * n**0.5 + 16) / total)
    order = hash_order(keys, seed)
    near = df.where(order <= int(share * 16**15))
    if near.count() < n:
        near = df
    ranked = sorted_rank(near.withColumn("_order", order), ["_order", *keys], "_rank")
    return ranked.where(F.col("_rank") < n).drop("_order", "_rank")


def numeric_columns(df: DataFrame, but: list[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in but]
