"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row limit under which a side may be broadcast; it is counted, never assumed.
BROADCAST_ROWS = 100_000


def ratio(num, den) -> Column:
    """num / den, NULL when the denominator is 0 or NULL (ANSI mode raises)."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def q(name: str) -> str:
    """Quote a column name."""
    return "`" + name.replace("`", "``") + "`"


def snap(c, digits: int = 6) -> Column:
    """Rounding by floor, used where summation order can show.

    The boundary is a little off one half, so that binary fractions such as
    1/128, which lie exactly between two steps, do not fall on either side.
    """
    scale = float(10**digits)
    return F.floor(as_col(c) * F.lit(scale) + F.lit(0.5137)) / F.lit(scale)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing value inside the library."""
    fixed = {
        f.name: F.when(F.isnan(q(f.name)), F.lit(None)).otherwise(F.col(q(f.name)))
        for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float")
    }
    return df.withColumns(fixed) if fixed else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when `df` has at most `rows` rows; reads no more than rows + 1."""
    return df.limit(rows + 1).count() <= rows


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `small` when its counted size allows, else leave the join to
    Catalyst (sort-merge with adaptive skew splitting)."""
    return big.join(F.broadcast(small) if is_small(small, rows) else small, on, how)
