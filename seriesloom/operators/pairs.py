"""Blocked pair work: distances between rows without a table of pairs.

Rows carry a cell, such as a grid square or the nearest pivot. A cell is cut into
blocks of bounded size by hashed key, so a cell with a third of all rows becomes
many blocks. A task holds two blocks of neighbouring cells and runs a kernel on
the pair; what it emits is already reduced (sums, the k nearest, matches).
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import join_checked
from ..session import durable

BLOCK_ROWS = 2048
MOST_ROWS = 32_768  # of a block in a cell cut into a given number of blocks
SHARES, PAIRS_IN_SHARE = 4, 32  # shares of a core at least, and block pairs of a share at most, of tasks that are spread


def to_blocks(df: DataFrame, cell: list[str], key: str, rows: int = BLOCK_ROWS,
              most: int | None = None) -> DataFrame:
    """Add `_block`, a text naming the row's cell and its block in the cell.

    The rows are written once: cell sizes, the task list and both sides of the
    tasks read them. A row travels once per block that its block meets; with `most`, a cell is cut
    into no more blocks than that, until they have `MOST_ROWS`, so what travels grows with the rows.
    """
    df = durable(df)
    parts = F.ceil(F.col("_c") / rows)
    if most is not None:
        parts = F.greatest(F.least(parts, F.lit(most)), F.ceil(F.col("_c") / max(rows, MOST_ROWS)))
    large = (df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > rows)
             .withColumn("_parts", parts).drop("_c"))
    part = F.pmod(F.xxhash64(key), F.coalesce("_parts", F.lit(1)))
    return (join_checked(df, large, cell, "left")
            .withColumn("_block", F.concat_ws(":", *cell, part)).drop("_parts"))


def block_tasks(blocked: DataFrame, cell: list[str], neighbours: DataFrame | None = None,
                offsets: list[tuple] | None = None) -> DataFrame:
    """(`_a`, `_b`) block pairs, each once: cells listed in `neighbours`
    (columns `<cell>_a`, `<cell>_b`), at grid `offsets`, or the same cell. An
    offset of None leaves that cell column free."""
    blocks = blocked.select(*cell, "_block").distinct()
    left = blocks.select(*[F.col(c).alias(f"{c}_a") for c in cell], F.col("_block").alias("_a"))
    right = blocks.select(*[F.col(c).alias(f"{c}_b") for c in cell], F.col("_block").alias("_b"))
    if neighbours is not None:
        left = left.join(neighbours, [f"{c}_a" for c in cell])
    else:
        shifts = offsets or [tuple(0 for _ in cell)]
        fixed = [c for c, o in zip(cell, shifts[0]) if o is not None]
        near = F.array(*[F.struct(*[(F.col(f"{c}_a") + F.lit(o)).alias(f"{c}_b") if o
                                    else F.col(f"{c}_a").alias(f"{c}_b")
                                    for c, o in zip(cell, shift) if o is not None]) for shift in shifts])
        left = left.withColumn("_n", F.explode(near)).select("*", "_n.*").drop("_n")
        cell = fixed
    joined = left.join(right, [f"{c}_b" for c in cell])
    return joined.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()


def run_tasks(blocked: DataFrame, tasks: DataFrame, columns: list[str], schema: str,
              kernel: Callable[[dict, dict, bool], dict], spread: bool = False) -> DataFrame:
    """Ship both blocks of every task and run `kernel(a, b, same)` on them.

    `a` and `b` map column names to Arrow columns; `same` marks a block paired
    with itself. The kernel returns the output columns. With `spread`, block pairs are dealt to every
    core however few bytes they have: adaptive execution would put small ones, though costly, into one task.
    """
    if spread:
        tasks = durable(tasks)
        spark, many = blocked.sparkSession, tasks.count()
        shares = min(many, max(SHARES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")),
                               -(-many // PAIRS_IN_SHARE)))
    load = blocked.select("_block", *columns)
    a = load.join(tasks, load["_block"] == tasks["_a"]).select("_a", "_b", F.lit(0).alias("_side"), *columns)
    other = tasks.where(F.col("_a") != F.col("_b"))
    b = load.join(other, load["_block"] == other["_b"]).select("_a", "_b", F.lit(1).alias("_side"), *columns)
    names = [f.split()[0] for f in schema.split(", ")]

    def work(table: pa.Table) -> pa.Table:
        side = table.column("_side").to_numpy()
        sides = [table.filter(pa.array(side == s)) for s in (0, 1)]
        same = table.column("_a")[0].as_py() == table.column("_b")[0].as_py()
        parts = [{c: t.column(c).combine_chunks() for c in columns} for t in sides]
        out = kernel(parts[0], parts[0] if same else parts[1], same)
        return pa.table({n: out[n] for n in names})
    both = a.unionByName(b)
    if spread:
        both = both.repartition(max(1, shares), "_a", "_b")
    return both.groupBy("_a", "_b").applyInArrow(work, schema)
