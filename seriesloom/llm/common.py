"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.columns import q
from seriesloom.session import ship_package

#: A word of every operator here: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the package made importable on the executors."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed inner names, so that no other column can clash."""
    return df.select(*[F.col(q(c)).alias(name) for name, c in columns.items()])


def size_of(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def text_slices(texts: list[str], characters: int = 3_000_000):
    """(start, end) of runs of texts with about so many characters, to bound a step's memory."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > characters:
            yield start, i
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts)
