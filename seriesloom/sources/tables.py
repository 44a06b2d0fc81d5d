"""CSV and Parquet tables of the pipeline.

Paths are Hadoop URIs, so a bucket or HDFS path works unchanged. CSV schemas are
declared, never inferred: inference reads the whole file once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null, q

INDEX_COLUMN = "Unnamed: 0"
MEASURES = ["sales", "selling_price", "avg_discount", "stock_open"]
LABEL_COLUMNS = ["sku_department", "sku_subdepartment", "sku_category",
                 "sku_subcategory", "sku_label"]


def _schema(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


TRANSACTIONS = _schema(
    ("sku_key", T.LongType()), ("tran_date", T.DateType()),
    *[(m, T.DoubleType()) for m in MEASURES],
    *[(c, T.StringType()) for c in LABEL_COLUMNS],
)
ASSIGNMENTS = _schema(("sku_key", T.LongType()), ("cluster", T.IntegerType()))


def _csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Read by header name: the file decides the column order, `schema` the types.

    Columns of the file that `schema` does not name (such as the saved index)
    are dropped; columns that the file lacks are left out.
    """
    header = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in schema.fields}
    file_schema = T.StructType(
        [T.StructField(h, types.get(h, T.StringType()), True) for h in header])
    df = (spark.read.schema(file_schema)
          .options(header=True, nanValue="NaN", mode="PERMISSIVE", **options).csv(path))
    return df.select(*[q(h) for h in header if h in types])


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """Store-level transactions without the index column, NaN as NULL."""
    if fmt == "csv":
        return nan_to_null(_csv(spark, path, schema))
    return nan_to_null(spark.read.format(fmt).load(path).drop(INDEX_COLUMN))


def read_keep_blanks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose blank text cells stay empty strings; numeric blanks are NULL."""
    df = nan_to_null(_csv(spark, path, schema))
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=texts)


def read_narrow(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A three-column product-day feed, renamed by position."""
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    names = ("sku_key", "tran_date", "sales")
    narrow = raw.drop(INDEX_COLUMN).toDF(*names)
    return nan_to_null(narrow.select(
        F.col("sku_key").cast("bigint"), F.col("tran_date").cast("date"),
        F.col("sales").cast("double")))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """An intermediate written by `write_table`."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return nan_to_null(_csv(spark, path, schema))
    return nan_to_null(spark.read.format(fmt).load(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    """Labels, product-days, features, splits or assignments to one folder."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_wide(long: DataFrame, path: str, key: str, column: str, value: str,
               columns: list, fmt: str = "parquet") -> None:
    """Pivot a long table at the sink only; `columns` fixes the wide schema."""
    wide = long.groupBy(key).pivot(column, columns).agg(F.first(value))
    write_table(wide, path, fmt)
