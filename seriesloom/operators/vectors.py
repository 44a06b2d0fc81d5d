"""Rows with an `array<double>` column, and the Arrow helpers for kernels on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q

# A matrix sent to every task is a model (codebook, centres, medoids), never
# data; its size is checked against this many numbers (64 MB).
MODEL_NUMBERS = 8_000_000


def to_vectors(df: DataFrame, columns: list[str], key: str = "sku_key") -> DataFrame:
    """(`key`, `vec`) from wide columns."""
    return df.select(key, F.array(*[F.col(q(c)).cast("double") for c in columns]).alias("vec"))


def check_model(matrix: np.ndarray) -> np.ndarray:
    if matrix.size > MODEL_NUMBERS:
        raise ValueError(f"a model of {matrix.size} numbers is too large to send to every task")
    return np.ascontiguousarray(matrix, dtype=float)


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a @ b.T  # worked on in place: the same numbers as of the whole expression
    d *= -2.0
    d += (a * a).sum(axis=1)[:, None]
    d += (b * b).sum(axis=1)[None, :]
    return np.maximum(d, 0.0, out=d)


def moments(df: DataFrame, vec: str = "vec") -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and population variance per coordinate, from one pass."""
    v = array_to_vector(F.col(vec))
    s = df.agg(Summarizer.metrics("count", "mean", "variance").summary(v).alias("s")).first()["s"]
    n = int(s["count"])
    return n, s["mean"].toArray(), s["variance"].toArray() * ((n - 1) / n if n else 0.0)


def standardized(df: DataFrame, vec: str = "vec") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Vectors with mean 0 and population variance 1 per coordinate; the center and width."""
    _, mean, var = moments(df, vec)
    width = np.where(var > 0, np.sqrt(var), 1.0)
    center = F.array(*[F.lit(float(m)) for m in mean])
    scale = F.array(*[F.lit(float(w)) for w in width])
    shifted = F.zip_with(vec, center, lambda x, m: x - m)
    return df.withColumn(vec, F.zip_with(shifted, scale, lambda x, w: x / w)), mean, width


def nearest(df: DataFrame, model: np.ndarray, key: str, vec: str = "vec", second: bool = False,
            name: str = "node") -> DataFrame:
    """(`key`, `name`, `dist`[, `second`]): the closest model row, lowest index on ties."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(check_model(model))
    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, {name} int, dist double" + (", second int" if second else "")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = as_matrix(batch.column(1))
            d = squared_distances(x, centres)
            best = d.argmin(axis=1)
            rows = np.arange(len(x))
            # exact distance of the winner: the expanded form cancels near zero
            gap = np.sqrt(((x - centres[best]) ** 2).sum(axis=1))
            columns = [batch.column(0), pa.array(best.astype("int32")), pa.array(gap)]
            names = [key, name, "dist"]
            if second:
                d[rows, best] = np.inf
                columns.append(pa.array(d.argmin(axis=1).astype("int32")))
                names.append("second")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return df.select(key, vec).mapInArrow(assign, schema)


def nearest_each(df: DataFrame, models: list[np.ndarray], key: str, names: list[str], vec: str = "vec") -> DataFrame:
    """(`key`, `names`): the closest row of each model, in one pass over the rows."""
    shared = df.sparkSession.sparkContext.broadcast([check_model(m) for m in models])
    schema = f"{key} {df.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} int" for n in names)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = as_matrix(batch.column(1))
                best = [squared_distances(x, m).argmin(axis=1).astype("int32") for m in shared.value]
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, best)], names=[key, *names])
    return df.select(key, vec).mapInArrow(assign, schema)
