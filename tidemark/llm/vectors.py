"""What the operators on whole-number vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: A key with at least one in so many rows is hot: there are at most so many hot keys.
HOT_SHARE = 10_000


def usable_vectors(df: DataFrame, limit: float, multiple: int = 1, column: str = "embedding") -> tuple[DataFrame, int]:
    """(rows whose vector takes part, its length): no null, every component finite and below ``limit``, of the commonest length.

    Only lengths that are a multiple of ``multiple`` count; of equally frequent ones the largest is taken, 0 if there is none.
    """
    size = F.size(column)
    fits = df.where(F.col(column).isNotNull() & (size > 0) & (size % multiple == 0))
    fits = fits.where(F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float(limit)), F.lit(False))))
    commonest = fits.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if commonest is None:
        return fits, 0
    return fits.where(size == commonest["size"]), commonest["size"]


def integer_matrix(column: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, a row for each vector; all vectors are of the same length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(x * float(scale)).astype(np.int64).reshape(len(column), -1)


WIDTHS = [np.dtype(t) for t in ("<i2", "<i4", "<i8")]


def matrix_bytes(x: np.ndarray) -> bytes:
    """A matrix of whole numbers in the narrowest type that holds them."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    width = next(w for w in WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
    return np.ascontiguousarray(x, width).tobytes()


def matrix_of(data: bytes, rows: int, columns: int) -> np.ndarray:
    """The matrix that ``matrix_bytes`` wrote; its width follows from its size."""
    size = len(data) // max(1, rows * columns)
    return np.frombuffer(data, next((w for w in WIDTHS if w.itemsize == size), WIDTHS[0])).reshape(rows, columns)


def with_total(rows: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``measure`` over all rows with the same ``key`` (nulls together; null if no long holds it).

    ``rows`` is a stored table. Keys with many rows are few and are broadcast, the rest are joined by a shuffle in which
    every key has fewer than one in HOT_SHARE of the rows.
    """
    total = F.try_sum(F.col(measure).cast("long")).alias(name)
    sums = stored(rows.groupBy(F.col(key).alias("_key")).agg(total, F.count(F.lit(1)).alias("_n")), "totals")
    least = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] / HOT_SHARE
    hot = sums.where(F.col("_n") >= least).drop("_n")  # HOT_SHARE rows at most
    out = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    if sums.where(F.col("_n") < least).isEmpty():
        return out.drop("_hot")
    cold = sums.where(F.col("_n") < least).drop("_n")
    rest = out.where("_hot IS NULL").drop("_hot", name).join(cold, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    return out.where("_hot").drop("_hot").unionByName(rest)
