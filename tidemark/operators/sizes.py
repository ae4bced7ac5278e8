"""Measured sizes: what may be broadcast or handled by one task is decided by counting first."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 100_000
ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class GroupSizes:
    total: int
    groups: int
    largest: int


def group_sizes(df: DataFrame, by: Sequence[str]) -> GroupSizes:
    """Rows, number of groups and rows of the largest group; counts are combined before the shuffle."""
    if not by:
        total = df.count()
        return GroupSizes(total, 1, total)
    row = (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("total"), F.count("n").alias("groups"), F.max("n").alias("largest"))
        .first()
    )
    return GroupSizes(row["total"] or 0, row["groups"], row["largest"] or 0)


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """A join side that is broadcast when it has at most ``max_rows`` rows.

    The rows are computed once, up to one more than the limit. A larger side comes back as it was, for a
    shuffle join, so the result is the same either way.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema))
