"""Ranks of customers inside a month. A month has no size limit, so these go through ``ranked``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked
from tidemark.operators.sizes import ROWS_PER_TASK


def add_group_ranks(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    tie_break: Sequence[str],
    tiles: Sequence[int] = (4, 10),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Row number, percent rank, cumulative distribution and tiles of ``column`` inside each group, NULL last."""
    placed = ranked(
        df,
        by,
        [column, *tie_break],
        position="_p",
        group_rows="_n",
        ties=("_first", "_last"),
        rows_per_task=rows_per_task,
    )
    p, n = F.col("_p"), F.col("_n")
    new = [
        p.cast("int").alias(f"{column}_row_number"),
        F.when(n > 1, (F.col("_first") - 1) / F.nullif(n - 1, F.lit(0))).otherwise(0.0).alias(f"{column}_percent_rank"),
        (F.col("_last") / n).alias(f"{column}_cume_dist"),
    ]
    for k in tiles:
        small = F.floor(n / k)
        longer = n % k
        in_long = p <= longer * (small + 1)
        tile = F.when(in_long, F.floor((p - 1) / (small + 1)) + 1).otherwise(
            longer + F.floor((p - 1 - longer * (small + 1)) / F.nullif(small, F.lit(0))) + 1
        )
        new.append(tile.cast("int").alias(f"{column}_tile{k}"))
    return placed.select(*[F.col(c) for c in df.columns], *new)


def signed_rank(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    tie_break: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace each value by its signed percentile inside the group.

    A positive value becomes its average rank among the group's positive values over their count; a negative value the
    same by magnitude with a minus sign; zero becomes 0.0 and NULL stays NULL.

    ``by`` and ``tie_break`` together are the key of a row. All columns are ranked in one long table of
    (key, column, value), so the wide rows are shuffled once and not once per column.
    """
    by, tie_break = list(by), list(tie_break)
    values = F.array(
        *[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]
    )
    long = (
        df.select(*by, *tie_break, F.inline(values))
        .where(F.col("value") != 0)
        .withColumns({"_sign": F.signum("value"), "_size": F.abs("value")})
    )
    placed = ranked(
        long,
        [*by, "column", "_sign"],
        ["_size", *tie_break],
        position="_p",
        group_rows="_n",
        ties=("_first", "_last"),
        rows_per_task=rows_per_task,
    )
    share = F.col("_sign") * (F.col("_first") + F.col("_last")) / 2 / F.col("_n")
    wide = placed.groupBy(*by, *tie_break).agg(
        *[F.max(F.when(F.col("column") == i, share)).alias(f"_rank_{c}") for i, c in enumerate(columns)]
    )
    replaced = {
        c: F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(F.col(f"_rank_{c}"), F.lit(0.0)))
        for c in columns
    }
    return df.join(wide, [*by, *tie_break], "left").withColumns(replaced).select(*df.columns)
