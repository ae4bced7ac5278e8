"""Churn labels of a panel, from the gaps in each customer's rows. All need one shuffle, by customer.

The three rules disagree on the last two periods and on customers who come back, so they are three functions.
``index`` is the consecutive period number; for YYYYMM periods use ``month_index``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import month_end
from tidemark.operators.windows import KEY, PERIOD

# The class names of the label.
STAYS = "CONTINUA"
GONE_NEXT = "BAJA+1"
GONE_AFTER_NEXT = "BAJA+2"


def _with_next(df: DataFrame, key: str, index: Column) -> DataFrame:
    rows = Window.partitionBy(key).orderBy("_i")
    return df.withColumn("_i", index).select(
        "*", F.lead("_i", 1).over(rows).alias("_i1"), F.lead("_i", 2).over(rows).alias("_i2")
    )


def _last_index(df: DataFrame, index: Column) -> Column:
    return df.select(index.alias("_i")).agg(F.max("_i")).scalar()


def churn_label(
    df: DataFrame, *, key: str = KEY, index: Column | None = None, name: str = "label", last: int | None = None
) -> DataFrame:
    """Gap rule: a missing next period is BAJA+1, also when the customer comes back later."""
    index = F.col(PERIOD) if index is None else index
    last = _last_index(df, index) if last is None else F.lit(last)
    i, i1, i2 = F.col("_i"), F.col("_i1"), F.col("_i2")
    label = (
        F.when((i < last) & (i1.isNull() | (i1 > i + 1)), GONE_NEXT)
        .when((i < last - 1) & (i1 == i + 1) & (i2.isNull() | (i2 > i + 2)), GONE_AFTER_NEXT)
        .when(i < last - 1, STAYS)
    )
    return _with_next(df, key, index).withColumn(name, label).drop("_i", "_i1", "_i2")


def churn_label_join(
    df: DataFrame,
    *,
    key: str = KEY,
    index: Column | None = None,
    name: str = "label",
    unknown: int | None = None,
    half_known: int | None = None,
) -> DataFrame:
    """Rule of the join on the next two calendar periods.

    Equal to looking up period + 1 and period + 2 of the same customer, without the two self joins. ``unknown`` is the
    period without any label, ``half_known`` the one where a missing second period hides the label; by default the last
    period and the one before it.
    """
    index = F.col(PERIOD) if index is None else index
    unknown = _last_index(df, index) if unknown is None else F.lit(unknown)
    half_known = unknown - 1 if half_known is None else F.lit(half_known)
    i, i1, i2 = F.col("_i"), F.col("_i1"), F.col("_i2")
    next_there = F.coalesce(i1 == i + 1, F.lit(False))
    second_there = F.coalesce((i1 == i + 2) | (i2 == i + 2), F.lit(False))
    label = (
        F.when((i == unknown) | (~second_there & (i == half_known)), F.lit(None).cast("string"))
        .when(~next_there, GONE_NEXT)
        .when(~second_there, GONE_AFTER_NEXT)
        .otherwise(STAYS)
    )
    return _with_next(df, key, index).withColumn(name, label).drop("_i", "_i1", "_i2")


def churn_label_final(
    df: DataFrame,
    *,
    key: str = KEY,
    index: Column | None = None,
    tenure: str = "tenure",
    name: str = "label",
) -> DataFrame:
    """Rule of customers who never come back, for periods that end two before the last one.

    Also adds the lowest tenure of the later rows and the last later period within two. The later rows are a frame of
    the customer's window, so no range self join is made.
    """
    index = F.col(PERIOD) if index is None else index
    indexed = df.withColumn("_i", index)
    later = Window.partitionBy(key).orderBy("_i").rowsBetween(1, Window.unboundedFollowing)
    near = Window.partitionBy(key).orderBy("_i").rangeBetween(1, 2)
    final = F.col("_final")
    return (
        indexed.select(
            "*",
            F.max("_i").over(later).alias("_final"),
            F.min(tenure).over(later).alias("min_later_tenure"),
            F.max("_i").over(near).alias("last_within_two"),
        )
        .where(F.col("_i") < _last_index(df, index) - 1)
        .withColumn(
            name,
            F.when(final.isNull(), GONE_NEXT).when(final == F.col("_i") + 1, GONE_AFTER_NEXT).otherwise(STAYS),
        )
        .drop("_i", "_final")
    )


def presence(df: DataFrame, *, key: str = KEY, period: str = PERIOD) -> DataFrame:
    """Every customer with every period, and whether the row is there.

    The periods of one customer are few, so they travel as an array; the periods of the panel are one array for all.
    """
    calendar = df.select(period).distinct().agg(F.array_sort(F.collect_list(period))).scalar()
    return (
        df.groupBy(key)
        .agg(F.collect_set(period).alias("_have"))
        .select(key, "_have", F.explode(calendar).alias(period))
        .select(key, period, F.array_contains("_have", F.col(period)).cast("int").alias("present"))
    )


def presence_ahead(df: DataFrame, *, key: str = KEY, period: str = PERIOD) -> DataFrame:
    """The panel's rows with flags for this period and the next two of the panel's calendar.

    A flag is NULL past the last period. The lattice of all customers and periods is not built: the next rows of the
    customer tell whether the next periods are there.
    """
    calendar = df.select(period).distinct().agg(F.array_sort(F.collect_list(period))).scalar()
    rows = Window.partitionBy(key).orderBy(period)
    placed = df.select("*", F.lead(period, 1).over(rows).alias("_p1"), F.lead(period, 2).over(rows).alias("_p2"))
    place = F.array_position(calendar, F.col(period)).cast("int")
    one, two = F.get(calendar, place), F.get(calendar, place + 1)
    there = F.coalesce((F.col("_p1") == two) | (F.col("_p2") == two), F.lit(False))
    return placed.select(
        *df.columns,
        F.lit(1).alias("present_0"),
        F.when(one.isNotNull(), F.coalesce(F.col("_p1") == one, F.lit(False)).cast("int")).alias("present_1"),
        F.when(two.isNotNull(), there.cast("int")).alias("present_2"),
    )


def binarize_label(
    df: DataFrame, label: str = "label", *, hit: str = GONE_AFTER_NEXT, positives: Sequence[str] = (GONE_NEXT, GONE_AFTER_NEXT)
) -> DataFrame:
    """``target_test`` marks the class that pays, ``target`` all churn classes; NULL labels stay NULL."""
    return df.withColumns(
        {
            "target_test": (F.col(label) == hit).cast("tinyint"),
            "target": F.col(label).isin(*positives).cast("tinyint"),
        }
    )


def month_end_index(period: Column) -> Column:
    """Months since year 0 of the month-end date of a YYYYMM period."""
    day = month_end(period)
    return F.year(day) * 12 + F.month(day)
