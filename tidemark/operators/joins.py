"""Joins of panel, prediction and dimension tables on their keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import add_suffix
from tidemark.operators.sizes import small_side


def with_group_mean(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Mean of a group next to each of its rows.

    The mean is aggregated first, so a large group is reduced before the shuffle and is never gathered in one task.
    """
    means = df.groupBy(*by).agg(F.avg(column).alias(name))
    return df.join(small_side(means), list(by), "inner")


def update_column(df: DataFrame, updates: DataFrame, keys: Sequence[str], source: str, name: str) -> DataFrame:
    """Set a column from another table by key; rows without a match get NULL."""
    return df.join(updates.select(*keys, F.col(source).alias(name)), list(keys), "left")


def join_dimension(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a dimension that is broadcast when it was counted to be small."""
    return df.join(small_side(dimension), list(keys), "left")


def join_models(
    tables: Mapping[str, DataFrame], keys: Sequence[str], score: str = "probabilidad", shared: Sequence[str] = ()
) -> DataFrame:
    """Score tables of several models side by side, joined on the key.

    The score becomes ``<score>_<model>``. Columns in ``shared`` (the label) are taken from the first table.
    """
    named = []
    for i, (model, table) in enumerate(tables.items()):
        columns = [*keys, *(shared if i == 0 else ()), score]
        named.append(add_suffix(table.select(*columns), model, [score]))
    return reduce(lambda left, right: left.join(right, list(keys), "inner"), named)


def only_keys_of(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the other table, each once."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of tables with the same columns, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), others, first)
