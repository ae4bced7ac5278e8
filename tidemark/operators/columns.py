"""Column lists and projections over wide panels. Lists come from the schema, so no job runs for them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def with_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def numeric(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    left_out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in left_out]


def all_but(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    left_out = set(exclude)
    return [c for c in df.columns if c not in left_out]


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that the frame has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def drop_with_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return df.drop(*with_prefix(df, prefixes)) if prefixes else df


def add_suffix(df: DataFrame, suffix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns})


def first_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*first, *all_but(df, first))


def narrow_types(df: DataFrame, category_share: float = 0.5) -> tuple[DataFrame, list[str]]:
    """Cast number columns to the smallest type whose open range holds all values.

    One pass computes every minimum, maximum and distinct share. Also returns the text columns with few distinct
    values (share below ``category_share``), which parquet stores as a dictionary.
    """
    whole = [f.name for f in df.schema if isinstance(f.dataType, WHOLE_TYPES)]
    real = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    measures = [F.count(F.lit(1)).alias("n")]
    for c in whole + real:
        measures += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    measures += [F.approx_count_distinct(c).alias(f"nu_{c}") for c in texts]
    seen = df.agg(*measures).first()

    limits = (("byte", 2**7), ("short", 2**15), ("int", 2**31))
    largest_float = 3.4028234663852886e38
    casts = {}
    for c in whole:
        low, high = seen[f"lo_{c}"], seen[f"hi_{c}"]
        if low is not None:
            fit = next((t for t, size in limits if -size < low and high < size - 1), None)
            if fit:
                casts[c] = F.col(c).cast(fit)
    for c in real:
        low, high = seen[f"lo_{c}"], seen[f"hi_{c}"]
        if low is not None and -largest_float < low and high < largest_float:
            casts[c] = F.col(c).cast("float")
    categories = [c for c in texts if seen["n"] and seen[f"nu_{c}"] / seen["n"] < category_share]
    return (df.withColumns(casts) if casts else df), categories


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
