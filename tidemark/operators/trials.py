"""Logs of experiments: best trial, statistics, importances and grid results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_trial(trials: DataFrame, value: str = "value", trial: str = "trial_number") -> DataFrame:
    """The trial with the largest value; the lowest number when several are equal."""
    best = F.min(F.struct((-F.col(value)).alias("loss"), F.col(trial).alias(trial)))
    return trials.where(F.col(value).isNotNull()).agg(best.alias("b")).select(
        F.col(f"b.{trial}").alias(trial), (-F.col("b.loss")).alias(value)
    )


def trial_statistics(trials: DataFrame, value: str = "value") -> DataFrame:
    return trials.agg(
        F.count(F.lit(1)).alias("total"),
        F.max(value).alias("best"),
        F.min(value).alias("worst"),
        F.avg(value).alias("mean"),
    )


def top_trials(trials: DataFrame, n: int = 5, value: str = "value", trial: str = "trial_number") -> DataFrame:
    return trials.orderBy(F.col(value).desc_nulls_last(), trial).limit(n)


def grid_summary(details: DataFrame, parameters: Sequence[str], value: str, n: int = 10) -> DataFrame:
    """Mean gain and number of runs per parameter tuple, the best ``n``."""
    return (
        details.groupBy(*parameters)
        .agg(F.avg(value).alias("mean_gain"), F.count(F.lit(1)).alias("runs"))
        .orderBy(F.col("mean_gain").desc_nulls_last(), *parameters)
        .limit(n)
    )


def not_done(grid: DataFrame, details: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Parameter tuples of a grid that the detail table has no rows for."""
    return grid.join(details.select(*parameters).distinct(), list(parameters), "left_anti")


def mean_importance(importances: DataFrame, n: int = 50) -> DataFrame:
    """Mean importance of each feature over models, without zeros, the largest ``n``."""
    return (
        importances.groupBy("feature")
        .agg(F.avg("importance").alias("importance"))
        .where(F.col("importance") > 0)
        .orderBy(F.col("importance").desc(), "feature")
        .limit(n)
    )
