"""Registered queries: name, Spark plan and, where SQL can say it, the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name."""

    def register(plan: Plan) -> Plan:
        name = plan.__name__
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def r(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, where all executors can write."""
    return f"{shared_folder(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
