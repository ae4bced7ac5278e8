"""Functions for Spark SQL text, usable also inside window calls."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFINITIONS = {
    "sum_without_null": "(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN ifnull(a, 0) + ifnull(b, 0)",
    "safe_ratio": "(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN a / nullif(b, 0)",
    "gain_of": "(label STRING, hit STRING) RETURNS BIGINT RETURN if(label <=> hit, 780000, -20000)",
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(DEFINITIONS)
