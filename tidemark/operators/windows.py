"""History features per customer.

All use the same window: the customer's rows in period order. Spark shuffles and sorts once for all of them when they
follow each other. A customer has one row per period, so no customer can be larger than the number of periods;
``check_panel_key`` counts that.

Frames count rows, not calendar periods: after a gap ``_lag1`` is the last row present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import present

KEY, PERIOD = "cust", "period"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _over(key: str, period: str, rows_back: int | None = None) -> str:
    """The customer's window as SQL text. Wide panels need hundreds of expressions, and one text each is quick to build."""
    frame = "" if rows_back is None else f" ROWS BETWEEN {rows_back} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY {quoted(key)} ORDER BY {quoted(period)}{frame})"


def check_panel_key(df: DataFrame, key: str = KEY, period: str = PERIOD) -> DataFrame:
    """One row: rows, distinct keys that occur more than once, periods, and rows of the largest customer."""
    per_key = df.groupBy(key, period).agg(F.count(F.lit(1)).alias("n"))
    per_customer = per_key.groupBy(key).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"))
    totals = per_customer.agg(
        F.sum("n").alias("n_rows"), F.sum("repeated").alias("repeated_keys"), F.max("n").alias("largest_customer")
    )
    return totals.select("*", df.select(period).distinct().agg(F.count(period)).scalar().alias("periods"))


def add_lags(df: DataFrame, columns: Sequence[str], lags: Sequence[int] = (1, 2), *, key=KEY, period=PERIOD) -> DataFrame:
    over = _over(key, period)
    return df.selectExpr(
        "*", *[f"lag({quoted(c)}, {k}) {over} AS {quoted(f'{c}_lag{k}')}" for c in present(df, columns) for k in lags]
    )


def add_leads(df: DataFrame, columns: Sequence[str], leads: Sequence[int] = (1, 2), *, key=KEY, period=PERIOD) -> DataFrame:
    over = _over(key, period)
    return df.selectExpr(
        "*", *[f"lead({quoted(c)}, {k}) {over} AS {quoted(f'{c}_lead{k}')}" for c in present(df, columns) for k in leads]
    )


def add_deltas(df: DataFrame, columns: Sequence[str], lags: Sequence[int] = (1, 2)) -> DataFrame:
    """Value minus its lag, for the lags that are already in the frame."""
    have = set(df.columns)
    pairs = [(c, k) for c in present(df, columns) for k in lags if f"{c}_lag{k}" in have]
    return df.selectExpr(
        "*", *[f"{quoted(c)} - {quoted(f'{c}_lag{k}')} AS {quoted(f'{c}_delta{k}')}" for c, k in pairs]
    )


def add_rolling(
    df: DataFrame,
    columns: Sequence[str],
    window: int = 6,
    functions: Sequence[str] = ("min", "max", "avg"),
    *,
    key=KEY,
    period=PERIOD,
) -> DataFrame:
    """Minimum, maximum and average over the last ``window`` rows, this row included."""
    unknown = set(functions) - {"min", "max", "avg"}
    if unknown:
        raise ValueError(f"unknown functions: {sorted(unknown)}")
    over = _over(key, period, window - 1)
    return df.selectExpr(
        "*",
        *[f"{f}({quoted(c)}) {over} AS {quoted(f'{c}_{f}{window}')}" for c in present(df, columns) for f in functions],
    )


def add_ratio_avg(df: DataFrame, columns: Sequence[str], window: int = 6) -> DataFrame:
    """Value over its rolling average; NULL where that average is zero."""
    return df.selectExpr(
        "*",
        *[
            f"{quoted(c)} / nullif({quoted(f'{c}_avg{window}')}, 0) AS {quoted(f'{c}_ratioavg{window}')}"
            for c in present(df, columns)
        ],
    )


def add_trend(
    df: DataFrame, columns: Sequence[str], steps_back: int = 3, tenure: str = "tenure", *, key=KEY, period=PERIOD
) -> DataFrame:
    """Least-squares slope against tenure over ``steps_back`` rows and this one, so ``steps_back + 1`` rows.

    NULL with fewer than two known points or equal tenure.
    """
    over = _over(key, period, steps_back)
    return df.selectExpr(
        "*",
        *[
            f"regr_slope({quoted(c)}, {quoted(tenure)}) {over} AS {quoted(f'{c}_trend_{steps_back}m')}"
            for c in present(df, columns)
        ],
    )


def add_history(
    df: DataFrame,
    columns: Sequence[str],
    window: int = 6,
    outputs: Sequence[str] = ("tend", "min", "max", "avg", "ratioavg", "ratiomax"),
    *,
    key=KEY,
    period=PERIOD,
) -> DataFrame:
    """Trend, minimum, maximum, average and ratios over the last ``window`` rows.

    The trend runs over the row's place in the window; a NULL value is left out but keeps its place. With fewer than
    two known values everything is NULL.
    """
    over = _over(key, period, window - 1)
    placed = df.selectExpr("*", f"row_number() {_over(key, period)} AS _place")
    new = []
    for c in present(df, columns):
        y = quoted(c)
        made = {
            "tend": f"regr_slope({y}, _place) {over}",
            "min": f"min({y}) {over}",
            "max": f"max({y}) {over}",
            "avg": f"avg({y}) {over}",
            "ratioavg": f"{y} / nullif(avg({y}) {over}, 0)",
            "ratiomax": f"{y} / nullif(max({y}) {over}, 0)",
        }
        new += [f"if(count({y}) {over} > 1, {made[o]}, NULL) AS {quoted(f'{c}_{o}{window}')}" for o in outputs]
    return placed.selectExpr("*", *new).drop("_place")
