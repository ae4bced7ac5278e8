"""Data quality and drift: constant columns, null and zero rates, stability index, group statistics.

Wide panels are measured in one pass: all columns of a month are one aggregate row, and a column's long form is made
from that row. Only the stability index needs the values themselves in long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import numeric
from tidemark.operators.ordering import exact_quantiles
from tidemark.operators.sizes import ROWS_PER_TASK, small_side


def zero_sd(df: DataFrame, columns: Sequence[str], period: str = "period") -> DataFrame:
    """(period, attribute, std_dev) where a column does not vary inside a period. A single row has no deviation."""
    wide = df.groupBy(period).agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return wide.unpivot(period, list(columns), "attribute", "std_dev").where(F.col("std_dev") == 0)


def null_constant_months(df: DataFrame, columns: Sequence[str], period: str = "period") -> DataFrame:
    """Set a column to NULL in the periods where it does not vary."""
    flags = df.groupBy(period).agg(
        *[((F.count(c) > 1) & (F.min(c) == F.max(c))).alias(f"_flat_{c}") for c in columns]
    )
    kept = {c: F.when(~F.coalesce(F.col(f"_flat_{c}"), F.lit(False)), F.col(c)) for c in columns}
    return df.join(small_side(flags), period, "left").withColumns(kept).select(*df.columns)


def monthly_evolution(df: DataFrame, by: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per month, or per month and label."""
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in numeric(df, {*by, *exclude})])


def _rate_drift(df, columns, condition, train: Column, score: Column, prefix: str) -> DataFrame:
    sides = df.select(train.alias("_t"), score.alias("_s"), *columns).where("_t or _s")
    measures = [F.count_if("_t").alias("_nt"), F.count_if("_s").alias("_ns")]
    for i, c in enumerate(columns):
        measures += [F.count_if(F.col("_t") & condition(c)).alias(f"_t{i}")]
        measures += [F.count_if(F.col("_s") & condition(c)).alias(f"_s{i}")]
    one_row = sides.agg(*measures)

    def percent(part: str, whole: str) -> Column:
        return F.col(part) * 100.0 / F.nullif(F.col(whole), F.lit(0))

    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("attribute"),
                percent(f"_t{i}", "_nt").alias(f"train_{prefix}_pct"),
                percent(f"_s{i}", "_ns").alias(f"score_{prefix}_pct"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one_row.select(F.inline(entries)).withColumn(
        "diff", F.abs(F.col(f"score_{prefix}_pct") - F.col(f"train_{prefix}_pct"))
    )


def null_rate_drift(df: DataFrame, columns: Sequence[str], train: Column, score: Column) -> DataFrame:
    """Percent of NULL per column on both sides and the difference; order by ``diff`` to see the worst."""
    return _rate_drift(df, columns, lambda c: F.col(c).isNull(), train, score, "null")


def zero_rate_drift(df: DataFrame, columns: Sequence[str], train: Column, score: Column) -> DataFrame:
    return _rate_drift(
        df, columns, lambda c: F.coalesce(F.col(c) == 0, F.lit(False)), train, score, "zero"
    )


def quantile_edges(
    df: DataFrame, by: Sequence[str], value: str, buckets: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Distinct quantile edges per group, in ascending order."""
    probabilities = [i / buckets for i in range(buckets + 1)]
    found = exact_quantiles(df, by, value, probabilities, name="edges", rows_per_task=rows_per_task)
    return found.withColumn("edges", F.array_sort(F.array_distinct("edges")))


def bin_of(value: Column, edges: Column) -> Column:
    """1-based bin of a value: closed on the left, the last bin closed on both ends; NULL outside the edges."""
    inside = (value >= F.get(edges, F.lit(0))) & (value <= F.element_at(edges, -1))
    below = F.size(F.filter(edges, lambda edge: edge <= value))
    return F.when(inside, F.least(below, F.size(edges) - 1))


def quantile_histogram(df: DataFrame, value: str, expected: Column, actual: Column, buckets: int) -> DataFrame:
    """Counts of the expected and the actual rows in the quantile bins of the expected rows."""
    edges = small_side(quantile_edges(df.where(expected), [], value, buckets))
    counted = (
        df.select(F.col(value).cast("double").alias("_v"), expected.alias("_e"), actual.alias("_a"))
        .where("_v is not null and (_e or _a)")
        .select("_v", "_e", "_a", edges.select("edges").scalar().alias("edges"))
        .withColumn("bin", bin_of(F.col("_v"), F.col("edges")))
        .where("bin is not null")
    )
    return counted.groupBy("bin").agg(
        F.get(F.first("edges"), F.col("bin") - 1).alias("low"),
        F.get(F.first("edges"), F.col("bin")).alias("high"),
        F.count_if("_e").alias("expected"),
        F.count_if("_a").alias("actual"),
    )


def psi_table(
    df: DataFrame,
    columns: Sequence[str],
    expected: Column,
    actual: Column,
    buckets: int = 10,
    epsilon: float | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Population stability index of every column: (feature, psi).

    Bins are the quantile bins of the expected rows. Shares are over all known values of a side, so values outside the
    edges lower the shares. The share of NULL adds a term when both sides have NULL. A bin that is empty on one side
    makes the index infinite, unless its empty share is taken as ``epsilon``. Without a known value on the actual side
    the index is NULL.

    All columns run together in long form. Before the shuffle the values are counted per (column, bin), so the shuffle
    carries a few rows per task.
    """
    columns = list(columns)
    values = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = (
        df.select(*columns, expected.alias("_e"), actual.alias("_a"))
        .where("_e or _a")
        .select("_e", "_a", F.inline(values))
    )
    edges = small_side(quantile_edges(long.where("_e"), ["feature"], "value", buckets, rows_per_task))
    binned = long.join(edges, "feature", "left").select(
        "feature", "_e", "_a", "value", bin_of(F.col("value"), F.col("edges")).alias("bin")
    )
    counts = binned.groupBy("feature", "bin", F.col("value").isNull().alias("_null")).agg(
        F.count_if("_e").alias("_ne"), F.count_if("_a").alias("_na")
    )
    known = ~F.col("_null")
    totals = counts.groupBy("feature").agg(
        F.sum(F.when(known, F.col("_ne"))).alias("_ke"),
        F.sum(F.when(known, F.col("_na"))).alias("_ka"),
        F.sum("_ne").alias("_te"),
        F.sum("_na").alias("_ta"),
        F.collect_list(
            F.struct(F.col("bin"), F.col("_null"), F.col("_ne").alias("e"), F.col("_na").alias("a"))
        ).alias("_cells"),
    )

    def term(part_e: Column, part_a: Column) -> Column:
        if epsilon is not None:
            part_e = F.when(part_e == 0, F.lit(epsilon)).otherwise(part_e)
            part_a = F.when(part_a == 0, F.lit(epsilon)).otherwise(part_a)
        one_empty = (part_e == 0) | (part_a == 0)
        return F.when(one_empty, float("inf")).otherwise((part_a - part_e) * F.log(part_a / part_e))

    def cell_term(cell: Column) -> Column:
        both_null = cell["_null"] & (cell["e"] > 0) & (cell["a"] > 0)
        in_bin = cell["bin"].isNotNull()
        return (
            F.when(both_null, term(cell["e"] / F.col("_te"), cell["a"] / F.col("_ta")))
            .when(in_bin, term(F.try_divide(cell["e"], F.col("_ke")), F.try_divide(cell["a"], F.col("_ka"))))
            .otherwise(0.0)
        )

    total = F.aggregate(F.col("_cells"), F.lit(0.0), lambda acc, cell: acc + cell_term(cell))
    return totals.select("feature", total.alias("psi"))


def psi(df: DataFrame, column: str, expected: Column, actual: Column, buckets: int = 10, **options) -> DataFrame:
    return psi_table(df, [column], expected, actual, buckets, **options)


def compare_group_stats(
    df: DataFrame, value: str, group: str, target: object, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Description of a variable in one group and in all other rows together."""
    sided = df.select((F.col(group) == target).alias("is_target"), F.col(value).alias("_v")).where(
        "is_target is not null"
    )
    stats = sided.groupBy("is_target").agg(
        F.count("_v").alias("n"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.countDistinct("_v").alias("n_unique"),
        F.count_if(F.col("_v").isNull()).alias("missing"),
    )
    quartiles = exact_quantiles(sided, ["is_target"], "_v", [0.25, 0.5, 0.75], rows_per_task=rows_per_task)
    # Two rows on each side of this join.
    return stats.join(quartiles, "is_target", "left").select(
        "is_target",
        "n",
        "mean",
        "std",
        "min",
        F.get("quantiles", F.lit(0)).alias("q25"),
        F.get("quantiles", F.lit(1)).alias("q50"),
        F.get("quantiles", F.lit(2)).alias("q75"),
        "max",
        "n_unique",
        "missing",
    )


def group_medians(
    df: DataFrame, columns: Sequence[str], group: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Median of each column per group: (group, feature, median). All columns are ranked together in long form."""
    values = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(group, F.inline(values))
    medians = exact_quantiles(long, [group, "feature"], "value", [0.5], rows_per_task=rows_per_task)
    return medians.select(group, "feature", F.get("quantiles", F.lit(0)).alias("median"))


def group_profile(df: DataFrame, group: str, label: str, score: str, labels: Sequence[str]) -> DataFrame:
    """Rows of each class per group, zero where there are none, and the mean score."""
    return df.groupBy(group).agg(
        *[F.count_if(F.col(label) == value).alias(value) for value in labels], F.avg(score).alias("mean_score")
    )


def z_score(df: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    """Distance from the group's mean in sample deviations.

    Mean and deviation come from an aggregate with one row per group, so no group is gathered in one task.
    """
    stats = df.groupBy(*by).agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_sd"))
    return df.join(small_side(stats), list(by), "left").select(
        *df.columns, ((F.col(column) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))).alias(name)
    )


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal-width bins."""
    place = F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.where(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
