"""Paired tests over gains and histories aligned on the churn date."""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import erfc
from tidemark.operators.labels import GONE_AFTER_NEXT
from tidemark.operators.ordering import ranked
from tidemark.operators.windows import KEY, PERIOD

EXACT_BELOW = 50


def signed_rank_distribution(spark: SparkSession, below: int = EXACT_BELOW) -> DataFrame:
    """P(V <= v) of the signed-rank statistic for n < ``below`` pairs: (n, v, cdf).

    The number of ways to reach v with ranks 1..n is the number of ways with 1..n-1 for v and for v - n.
    """
    ways, rows = [1], []
    for n in range(1, below):
        longer = ways + [0] * n
        for v, count in enumerate(ways):
            longer[v + n] += count
        ways, reached = longer, 0
        for v, count in enumerate(ways):
            reached += count
            rows.append((n, v, reached / 2**n))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["n", "v", "cdf"]), "n long, v long, cdf double")


def signed_rank_test(
    gains: DataFrame, by: Sequence[str], first: str = "gain1", second: str = "gain2", exact_below: int = EXACT_BELOW
) -> DataFrame:
    """Two-sided Wilcoxon signed-rank test of paired gains, one row per group.

    Exact for fewer than ``exact_below`` pairs without ties and zeros, else the normal approximation with tie and continuity
    correction. Pairs without a difference are left out.
    """
    by = list(by)
    diffs = gains.select(*by, first, second, (F.col(first) - F.col(second)).alias("_d"))
    placed = ranked(
        diffs.where("_d != 0").withColumn("_size", F.abs("_d")), by, ["_size", "_d"], position="_p", ties=("_lo", "_hi")
    ).withColumns({"_rank": (F.col("_lo") + F.col("_hi")) / 2, "_t": F.col("_hi") - F.col("_lo") + 1})
    # Each of the t rows of a tie adds t*t - 1, together t**3 - t.
    per_group = placed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("_d") > 0, F.col("_rank")).otherwise(0.0)).alias("v"),
        F.sum(F.col("_t") * F.col("_t") - 1).alias("_ties"),
    )
    totals = diffs.groupBy(*by).agg(
        F.count("_d").alias("pairs"), F.avg(first).alias("mean1"), F.avg(second).alias("mean2")
    )
    n, v = F.col("n"), F.col("v")
    both = totals.join(per_group, by, "left").withColumns({"n": F.coalesce(n, F.lit(0)), "v": F.coalesce(v, F.lit(0.0))})
    return _with_p_value(both, by, exact_below)


def _with_p_value(both: DataFrame, by: Sequence[str], exact_below: int) -> DataFrame:
    """Of rows (by, pairs, n, v, _ties, mean1, mean2): the two-sided p-value of each."""
    n, v = F.col("n"), F.col("v")
    whole = n * (n + 1) / 2
    distribution = signed_rank_distribution(both.sparkSession, exact_below).select(
        F.col("n").alias("_n"), F.col("v").alias("_v"), F.col("cdf").alias("_cdf")
    )
    exact = (n == F.col("pairs")) & (F.col("_ties") == 0) & (n < exact_below)
    # One row for each possible sum of up to ``exact_below`` ranks.
    found = both.withColumn("_key", F.when(exact, F.least(v, whole - v).cast("long"))).join(
        F.broadcast(distribution), (n == F.col("_n")) & (F.col("_key") == F.col("_v")), "left"
    )
    centred = v - whole / 2
    sigma = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_ties") / 48)
    z = (centred - F.signum(centred) * 0.5) / F.nullif(sigma, F.lit(0.0))
    tail = erfc(F.abs(z) / F.lit(math.sqrt(2.0)))
    p = F.when(exact, F.least(F.lit(1.0), 2 * F.col("_cdf"))).when(n > 0, tail)
    return found.select(*by, "pairs", "v", "mean1", "mean2", p.alias("p_value"))


class SignedRanks:
    """The signed-rank statistic of differences that come one by one.

    ``sizes`` are the distinct sizes in order, with how many differences have each and how many of these are positive. A new
    difference raises the ranks of all larger ones by one and those of its equals by a half, so the sum of the positive
    ranks grows by as many as are above it, half of its equals, and its own rank: nothing is ranked again.
    """

    def __init__(self) -> None:
        self.sizes: list[float] = []
        self.counts: list[int] = []
        self.positive: list[int] = []
        self.n, self.v, self.ties = 0, 0.0, 0

    def add(self, difference: float) -> None:
        if not difference:
            return
        size, up = abs(difference), difference > 0
        at = bisect.bisect_left(self.sizes, size)
        if at == len(self.sizes) or self.sizes[at] != size:
            self.sizes.insert(at, size)
            self.counts.insert(at, 0)
            self.positive.insert(at, 0)
        equal = self.counts[at]
        self.v += sum(self.positive[at + 1 :]) + self.positive[at] / 2
        if up:
            self.v += sum(self.counts[:at]) + equal / 2 + 1
        self.ties += 3 * equal * (equal + 1)  # (t + 1)**3 - (t + 1) less t**3 - t
        self.counts[at] += 1
        self.positive[at] += up
        self.n += 1


def sequential_test(
    gains: DataFrame, by: Sequence[str], ordinal: str, first: str = "gain1", second: str = "gain2", exact_below: int = EXACT_BELOW
) -> DataFrame:
    """The signed-rank test on the first 1, 2, … pairs of each group: (by, prefix, pairs, v, mean1, mean2, p_value).

    Each pair of gains is added once to the sorted differences of its group, and a row tells the state after it; there is a
    row for every whole number from the first ordinal of the group to the last. A group has a row per seed tried, so it
    fits a task. A pair without both gains counts in no test but reaches its prefix.
    """
    by = list(by)
    keys = [gains.schema[c] for c in by]
    numbers = ("prefix long, pairs long, n long, v double, _ties long, mean1 double, mean2 double").split(", ")
    schema = T.StructType([*keys, *[T.StructField(x.split()[0], T.LongType() if x.endswith("long") else T.DoubleType()) for x in numbers]])

    def states(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_o", kind="stable")
        held, out, sums, seen = SignedRanks(), [], [0.0, 0.0], [0, 0]
        pairs, ordinals = 0, rows["_o"].tolist()
        for i, (a, b) in enumerate(zip(rows["_a"].tolist(), rows["_b"].tolist())):
            for k, x in enumerate((a, b)):
                if x == x and x is not None:
                    sums[k] += x
                    seen[k] += 1
            difference = None if a is None or b is None else a - b
            if difference is not None and difference == difference:
                pairs += 1
                held.add(difference)
            means = [s / c if c else None for s, c in zip(sums, seen)]
            until = ordinals[i + 1] if i + 1 < len(ordinals) else ordinals[i] + 1
            out += [(*key, prefix, pairs, held.n, held.v, held.ties, *means) for prefix in range(ordinals[i], until)]
        return pd.DataFrame(out, columns=schema.names)

    rows = gains.where(F.col(ordinal).isNotNull()).select(
        *by, F.col(ordinal).cast("long").alias("_o"), F.col(first).cast("double").alias("_a"), F.col(second).cast("double").alias("_b")
    )
    return _with_p_value(rows.groupBy(*by).applyInPandas(states, schema), [*by, "prefix"], exact_below)


def sequential_choice(tests: DataFrame, by: Sequence[str], level: float = 0.05, cap: int | None = None) -> DataFrame:
    """Stop at the first prefix with p below the level: which model wins (0 when none does) and the pairs needed."""
    tried = tests if cap is None else tests.where(F.col("prefix") <= cap)
    decided = F.col("p_value") < level
    winner = F.when(F.col("mean1") > F.col("mean2"), 1).when(F.col("mean1") < F.col("mean2"), 2).otherwise(0)
    stop = F.min(F.when(decided, F.struct("prefix", winner.alias("winner"))))
    return tried.groupBy(*by).agg(stop.alias("_s"), F.max("prefix").alias("_last")).select(
        *by,
        F.coalesce(F.col("_s.winner"), F.lit(0)).alias("winner"),
        F.coalesce(F.col("_s.prefix"), F.col("_last")).alias("pairs_used"),
    )


def running_mean(gains: DataFrame, by: Sequence[str], ordinal: str, value: str, at: Sequence[int]) -> DataFrame:
    """Mean of the first i values for each i in ``at``; one row per seed, so groups are as large as the seed list."""
    rows = Window.partitionBy(*by).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    means = gains.select(*by, F.col(ordinal).alias("n_seeds"), F.avg(value).over(rows).alias("mean_gain"))
    return means.where(F.col("n_seeds").isin(*at))


def win_probability(gains: DataFrame, by: Sequence[str], first: str = "gain1", second: str = "gain2") -> DataFrame:
    """Share of the pairs in which the first gain is larger."""
    return gains.groupBy(*by).agg(F.avg((F.col(first) > F.col(second)).cast("double")).alias("win_probability"))


def churn_history(
    df: DataFrame,
    *,
    key: str = KEY,
    index: Column | None = None,
    label: str = "label",
    hit: str = GONE_AFTER_NEXT,
    keep_last: bool = False,
) -> DataFrame:
    """Rows of the customers that left, with the number of periods until they were gone.

    A customer is gone two periods after the last row labelled ``hit``. Customers with rows from then on came back and
    are left out, and so is the panel's last period.
    """
    index = F.col(PERIOD) if index is None else index
    indexed = df.withColumn("_i", index)
    customer = Window.partitionBy(key)
    gone = F.max(F.when(F.col(label) == hit, F.col("_i"))).over(customer) + 2
    marked = indexed.select("*", gone.alias("_gone"), F.max("_i").over(customer).alias("_seen"))
    kept = marked.where("_gone is not null and _seen < _gone")
    if not keep_last:
        kept = kept.where(F.col("_i") < indexed.agg(F.max("_i")).scalar())
    return kept.select(*df.columns, (F.col("_gone") - F.col("_i")).alias("periods_until_churn"))


def group_evolution(history: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """Mean of the columns by periods until churn and group."""
    return history.groupBy("periods_until_churn", *groups).agg(*[F.avg(c).alias(c) for c in columns])
