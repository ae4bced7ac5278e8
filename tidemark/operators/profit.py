"""Campaign profit: gain per contact, cumulative and plateau gain, cutoffs, leaderboards.

A score table is a long table with one row per (group, customer), where the group may be a model, a fold, a repeat.
Orders end in the customer key, so ties in the score do not make results depend on the input's row order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.labels import GONE_AFTER_NEXT
from tidemark.operators.ordering import ranked, top_cuts
from tidemark.operators.sampling import in_split, repeated_bits
from tidemark.operators.sizes import ROWS_PER_TASK, small_side
from tidemark.session import cut_lineage

# What a reached customer of the class is worth, what a contact costs, and the threshold they imply.
HIT_VALUE = 780_000
CONTACT_COST = 20_000
THRESHOLD = 1 / 40


def gain(label: Column | str = "label", hit: object = GONE_AFTER_NEXT) -> Column:
    """Profit of contacting a customer; a customer without a label counts as a miss."""
    label = F.col(label) if isinstance(label, str) else label
    return F.when(label.eqNullSafe(F.lit(hit)), HIT_VALUE).otherwise(-CONTACT_COST).cast("long")


def total_gain(df: DataFrame, predicates: Mapping[str, Column], value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Gain of contacting every row of each predicate."""
    return df.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(p, value)), F.lit(0)).alias(name) for name, p in predicates.items()]
    )


def rate_and_lift(df: DataFrame, predicate: Column, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rate of an event inside a predicate, over all rows, and their ratio."""
    hit = F.coalesce(event, F.lit(False)).cast("double")
    rates = df.groupBy(*by).agg(F.avg(F.when(predicate, hit)).alias("rate_inside"), F.avg(hit).alias("rate"))
    return rates.withColumn("lift", F.col("rate_inside") / F.nullif(F.col("rate"), F.lit(0.0)))


def cut_gains(df: DataFrame, feature: str, value: Column, low: int, high: int) -> DataFrame:
    """Gain of ``feature < cut`` for every whole cut in [low, high].

    The rows are summed per first cut that lets them in, so one pass serves all cuts.
    """
    first_cut = F.greatest(F.lit(low), F.floor(feature) + 1).cast("int")
    sums = (
        df.where(F.col(feature) < high)
        .groupBy(first_cut.alias("cut"))
        .agg(F.sum(value).alias("part"))
    )
    cuts = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("cut"))
    # At most one row per cut.
    up_to = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cuts.join(sums, "cut", "left").select(
        "cut", F.coalesce(F.sum("part").over(up_to), F.lit(0)).cast("long").alias("gain")
    )


def best_cut(df: DataFrame, feature: str, value: Column, low: int, high: int) -> DataFrame:
    """The cut with the largest gain; the lowest one when several are equal."""
    best = F.min(F.struct((-F.col("gain")).alias("loss"), F.col("cut").alias("cut")))
    return cut_gains(df, feature, value, low, high).agg(best.alias("best")).select(
        F.col("best.cut").alias("cut"), (-F.col("best.loss")).alias("gain")
    )


def cumulative_gain(
    df: DataFrame,
    score: str = "prob",
    value: Column | None = None,
    *,
    by: Sequence[str] = (),
    key: Sequence[str] = ("cust",),
    group_rows: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Position by falling score and running gain ``gan_acum`` inside each group."""
    value = gain() if value is None else value
    return ranked(
        df,
        by,
        [f"-{score}", *key],
        running={"gan_acum": value},
        group_rows=group_rows,
        rows_per_task=rows_per_task,
    )


def gain_summary(curve: DataFrame, score: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """Largest cumulative gain, the number of contacts that reaches it first, and the score there."""
    best = F.min(
        F.struct((-F.col("gan_acum")).alias("loss"), F.col("position").alias("position"), F.col(score).alias("score"))
    )
    return curve.groupBy(*by).agg(best.alias("best"), F.count(F.lit(1)).alias("n_rows")).select(
        *by,
        (-F.col("best.loss")).alias("max_gain"),
        F.col("best.position").alias("contacts"),
        F.col("best.score").alias("threshold"),
        "n_rows",
    )


def plateau(
    curve: DataFrame,
    width: int,
    *,
    by: Sequence[str] = (),
    partial: bool = True,
    value: str = "gan_acum",
    group_rows: str = "group_rows",
    name: str = "gan_meseta",
    block: int = 50_000,
) -> DataFrame:
    """Centred mean of the cumulative gain over ``width`` positions (odd).

    ``partial`` keeps shorter means at both ends; else they are NULL. Blocks of positions are computed apart, each with
    half a width of rows copied from its neighbours. Inside a block the mean is the difference of two running sums
    over the width, so its cost does not grow with the width.
    """
    half, block = width // 2, max(block, width)
    position, n = F.col("position"), F.col(group_rows)
    own = F.floor((position - 1) / block)
    first_needed = F.floor(F.greatest(position - 1 - half, F.lit(0)) / block)
    last_needed = F.floor(F.least(position - 1 + half, n - 1) / block)
    copies = curve.select(
        "*", own.alias("_own"), F.explode(F.sequence(first_needed, last_needed)).alias("_block")
    )
    rows = Window.partitionBy(*by, "_block").orderBy("position")
    base = F.first(F.col(value)).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    level = copies.withColumn("_base", base)
    total = F.sum(F.col(value) - F.col("_base")).over(
        rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = level.withColumn("_total", total)
    whole = F.last("_total").over(rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    upper = F.coalesce(F.lead("_total", half).over(rows), whole)
    lower = F.coalesce(F.lag("_total", half + 1).over(rows), F.lit(0))
    low_end, high_end = F.greatest(position - half, F.lit(1)), F.least(position + half, n)
    seen = high_end - low_end + 1
    mean = F.col("_base") + (upper - lower) / seen
    if not partial:
        mean = F.when(seen == width, mean)
    return summed.withColumn(name, mean).where(F.col("_own") == F.col("_block")).select(*curve.columns, name)


def plateau_gain(curve: DataFrame, width: int, *, by: Sequence[str] = (), **options) -> DataFrame:
    """Best plateau per group."""
    return plateau(curve, width, by=by, **options).groupBy(*by).agg(F.max("gan_meseta").alias("plateau_gain"))


def label_top_k(
    df: DataFrame,
    k: int,
    score: str = "prob",
    *,
    by: Sequence[str] = (),
    key: Sequence[str] = ("cust",),
    name: str = "Predicted",
    rows_per_task: int = ROWS_PER_TASK,
    **options,
) -> DataFrame:
    """1 for exactly the k best rows of each group, else 0; ``key`` tells the rows of a group apart.

    The cut is found by counting (see ``top_cuts``), so the rows are neither ranked nor shuffled; they are compared with
    the cut of their group. Scores that are missing or not finite are ranked instead.
    """
    if k <= 0:
        return df.withColumn(name, F.lit(0))
    slim = cut_lineage(df.select(*dict.fromkeys([*by, score, *key])))
    cuts = top_cuts(slim, by, score, key, k, **options)
    if cuts is None:
        placed = ranked(df, by, [f"-{score}", *key], position="_p", rows_per_task=rows_per_task)
        return placed.withColumn(name, (F.col("_p") <= k).cast("int")).drop("_p")
    cuts = small_side(cuts.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("cut").alias("_cut")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]) if by else F.lit(True)
    value, cut = F.col(score).cast("double"), F.col("_cut")
    inside = (value > cut["score"]) | ((value == cut["score"]) & (F.struct(*key) <= F.struct(*[cut[c].alias(c) for c in key])))
    marked = df.join(cuts, same, "left").withColumn(name, F.coalesce(inside, F.lit(False)).cast("int"))
    return marked.select(*[c for c in df.columns if c != name], name)


def label_by_threshold(score: Column | str = "prob", threshold: float = THRESHOLD, strict: bool = True) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score > threshold if strict else score >= threshold, 1).otherwise(0)


def gains_at(curve: DataFrame, cutoffs: Sequence[int], by: Sequence[str] = (), group_rows: str = "group_rows") -> DataFrame:
    """Read the cumulative gain off a curve at every cutoff. A cutoff past the end takes all rows."""
    reached = F.filter(
        F.array(*[F.lit(k).cast("long") for k in cutoffs]),
        lambda k: F.least(k, F.col(group_rows)) == F.col("position"),
    )
    return curve.select(*by, F.explode(reached).alias("cutoff"), F.col("gan_acum").alias("gain"))


def sweep_top_k(
    df: DataFrame,
    cutoffs: Sequence[int],
    score: str = "prob",
    value: Column | None = None,
    *,
    by: Sequence[str] = (),
    key: Sequence[str] = ("cust",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Gain of the k best rows for every cutoff k, from one ranking."""
    options = {"by": by, "key": key, "group_rows": "group_rows", "rows_per_task": rows_per_task}
    return gains_at(cumulative_gain(df, score, value, **options), cutoffs, by)


def nearest_row(df: DataFrame, value: str, target: Column, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The row whose value is nearest to a target; the first in ``order`` when several are."""
    nearest = F.min(F.struct(F.abs(F.col(value) - target).alias("distance"), *order, F.col(value).alias("_v")))
    return df.groupBy(*by).agg(nearest.alias("_r")).select(
        *by, "_r.distance", *[f"_r.{c}" for c in order], F.col("_r._v").alias(value)
    )


def normalised_gain(
    df: DataFrame, selected: Column, share: float, value: Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Gain of the selected rows of a sample, scaled to the whole population."""
    value = gain() if value is None else value
    return df.groupBy(*by).agg(
        (F.coalesce(F.sum(F.when(selected, value)), F.lit(0)) / F.lit(float(share))).alias("gain"),
        F.count_if(selected).alias("contacts"),
        F.count_if(selected & (value > 0)).alias("hits"),
    )


def leaderboard(
    truth: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str],
    *,
    fold: str = "fold",
    predicted: str = "Predicted",
    label: str = "label",
    shares: Mapping[int, tuple[str, float]] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Public, private and total gain of predictions against a truth that is split in folds.

    Predictions update the truth by key; a customer without prediction is not contacted. With ``by`` such a customer
    belongs to no group, so it is left out: it would add nothing but a group of its own.
    """
    shares = shares or {1: ("public", 0.3), 2: ("private", 0.7)}
    updated = truth.join(predictions.select(*keys, *by, predicted), list(keys), "inner" if by else "left")
    counts = updated.groupBy(*by, fold, predicted, label).agg(F.count(F.lit(1)).alias("qty"))
    contacted = F.when(F.col(predicted) == 1, F.col("qty") * gain(label))
    measures = [
        (F.coalesce(F.sum(F.when(F.col(fold) == f, contacted)), F.lit(0)) / F.lit(share)).alias(name)
        for f, (name, share) in shares.items()
    ]
    return counts.groupBy(*by).agg(*measures, F.coalesce(F.sum(contacted), F.lit(0)).alias("total"))


def repeated_leaderboard(
    scores: DataFrame,
    keys: Sequence[str],
    selected: Column,
    *,
    by: Sequence[str] = ("label",),
    repeats: int = 50,
    share: float = 0.3,
    value: Column | None = None,
    model: str = "model",
    seed: int = 0,
    **options,
) -> DataFrame:
    """Public and private gain of every model over many stratified splits: (repeat, model, public, private).

    The models of a row are put in one array and the rows get a bit for each repeat. The gains are summed bit by bit in one
    aggregate, so rows are neither copied for the repeats nor joined with them.
    """
    value = gain() if value is None else value
    rows = scores.groupBy(*keys, *by).agg(
        F.collect_list(F.struct(F.col(model).alias("model"), F.when(selected, value).alias("gain"))).alias("_models")
    )
    rows = cut_lineage(rows)
    marked = repeated_bits(rows, repeats, share, by, keys, seed, "_bits", **options)
    chosen = marked.select("_bits", F.inline("_models")).where("gain IS NOT NULL")
    public = [F.sum(F.when(in_split("_bits", r), F.col("gain"))).alias(f"_r{r}") for r in range(1, repeats + 1)]
    sums = chosen.groupBy("model").agg(F.sum("gain").alias("_all"), *public)
    # Models without a contact have no row there.
    sums = rows.select(F.inline("_models")).select("model").distinct().join(sums, "model", "left")
    per_repeat = F.inline(F.array(*[F.struct(F.lit(r).alias("repeat"), F.coalesce(f"_r{r}", F.lit(0)).alias("_pub")) for r in range(1, repeats + 1)]))
    return sums.select("model", F.coalesce("_all", F.lit(0)).alias("_all"), per_repeat).select(
        "repeat",
        "model",
        (F.col("_pub") / F.lit(share)).alias("public"),
        ((F.col("_all") - F.col("_pub")) / F.lit(1 - share)).alias("private"),
    )


def best_model(board: DataFrame, side: str, name: str) -> DataFrame:
    """Model with the largest gain per repeat; the first by name when equal."""
    best = F.min(F.struct((-F.col(side)).alias("loss"), F.col("model").alias("model")))
    return board.groupBy("repeat").agg(best.alias("_b")).select("repeat", F.col("_b.model").alias(name))


def public_private_table(board: DataFrame, models: Sequence[str]) -> DataFrame:
    """How often each best public model meets each best private model."""
    pairs = best_model(board, "public", "best_public").join(best_model(board, "private", "best_private"), "repeat")
    return pairs.groupBy("best_public").agg(*[F.count_if(F.col("best_private") == m).alias(m) for m in models])


def apo_experiment(
    df: DataFrame,
    cutoffs: Sequence[int],
    *,
    model: str = "meta_modelo",
    score: str = "prob",
    value: Column | None = None,
    key: Sequence[str] = ("cust",),
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Average gain at each cutoff over meta models, the best cutoff, and the row nearest to its average.

    Returns (mean gain per cutoff, best cutoff, nearest row): the nearest row names the meta model and the number of
    contacts whose cumulative gain is closest to the average of the best cutoff.
    """
    curve = cumulative_gain(
        df, score, value, by=[model], key=key, group_rows="group_rows", rows_per_task=rows_per_task
    )
    means = gains_at(curve, cutoffs, [model]).groupBy("cutoff").agg(F.avg("gain").alias("mean_gain"))
    best = means.agg(F.min(F.struct((-F.col("mean_gain")).alias("loss"), F.col("cutoff").alias("cutoff"))).alias("b"))
    best = best.select(F.col("b.cutoff").alias("cutoff"), (-F.col("b.loss")).alias("mean_gain"))
    target = best.select("mean_gain").scalar()
    return means, best, nearest_row(curve, "gan_acum", target, [model, "position"])


def auc(
    df: DataFrame,
    positive: Column,
    score: str = "prob",
    *,
    by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Area under the ROC curve from average ranks; equal scores count half.

    Rows with the same score are counted together before they are ranked.
    """
    counts = df.where(positive.isNotNull() & F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    placed = ranked(
        counts, by, [score], running={"_below": F.col("_neg")}, position="_p", rows_per_task=rows_per_task
    )
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_below") - F.col("_neg") / 2.0))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return placed.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def fold_curves(
    df: DataFrame, score: str, *, fold: str = "fold", folds: int = 2, label: str = "label", key: Sequence[str] = ("cust",),
    by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Cumulative gain and position per fold (of each group ``by``), scaled up by the number of equal folds."""
    return cumulative_gain(df, score, gain(label) * folds, by=[*by, fold], key=key, rows_per_task=rows_per_task)

