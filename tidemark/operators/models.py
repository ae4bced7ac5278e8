"""Models on Spark ML: imputation, trees, forests, boosting, ensembles, embeddings, segments.

Trees and forests are regressions on the 0/1 target, whose leaves hold the rate of class 1. Their splits are those by Gini
impurity, as the variance of a 0/1 value is half of it. Spark's classifiers do not serve here: they put leaves together
that predict the same class, and where the class is rarer than a half everywhere, that is the whole tree.

Spark's trees take no missing values, so columns are imputed first. They grow by level: give ``maxDepth`` where another
library takes a number of leaves, ``minInstancesPerNode`` for the rows per leaf, ``featureSubsetStrategy`` for the
share of columns, ``maxBins`` for the bins of a column, ``stepSize`` for the learning rate.

A fit is distributed; the loops here only start fits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import row_mean
from tidemark.operators import together
from tidemark.operators.fits import THREADS, concurrently, study
from tidemark.operators.ordering import ranked
from tidemark.operators.packed import PackedTrees, mean_packed, pack, read_packed, score_packed, score_rows, staged_scores
from tidemark.operators.profit import (
    THRESHOLD,
    cumulative_gain,
    gain,
    gain_summary,
    label_by_threshold,
    normalised_gain,
)
from tidemark.operators.sampling import contrast_set, in_split, repeated_bits
from tidemark.operators.sizes import ROWS_PER_TASK, small_side
from tidemark.session import cut_lineage, shared_folder
from tidemark.sources.tables import path_exists

FEATURES, PROBABILITY = "features", "probability"

# What stands for a missing start of arrears before a forest is trained.
ARREARS_SENTINEL = {"Master_Finiciomora": -999, "Visa_Finiciomora": -999}


# --- preparation ---------------------------------------------------------------------------------------------------


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): how often each known value occurs, of all columns in one table; NaN is no value.

    Equal values are counted where they are read, so the shuffle holds the distinct values of each task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    known = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def fill_values(df: DataFrame, columns: Sequence[str], strategy: str = "median", rows_per_task: int = ROWS_PER_TASK) -> dict[str, float]:
    """What replaces a missing value of each column: mean, median or mode of the known ones, 0 when none is known.

    All are exact. The median of an even number of values is the mean of the two in the middle; of several most frequent
    values the smallest is the mode.
    """
    columns = list(dict.fromkeys(columns))
    counts = value_counts(df, columns)
    if strategy == "mean":
        found = counts.groupBy("column").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value"))
    elif strategy == "mode":
        best = F.min(F.struct((-F.col("n")).alias("rare"), "value"))
        found = counts.groupBy("column").agg(best.alias("b")).select("column", F.col("b.value").alias("value"))
    elif strategy == "median":
        counts = cut_lineage(counts)
        totals = small_side(counts.groupBy("column").agg(F.sum("n").alias("_total")))  # a row for each column
        upto = ranked(counts, ["column"], ["value"], running={"_upto": F.col("n")}, rows_per_task=rows_per_task).join(totals, "column")
        reached = [(F.col("_upto") >= k) & (F.col("_upto") - F.col("n") < k) for k in (F.ceil(F.col("_total") / 2), F.floor(F.col("_total") / 2) + 1)]
        middles = [F.max(F.when(hit, F.col("value"))) for hit in reached]
        found = upto.groupBy("column").agg(((middles[0] + middles[1]) / 2).alias("value"))
    else:
        raise ValueError(f"no strategy {strategy}")
    return {**dict.fromkeys(columns, 0.0), **{r["column"]: r["value"] for r in found.collect()}}


def impute(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    *,
    values: Mapping[str, float] | None = None,
    sentinels: Mapping[str, float] | None = None,
) -> DataFrame:
    """Fill missing values; ``sentinels`` first, for the columns where missing is a value of its own.

    Pass the ``values`` found on the training rows to fill other rows the same way.
    """
    sentinels = {c: float(v) for c, v in (sentinels or {}).items() if c in df.columns}
    doubles = df.withColumns({c: F.col(c).cast("double") for c in {*columns, *sentinels}})
    filled = doubles.fillna(sentinels) if sentinels else doubles
    rest = [c for c in columns if c not in sentinels]
    if not rest:
        return filled
    values = fill_values(filled, rest, strategy) if values is None else values
    return filled.fillna({c: values[c] for c in rest})


def assemble(df: DataFrame, columns: Sequence[str], name: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


# --- single models -------------------------------------------------------------------------------------------------


def train_tree(df: DataFrame, columns: Sequence[str], label: str = "target", *, features: str = FEATURES, **params) -> Model:
    """A tree whose prediction is the rate of class 1 in the leaf."""
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, **params).fit(assemble(df, columns, features))


def train_forest(df: DataFrame, columns: Sequence[str], label: str = "target", **params) -> Model:
    """A forest whose prediction is the mean rate of class 1 in the leaves; each node sees the root of the columns' number."""
    params = {"numTrees": 100, "featureSubsetStrategy": "sqrt", **params}
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, **params).fit(assemble(df, columns))


def train_gbt(df: DataFrame, columns: Sequence[str], label: str = "target", **params) -> Model:
    """Boosted trees. ``weightCol`` weighs rows; ``validationIndicatorCol`` marks the rows that stop early."""
    params = {"maxBins": 31, "maxIter": 50, "stepSize": 0.1, **params}
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, **params).fit(assemble(df, columns))


def rescale_min_rows(min_rows: int, tuned_rows: int, final_rows: int) -> int:
    """Rows per leaf for the final training, in proportion to its larger number of rows."""
    return max(1, round(min_rows * final_rows / tuned_rows))


def positive_probability(scored: DataFrame, probability: str = PROBABILITY, prediction: str = "prediction") -> Column:
    """The probability of class 1 in a scored table: of a classifier, or else what a regression predicts."""
    return vector_to_array(F.col(probability))[1] if probability in scored.columns else F.col(prediction)


def score(model: Model, df: DataFrame, columns: Sequence[str], keep: Sequence[str], name: str = "prob") -> DataFrame:
    features = model.getFeaturesCol()
    scored = model.transform(assemble(df, columns, features))
    return scored.select(*keep, positive_probability(scored).alias(name))


# --- several models ------------------------------------------------------------------------------------------------


def score_models(
    models: Mapping[int, Model], df: DataFrame, columns: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Score rows with all models in one scan: (keep, model, prob)."""
    scored = assemble(df, columns)
    for number, model in models.items():
        outputs = {"predictionCol": f"_y{number}", "probabilityCol": f"_p{number}", "rawPredictionCol": f"_r{number}"}
        scored = model.copy({model.getParam(p): v for p, v in outputs.items() if model.hasParam(p)}).transform(scored)
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("model"), positive_probability(scored, f"_p{n}", f"_y{n}").alias("prob"))
            for n in models
        ]
    )
    return scored.select(*keep, F.inline(entries))


def mean_ensemble(scores: DataFrame, keys: Sequence[str], score: str = "prob") -> DataFrame:
    """Average score per key over the models of a long score table."""
    return scores.groupBy(*keys).agg(F.avg(score).alias(score))


def mean_of_columns(scores: DataFrame, names: Sequence[str], name: str = "ensemble") -> DataFrame:
    """Average over score columns that already stand side by side; nothing is shuffled."""
    return scores.withColumn(name, row_mean(names))


def seed_ensemble(
    fit: Callable[[int], Model], seeds: Sequence[int], folder: str | None = None, load=None, threads: int = THREADS
) -> dict[int, Model]:
    """The same fit for every seed, some at a time. With a folder each model is stored, and a stored one is loaded instead."""

    def one(seed: int) -> Model:
        path = f"{folder.rstrip('/')}/seed_{seed}" if folder else None
        if path and load is not None and _stored(path):
            return load(path)
        model = fit(seed)
        if path:
            model.write().overwrite().save(path)
        return model

    return dict(zip(seeds, concurrently([lambda s=s: one(s) for s in seeds], threads)))


def _stored(path: str) -> bool:
    from pyspark.sql import SparkSession

    return path_exists(SparkSession.active(), f"{path}/metadata/_SUCCESS")


def load_forest(path: str) -> Model:
    return RandomForestRegressionModel.load(path)


def load_gbt(path: str) -> Model:
    return GBTClassificationModel.load(path)


def score_saved(paths: Mapping[int, str], df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Average score of the stored trees or forests of a study, in one pass over the rows; the models are read as arrays."""
    return mean_packed(read_packed(df.sparkSession, paths, columns), df, keep)


def subspace_trees(
    train: DataFrame,
    columns: Sequence[str],
    trees: int,
    *,
    label: str = "target",
    fraction: float = 0.5,
    seed: int = 0,
    threads: int = THREADS,
    **params,
) -> dict[int, tuple[list[str], Model]]:
    """Trees that each see a random share of the columns.

    Trees that drew the same columns are the same tree and are fitted once. All are grown together, see
    ``operators.together``; with other parameters than it knows, Spark's trees are fitted some at a time. ``train`` should be
    a stored table.
    """
    import random

    size = max(1, int(len(columns) * fraction))
    chosen = {i: random.Random(seed * 100_003 + i).sample(list(columns), size) for i in range(1, trees + 1)}
    distinct = {tuple(sorted(names, key=columns.index)) for names in chosen.values()}
    order = sorted(distinct)
    if set(params) <= set(together.DEFAULTS):
        fitted = together.grow(train, list(columns), order, label, **params)
    else:
        fitted = concurrently([lambda names=names: train_tree(train, names, label, **params) for names in order], threads, train.sparkSession)
    by_names = dict(zip(order, fitted))
    out = {}
    for i, names in chosen.items():
        own = sorted(names, key=columns.index)
        out[i] = (own, by_names[tuple(own)])
    return out


def pack_subspace(
    trees: Mapping[int, tuple[Sequence[str], Model]], columns: Sequence[str], spark, folder: str | None = None, threads: int = THREADS
) -> PackedTrees:
    """All trees as arrays over ``columns``; a tree that occurs several times is saved once."""
    first: dict[str, int] = {}
    for i, (_, model) in trees.items():
        first.setdefault(model.uid, i)
    kept = {i: trees[i] for i in first.values()}
    if all(isinstance(m, together.GrownTree) for _, m in kept.values()):
        packed = together.joined({i: m.tree for i, (_, m) in sorted(kept.items())}, columns)
    else:
        packed = pack(spark, {i: m for i, (_, m) in kept.items()}, columns, own_columns={i: n for i, (n, _) in kept.items()}, folder=folder, threads=threads)
    root = dict(zip(packed.models.tolist(), packed.roots.tolist()))
    order = sorted(trees, key=lambda i: root[first[trees[i][1].uid]])
    roots = np.array([root[first[trees[i][1].uid]] for i in order])
    return replace(packed, roots=roots, weights=np.ones(len(order)), models=np.array(order))


def subspace_scores(
    trees: Mapping[int, tuple[Sequence[str], Model]], df: DataFrame, keep: Sequence[str]
) -> DataFrame:
    """(keep, model, prob) with one row per tree, from one pass over the rows."""
    columns = list(dict.fromkeys(c for names, _ in trees.values() for c in names))
    return score_packed(pack_subspace(trees, columns, df.sparkSession), df, keep)


def bagging_report(
    scores: DataFrame, keys: Sequence[str], sizes: Sequence[int], label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """Gain of the first 1, 2, 4, … trees: contacted when their summed probability is above trees times threshold.

    The sums of all sizes are taken side by side, so the long table is read and grouped once.
    """
    first = [F.sum(F.when(F.col("model") <= s, F.col("prob"))).alias(f"_s{s}") for s in sizes]
    summed = scores.groupBy(*keys, label).agg(*first)
    chosen = [F.col(f"_s{s}") > F.lit(s * threshold) for s in sizes]
    totals = summed.agg(
        *[F.coalesce(F.sum(F.when(c, gain(label))), F.lit(0)).alias(f"_g{s}") for s, c in zip(sizes, chosen)],
        *[F.count_if(c).alias(f"_c{s}") for s, c in zip(sizes, chosen)],
    )
    entries = [F.struct(F.lit(s).alias("trees"), F.col(f"_g{s}").alias("gain"), F.col(f"_c{s}").alias("contacts")) for s in sizes]
    return totals.select(F.inline(F.array(*entries)))


# --- validation ----------------------------------------------------------------------------------------------------


class GainEvaluator(Evaluator):
    """Largest cumulative gain of a scored set, for tuning; or the gain above a threshold, scaled by a share."""

    def __init__(
        self,
        hit: str = "hit",
        keys: Sequence[str] = ("cust", "period"),
        threshold: float | None = None,
        share: float = 1.0,
    ):
        super().__init__()
        self.hit, self.keys, self.threshold, self.share = hit, list(keys), threshold, share

    def _evaluate(self, dataset: DataFrame) -> float:
        value = gain(F.col(self.hit), 1)
        # The model scores its rows here, once: ranking reads them several times.
        scored = cut_lineage(dataset.select(*self.keys, self.hit, positive_probability(dataset).alias("_prob")))
        if self.threshold is None:
            best = gain_summary(cumulative_gain(scored, "_prob", value, key=self.keys), "_prob").first()["max_gain"]
            return float(best) / self.share
        chosen = label_by_threshold("_prob", self.threshold) == 1
        return normalised_gain(scored, chosen, self.share, value).first()["gain"]

    def isLargerBetter(self) -> bool:
        return True


def cross_validate(df: DataFrame, columns: Sequence[str], estimator, grid, evaluator, *, fold: str, folds: int, threads: int = THREADS):
    """Spark's cross validator over a fold column 1..folds. Gives (fitted model, average metric per grid point)."""
    numbered = assemble(df, columns).withColumn("_fold", (F.col(fold) - 1).cast("int"))
    found = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="_fold", parallelism=threads
    ).fit(numbered)
    return found.bestModel, list(found.avgMetrics)


def split_bits(
    df: DataFrame, repeats: int, *, by: Sequence[str] = ("label",), keys: Sequence[str] = ("cust", "period"), test_share: float = 0.3,
    seed: int = 0, **options,
) -> DataFrame:
    """``df`` stored with the test sides of ``repeats`` stratified splits as bits ``_test``; all fits of a study read it."""
    return cut_lineage(repeated_bits(df, repeats, test_share, by, keys, seed, "_test", **options))


def split_gains(
    marked: DataFrame,
    repeats: Sequence[int],
    fit: Callable[[DataFrame], Model],
    columns: Sequence[str],
    *,
    label: str = "label",
    test_share: float = 0.3,
    threshold: float = THRESHOLD,
    threads: int = THREADS,
) -> DataFrame:
    """Normalised test gain of one model on each of the splits of ``split_bits``: (seed, gain), seed being the split.

    The fits run some at a time. Their trees are then packed, and one pass over the rows scores every row with the models
    that did not see it and sums the gains of all splits.
    """
    spark = marked.sparkSession
    repeats = list(repeats)
    fitted = concurrently([lambda r=r: fit(marked.where(~in_split("_test", r))) for r in repeats], threads, spark)
    models = dict(zip(repeats, fitted))
    if any(isinstance(m, GBTClassificationModel) for m in fitted):
        scored = cut_lineage(score_models(models, marked, columns, [label, "_test"]))
        sums = [F.sum(F.when((F.col("model") == r) & in_split("_test", r) & (F.col("prob") > threshold), gain(label))) for r in repeats]
    else:
        scored = score_rows(pack(spark, models, columns, threads=threads), marked, [label, "_test"])
        sums = [F.sum(F.when(in_split("_test", r) & (F.get("probs", F.lit(i)) > threshold), gain(label))) for i, r in enumerate(repeats)]
    row = scored.agg(*[F.coalesce(s, F.lit(0)).alias(f"g{r}") for r, s in zip(repeats, sums)])
    entries = [F.struct(F.lit(int(r)).cast("long").alias("seed"), (F.col(f"g{r}") / F.lit(float(test_share))).alias("gain")) for r in repeats]
    return row.select(F.inline(F.array(*entries)))


def monte_carlo(
    df: DataFrame,
    repeats: int,
    fit: Callable[[DataFrame], Model],
    columns: Sequence[str],
    *,
    label: str = "label",
    test_share: float = 0.3,
    threshold: float = THRESHOLD,
    threads: int = THREADS,
    **options,
) -> DataFrame:
    """Normalised test gain of one model on ``repeats`` stratified splits: (seed, gain); options as in ``split_bits``."""
    marked = split_bits(df, repeats, test_share=test_share, **options)
    found = split_gains(marked, range(1, repeats + 1), fit, columns, label=label, test_share=test_share, threshold=threshold, threads=threads)
    return cut_lineage(found)


def grid_search(
    grid: DataFrame, parameters: Sequence[str], run: Callable[[dict], DataFrame], path: str, threads: int = THREADS
) -> DataFrame:
    """Run every parameter tuple that the detail table at ``path`` lacks, some at a time, and store its rows when it is done.

    ``run`` gives (seed, gain) rows for a tuple. A search that was stopped goes on where it was, and a tuple that is run
    again replaces its rows. Gives the parameters with the rows of all tuples that are stored.
    """
    points = [row.asDict() for row in grid.select(*parameters).distinct().orderBy(*parameters).collect()]
    named = {c: grid.schema[c].dataType for c in parameters}

    def rows(point: Mapping[str, object]) -> DataFrame:
        return run(dict(point)).select(*[F.lit(point[p]).cast(named[p]).alias(p) for p in parameters], "*")

    return study(grid.sparkSession, points, rows, path, threads)


# --- boosting stopped by the gain ----------------------------------------------------------------------------------


def stage_gains(staged: DataFrame, value: Column, stages: str = "stages", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(trees, max_gain, threshold, contacts): the best cut by score after each number of trees.

    Of rows with the probabilities after 1, 2, … trees. Rows with the same score are contacted together, so a row's place
    among equals does not matter and the gains are first summed for each score. Among equal gains the higher score counts.
    """
    long = staged.select(value.alias("_gain"), F.posexplode(stages).alias("_stage", "prob"))
    sums = long.groupBy((F.col("_stage") + 1).alias("trees"), "prob").agg(F.sum("_gain").alias("_gain"), F.count(F.lit(1)).alias("_n"))
    curve = ranked(cut_lineage(sums), ["trees"], ["-prob"], running={"_upto": F.col("_gain"), "_contacts": F.col("_n")}, rows_per_task=rows_per_task)
    best = F.min(F.struct((-F.col("_upto")).alias("loss"), (-F.col("prob")).alias("below"), F.col("_contacts").alias("contacts"))).alias("b")
    return curve.groupBy("trees").agg(best).select(
        "trees", (-F.col("b.loss")).alias("max_gain"), (-F.col("b.below")).alias("threshold"), F.col("b.contacts").alias("contacts")
    )


def best_stage(gains: Sequence[tuple[int, float]], patience: int | None = None) -> int:
    """The number of trees with the largest gain, the fewest among equals.

    With ``patience`` the search ends as soon as so many stages in a row brought nothing better.
    """
    best, found = 0, None
    for trees, value in sorted(gains):
        if found is None or value > found:
            best, found = trees, value
        elif patience is not None and trees - best >= patience:
            break
    return best


def stop_by_gain(
    model: GBTClassificationModel, valid: DataFrame, columns: Sequence[str], value: Column, patience: int | None = None
) -> tuple[PackedTrees, DataFrame]:
    """(the boosted model cut to its best number of trees, gains by number of trees) by the gain on validation rows.

    Boosting adds trees one by one, so its first trees are what a shorter training gives: the rows are scored once, with
    the running sums of the trees, and no model is trained again.
    """
    spark = valid.sparkSession
    packed = pack(spark, {0: model}, columns)
    staged = staged_scores(packed, valid.withColumn("_value", value), ["_value"])
    gains = cut_lineage(stage_gains(staged, F.col("_value")))
    pairs = [(r["trees"], r["max_gain"]) for r in gains.select("trees", "max_gain").collect()]  # a row for each tree
    return packed.first(best_stage(pairs, patience)), gains


# --- what a model uses ---------------------------------------------------------------------------------------------


def importance_table(model: Model, columns: Sequence[str], spark, name: str = "model") -> DataFrame:
    """(model, feature, importance) of the features that are used."""
    weights = model.featureImportances.toArray()
    rows = [(name, c, float(w)) for c, w in zip(columns, weights) if w > 0]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def above_canaries(importances: DataFrame, prefix: str = "canarito_", rank: int = 1) -> DataFrame:
    """Features that are more important than the canary of the given rank."""
    is_canary = F.col("feature").startswith(prefix)
    limit = (
        importances.where(is_canary)
        .agg(F.get(F.sort_array(F.collect_list("importance"), asc=False), F.lit(rank - 1)).alias("limit"))
        .scalar()
    )
    return importances.where(~is_canary & (F.col("importance") > F.coalesce(limit, F.lit(0.0))))


def split_table(model: Model, path: str | None = None) -> DataFrame:
    """Every inner node of a stored tree model: (tree, node, feature, threshold, gain, rows)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    if path is None:
        path = f"{shared_folder(spark)}/model-{model.uid}"
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
    node = F.col("nodeData") if "nodeData" in data.columns else F.struct(*data.columns)
    return data.select(tree.alias("tree"), node.alias("n")).select(
        "tree",
        F.col("n.id").alias("node"),
        F.col("n.split.featureIndex").alias("feature"),
        F.get(F.col("n.split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.col("n.gain").alias("gain"),
        F.col("n.rawCount").alias("rows"),
        (F.col("n.leftChild") < 0).alias("is_leaf"),
    )


def splits_on(table: DataFrame, feature: int) -> DataFrame:
    return table.where(~F.col("is_leaf") & (F.col("feature") == feature)).orderBy("threshold", "tree", "node")


def leaves_per_tree(table: DataFrame) -> DataFrame:
    return table.groupBy("tree").agg(F.count_if("is_leaf").alias("leaves"))


# --- leaves as features --------------------------------------------------------------------------------------------


def with_leaves(model: RandomForestRegressionModel, df: DataFrame, columns: Sequence[str], name: str = "leaves") -> DataFrame:
    """Rows with the leaf each tree puts them in, as an array."""
    found = model.copy({model.getParam("leafCol"): "_leaf"}).transform(assemble(df, columns))
    return found.select(*df.columns, vector_to_array("_leaf").cast("array<int>").alias(name))


def leaf_embedding(
    leaves: DataFrame, trees: int, fit_on: DataFrame | None = None, name: str = "leaf_vector"
) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per tree and leaf, kept as one sparse vector; also the names ``rf_<tree>_<leaf>``.

    Leaves are learned from ``fit_on`` (the training rows), so all periods get the same columns.
    """
    ids = [f"_t{i}" for i in range(trees)]

    def spread(df: DataFrame) -> DataFrame:
        return df.select("*", *[F.get("leaves", F.lit(i)).alias(c) for i, c in enumerate(ids)])

    hot = [f"_h{i}" for i in range(trees)]
    encoder = OneHotEncoder(inputCols=ids, outputCols=hot, dropLast=False, handleInvalid="keep")
    fitted = encoder.fit(spread(leaves if fit_on is None else fit_on))
    names = [f"rf_{t + 1:03d}_{leaf:03d}" for t, size in enumerate(fitted.categorySizes) for leaf in range(size + 1)]
    encoded = fitted.transform(spread(leaves))
    vector = VectorAssembler(inputCols=hot, outputCol=name).transform(encoded)
    return vector.drop(*ids, *hot), names


def leaf_table(leaves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, tree, leaf), the long form of the leaf arrays."""
    return leaves.select(*keys, F.posexplode("leaves").alias("tree", "leaf"))


def group_proximity(leaves: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    """Mean forest proximity of every row to every group: the share of (tree, member) pairs in the same leaf.

    The table of all row pairs grows with the square of the rows. Here the members of a group are first counted per
    (tree, leaf), so the work grows with rows times groups, and the result is the exact mean over all pairs.
    """
    long = leaves.select(*keys, F.size("leaves").alias("_trees"), F.posexplode("leaves").alias("tree", "leaf"))
    members = leaves.groupBy(group).agg(F.count(F.lit(1)).alias("_members"))
    counts = leaves.select(group, F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf", group).agg(
        F.count(F.lit(1)).alias("_n")
    )
    per_leaf = (
        counts.join(small_side(members), group)
        .groupBy("tree", "leaf")
        .agg(F.collect_list(F.struct(F.col(group), (F.col("_n") / F.col("_members")).alias("share"))).alias("_shares"))
    )
    met = long.join(small_side(per_leaf), ["tree", "leaf"]).select(*keys, "_trees", F.inline("_shares"))
    return met.groupBy(*keys, group).agg((F.sum("share") / F.max("_trees")).alias("proximity"))


def unsupervised_forest(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int = 0, **params
) -> RandomForestRegressionModel:
    """A forest that tells real rows from rows with shuffled columns; its leaves give a proximity without labels."""
    return train_forest(cut_lineage(contrast_set(df, columns, keys, seed)), columns, "real", seed=seed, **params)


def segment(df: DataFrame, vector: str, k: int = 15, seed: int = 17, name: str = "cluster") -> DataFrame:
    """k-means. On leaf vectors the squared distance is twice the number of trees that part two rows."""
    return KMeans(k=k, seed=seed, featuresCol=vector, predictionCol=name).fit(df).transform(df)


def profile_clusters(
    df: DataFrame, columns: Sequence[str], cluster: str = "cluster", n: int = 10, **params
) -> DataFrame:
    """What sets each cluster apart: importances of a forest of the cluster against the rest, (cluster, feature, rank).

    Rows are weighted so that both sides count the same.
    """
    spark = df.sparkSession
    sizes = {r[cluster]: r["n"] for r in df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, tables = sum(sizes.values()), []
    for value, size in sorted(sizes.items()):
        if size == total:
            continue
        inside = F.col(cluster) == value
        weight = F.when(inside, total / (2.0 * size)).otherwise(total / (2.0 * (total - size)))
        one_vs_rest = df.withColumns({"_inside": inside.cast("int"), "_weight": weight})
        model = train_forest(one_vs_rest, columns, "_inside", weightCol="_weight", **params)
        tables.append(importance_table(model, columns, spark).select(F.lit(value).alias(cluster), "feature", "importance"))
    # One row per cluster and feature.
    order = Window.partitionBy(cluster).orderBy(F.col("importance").desc(), "feature")
    every = reduce(lambda a, b: a.unionByName(b), tables)
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

