"""Models on the daily panel: trained on the early days, scored on later ones. Rows only, no oracle."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tidemark.operators import labels, models, profit, quality, sampling, windows
from tidemark.plans import panels as p
from tidemark.plans.registry import fresh_folder, query, r, rounded
from tidemark.session import cut_lineage

KEYS = ["cust", "period"]
INPUTS = ["n_events", "m_total", "m_max", "m_net", *p.COUNTS, "tenure", "m_total_lag1", "m_total_delta1"]
TRAIN_DAYS, VALID_DAYS, TEST_DAYS = "period < 16", "period between 16 and 19", "period >= 20"


def training_table(spark, folder):
    """Labelled rows with lags, without missing values, stored so that every fit reads the same rows."""
    panel = windows.add_deltas(windows.add_lags(p.labelled(spark, folder), ["m_total"], (1,)), ["m_total"], (1,))
    known = labels.binarize_label(panel.where(F.col("label").isNotNull()))
    filled = models.impute(known, INPUTS, "median", sentinels={"m_total_lag1": -999})
    kept = filled.select(*KEYS, "label", *INPUTS, F.col("target").cast("double").alias("target"), "target_test")
    return cut_lineage(kept)


def _sides(table):
    """All days before the tested ones are trained on; only boosting keeps some of them for validation."""
    return table.where(f"not ({TEST_DAYS})"), table.where(TEST_DAYS)


@query(p.LABELS + "SELECT period, count(*) AS n, count(*) FILTER (WHERE c_click IS NULL) AS filled, "
       "round(sum(coalesce(c_click, 0)), 2)::DOUBLE AS total FROM labelled GROUP BY period")
def imputed_columns(spark, folder):
    panel = p.labelled(spark, folder).withColumn("was", F.col("c_click"))
    filled = models.impute(panel, ["c_view"], "median", sentinels={"c_click": 0})
    return filled.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("was").isNull()).alias("filled"), r(F.sum("c_click"), 2).alias("total")
    )


FILLED = ["c_click", "c_view", "m_total", "m_max"]


def _fill_sql():
    value = "arg_min({c}, (-n, {c})) FROM (SELECT {c}, count(*) AS n FROM panel_day WHERE {c} IS NOT NULL GROUP BY {c})"
    modes = ", ".join(f"coalesce((SELECT {value.format(c=c)}), 0)::DOUBLE AS {c}" for c in FILLED)
    means, medians = (", ".join(f"round(coalesce({f}({c}), 0), 6)::DOUBLE AS {c}" for c in FILLED) for f in ("avg", "median"))
    return p.DAY + f"""SELECT 'mean' AS strategy, {means} FROM panel_day UNION ALL SELECT 'median', {medians} FROM panel_day
        UNION ALL SELECT 'mode', {modes}"""


@query(_fill_sql())
def imputation_values(spark, folder):
    panel = cut_lineage(p.panel_day(spark, folder).select(*FILLED))
    rows = []
    for strategy in ("mean", "median", "mode"):
        values = models.fill_values(panel, FILLED, strategy, rows_per_task=1000)
        rows.append((strategy, *[values[c] for c in FILLED]))
    return rounded(spark.createDataFrame(rows, "strategy string, " + ", ".join(f"{c} double" for c in FILLED)), FILLED)


def _curve(scored):
    curve = profit.cumulative_gain(scored, key=KEYS, group_rows="group_rows")
    return rounded(profit.gain_summary(curve), ["threshold"])


@query()
def tree_scores(spark, folder):
    train, test = _sides(training_table(spark, folder))
    model = models.train_tree(train, INPUTS, maxDepth=5, minInstancesPerNode=20, seed=17)
    return rounded(models.score(model, test, INPUTS, [*KEYS, "label"]), ["prob"])


@query()
def forest_gain(spark, folder):
    train, test = _sides(training_table(spark, folder))
    model = models.train_forest(train, INPUTS, numTrees=30, maxDepth=5, seed=17)
    return _curve(models.score(model, test, INPUTS, [*KEYS, "label"]))


@query()
def boosted_gain_with_early_stop(spark, folder):
    """Fifty weighted rounds, cut where the gain on the validation days is best.

    The rows per leaf were meant for the training days, so they grow with the days that are trained on.
    """
    table = training_table(spark, folder)
    weighted = table.withColumn("w", sampling.class_weight(F.col("label")))
    early, later = weighted.where(TRAIN_DAYS), weighted.where(VALID_DAYS)
    tuned = early.where("period < 12").count()
    model = models.train_gbt(
        early, INPUTS, maxIter=50, maxDepth=3, minInstancesPerNode=models.rescale_min_rows(20, max(1, tuned), early.count()), weightCol="w", seed=17
    )
    cut, _ = models.stop_by_gain(model, later, INPUTS, profit.gain())
    return _curve(cut_lineage(models.mean_packed(cut, table.where(TEST_DAYS), [*KEYS, "label"])))


# The numbers of trees that are reported.
REPORT = (1, 2, 4, 8, 16, 32, 64, 128, 256, 384, 512)


@query()
def subspace_bagging_report(spark, folder):
    train, test = _sides(training_table(spark, folder))
    trees = models.subspace_trees(train, INPUTS, 512, seed=17, maxDepth=4, minInstancesPerNode=10)
    return models.bagging_report(models.subspace_scores(trees, test, [*KEYS, "label"]), KEYS, REPORT)


SEEDS = tuple(range(31, 51))


@query()
def seed_ensemble_scores(spark, folder):
    """Models of twenty seeds, stored, loaded and averaged; then the best 100 are labelled."""
    train, test = _sides(training_table(spark, folder))
    path = fresh_folder(spark, "models")

    def fit(seed):
        return models.train_forest(train, INPUTS, numTrees=10, maxDepth=4, seed=seed)

    models.seed_ensemble(fit, SEEDS, path, models.load_forest)
    paths = {s: f"{path}/seed_{s}" for s in SEEDS}
    scored = models.score_saved(paths, test, INPUTS, KEYS)
    return rounded(profit.label_top_k(cut_lineage(scored), 100, key=KEYS), ["prob"])


@query()
def cross_validated_gain(spark, folder):
    train, _ = _sides(training_table(spark, folder))
    folded = sampling.stratified_fold(train, (1,) * 5, ["label"], KEYS, 17)
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="target", seed=17)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [2, 5]).build()
    evaluator = models.GainEvaluator("target_test", KEYS)
    _, gains = models.cross_validate(cut_lineage(folded), INPUTS, tree, grid, evaluator, fold="fold", folds=5)
    rows = [(int(point[tree.maxDepth]), float(g * 5)) for point, g in zip(grid, gains)]
    return spark.createDataFrame(rows, "max_depth int, gain double")


def _fit(depth, rows_to_split=20):
    def fit(rows):
        return models.train_tree(rows, INPUTS, maxDepth=depth, minInstancesPerNode=max(1, rows_to_split // 2), seed=17)

    return fit


@query()
def monte_carlo_gains(spark, folder):
    """Fifty splits."""
    return rounded(models.monte_carlo(training_table(spark, folder), 50, _fit(4), INPUTS), ["gain"], 2)


# The depths and the rows to split of the search.
DEPTHS, ROWS_TO_SPLIT = (4, 6, 8, 10, 12, 14), (1000, 800, 600, 400, 200, 100, 50, 20, 10)


@query()
def resumed_grid_search(spark, folder):
    """A search over 54 tuples that stops after some depths and goes on with the others; then its summary."""
    from tidemark.operators.trials import grid_summary

    marked, path = models.split_bits(training_table(spark, folder), 1), fresh_folder(spark, "grid")
    grid = spark.createDataFrame([(d, n) for d in DEPTHS for n in ROWS_TO_SPLIT], "max_depth int, rows_to_split int")
    names = ["max_depth", "rows_to_split"]

    def run(point):
        return models.split_gains(marked, [1], _fit(point["max_depth"], point["rows_to_split"]), INPUTS)

    models.grid_search(grid.where("max_depth < 8"), names, run, path)
    details = models.grid_search(grid, names, run, path)
    return rounded(grid_summary(details, names, "gain"), ["mean_gain"], 2)


@query()
def importances_above_canaries(spark, folder):
    train, _ = _sides(training_table(spark, folder))
    with_canaries = cut_lineage(sampling.add_canaries(train, 5, KEYS, 17))
    names = [f"canarito_{i}" for i in range(1, 6)] + INPUTS
    model = models.train_forest(with_canaries, names, numTrees=30, maxDepth=5, seed=17)
    return rounded(models.above_canaries(models.importance_table(model, names, spark), rank=5), ["importance"])


@query()
def splits_of_a_forest(spark, folder):
    train, _ = _sides(training_table(spark, folder))
    model = models.train_forest(train, INPUTS, numTrees=5, maxDepth=4, seed=17)
    table = models.split_table(model, fresh_folder(spark, "splits"))
    return rounded(models.splits_on(table, INPUTS.index("tenure")), ["threshold", "gain"])


@query()
def leaves_of_a_forest(spark, folder):
    train, _ = _sides(training_table(spark, folder))
    model = models.train_forest(train, INPUTS, numTrees=5, maxDepth=4, seed=17)
    return models.leaves_per_tree(models.split_table(model, fresh_folder(spark, "splits")))


def _leaves(spark, folder, trees=20):
    table = training_table(spark, folder)
    model = models.train_forest(table.where(TRAIN_DAYS), INPUTS, numTrees=trees, maxDepth=4, seed=17)
    return models.with_leaves(model, table, INPUTS)


@query()
def leaf_embedding_sizes(spark, folder):
    from pyspark.ml.functions import vector_to_array

    leaves = _leaves(spark, folder)
    vectors, names = models.leaf_embedding(leaves, 20, leaves.where(TRAIN_DAYS))
    ones = F.aggregate(vector_to_array("leaf_vector"), F.lit(0.0), lambda a, x: a + x)
    return vectors.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.min(ones).alias("low"), F.max(ones).alias("high"), F.lit(len(names)).alias("width")
    )


@query()
def proximity_to_classes(spark, folder):
    proximity = models.group_proximity(cut_lineage(_leaves(spark, folder)), KEYS, "label")
    return rounded(proximity, ["proximity"])


@query()
def segments_and_their_profile(spark, folder):
    """Clusters on leaf vectors of an unsupervised forest, and the features that set each apart."""
    table = training_table(spark, folder)
    columns = ["m_total", "m_net", "n_events", "tenure"]
    forest = models.unsupervised_forest(table, columns, KEYS, 17, numTrees=10, maxDepth=4)
    vectors, _ = models.leaf_embedding(models.with_leaves(forest, table, columns), 10)
    clustered = cut_lineage(models.segment(vectors, "leaf_vector", k=4).drop("leaf_vector", "leaves"))
    top = models.profile_clusters(clustered, columns, n=2, numTrees=10, maxDepth=4, seed=17)
    medians = quality.group_medians(clustered, columns, "cluster")
    return rounded(top.join(medians, ["cluster", "feature"]), ["importance", "median"])
