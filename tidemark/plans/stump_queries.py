"""Studies of trees with one split of one column: small enough that SQL can train them, so every result is checked.

The operators are those of ``model_queries``; only the columns and the depth differ. A split is the middle between two
values of the training rows; the one that lowers the variance most is taken, the lowest among equals.
"""

from __future__ import annotations

import random

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tidemark.functions.scalar import md5_draw
from tidemark.operators import labels, models, packed, profit, sampling
from tidemark.operators.neighbours import nearest_by_proximity
from tidemark.operators.trials import grid_summary
from tidemark.plans import panels as p
from tidemark.plans.model_queries import KEYS, TEST_DAYS, TRAIN_DAYS, VALID_DAYS
from tidemark.plans.profit_queries import GAIN, sql_draw
from tidemark.plans.registry import fresh_folder, query, r, rounded
from tidemark.session import cut_lineage

#: As many bins as there are days, so that every middle between two values is a possible split.
STUMP = {"maxDepth": 1, "maxBins": 256}
BEFORE_TEST = f"not ({TEST_DAYS})"

KNOWN = p.LABELS + """, known AS (
    SELECT cust, period, label, tenure::DOUBLE AS x, coalesce(c_view, 0)::DOUBLE AS z,
           CASE WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 ELSE 0 END AS y
    FROM labelled WHERE label IS NOT NULL
)
"""


def known_rows(spark, folder):
    known = labels.binarize_label(p.labelled(spark, folder).where(F.col("label").isNotNull()))
    views = F.coalesce("c_view", F.lit(0)).cast("double").alias("views")
    return cut_lineage(
        known.select(*KEYS, "label", F.col("tenure").cast("double").alias("tenure"), views, F.col("target").cast("double").alias("target"), "target_test")
    )


def stump_sql(source: str, name: str, x: str = "x", groups: str = "g", least: str = "1", gain: str = "0.0") -> str:
    """CTEs: ``name``(groups, thr, low, high), the best split of ``source``(groups, x, y) and the rates on both sides.

    ``thr`` is NULL and both rates are the whole rate where no split has ``least`` rows on both sides and enough gain.
    """
    variance = "(({p} - {p}::DOUBLE * {p} / {n}) / {n})"
    left, right, whole = (variance.format(n=n, p=q) for n, q in (("nl", "pl"), ("(nt - nl)", "(pt - pl)"), ("nt", "pt")))
    return f"""{name}_counts AS (SELECT {groups}, {x} AS x, count(*) AS n, sum(y) AS p FROM {source} GROUP BY ALL),
{name}_cuts AS (
    SELECT {groups}, x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(p) OVER w AS pl,
           sum(n) OVER (PARTITION BY {groups}) AS nt, sum(p) OVER (PARTITION BY {groups}) AS pt
    FROM {name}_counts WINDOW w AS (PARTITION BY {groups} ORDER BY x)
), {name}_gains AS (
    SELECT *, CASE WHEN nx IS NOT NULL AND nl >= {least} AND nt - nl >= {least}
        THEN {whole} - nl::DOUBLE / nt * {left} - (nt - nl)::DOUBLE / nt * {right} END AS gain FROM {name}_cuts
), {name} AS (
    SELECT {groups}, CASE WHEN good THEN (x + nx) / 2 END AS thr,
        CASE WHEN good THEN pl::DOUBLE / nl ELSE pt::DOUBLE / nt END AS low,
        CASE WHEN good THEN (pt - pl)::DOUBLE / (nt - nl) ELSE pt::DOUBLE / nt END AS high, nt
    FROM (SELECT *, coalesce(gain > 0 AND gain >= {gain}, false) AS good FROM {name}_gains)
    QUALIFY row_number() OVER (PARTITION BY {groups} ORDER BY good DESC, gain DESC NULLS LAST, x) = 1
)"""


PROB = "CASE WHEN k.x <= s.thr THEN s.low ELSE s.high END"
ONE = KNOWN + f", train AS (SELECT 1 AS g, x, y FROM known WHERE {BEFORE_TEST}), " + stump_sql("train", "stump")


@query(ONE + f" SELECT cust, period, label, round({PROB}, 9) AS prob FROM known k CROSS JOIN stump s WHERE {TEST_DAYS}")
def stump_scores(spark, folder):
    known = known_rows(spark, folder)
    model = models.train_tree(known.where(BEFORE_TEST), ["tenure"], **STUMP)
    return rounded(models.score(model, known.where(TEST_DAYS), ["tenure"], [*KEYS, "label"]), ["prob"], 9)


@query(
    ONE + f""", scored AS (SELECT cust, period, label, {PROB} AS prob FROM known k CROSS JOIN stump s WHERE {TEST_DAYS}),
    curve AS (
        SELECT *, sum({GAIN}) OVER (ORDER BY prob DESC, cust, period ROWS UNBOUNDED PRECEDING) AS upto,
               row_number() OVER (ORDER BY prob DESC, cust, period) AS position FROM scored
    )
    SELECT max(upto)::BIGINT AS max_gain, arg_min(position, (-upto, position))::INT AS contacts,
           round(arg_min(prob, (-upto, position)), 9) AS threshold, count(*) AS n_rows FROM curve"""
)
def stump_forest_gain(spark, folder):
    """A forest whose trees all see all rows and columns, so that all are the same tree."""
    known = known_rows(spark, folder)
    forest = models.train_forest(known.where(BEFORE_TEST), ["tenure"], numTrees=5, bootstrap=False, featureSubsetStrategy="all", **STUMP)
    scored = packed.mean_packed(packed.pack(spark, {1: forest}, ["tenure"]), known.where(TEST_DAYS), [*KEYS, "label"])
    curve = profit.cumulative_gain(cut_lineage(scored), key=KEYS, group_rows="group_rows")
    found = profit.gain_summary(curve)
    return rounded(found, ["threshold"], 9).withColumn("contacts", F.col("contacts").cast("int"))


# --- seeds, splits, grid --------------------------------------------------------------------------------------------

SPLITS, TEST_SHARE = 50, 0.3
#: Contacted above this rate; some fifth of the customers leave, so the split decides who is.
CHOSEN = 0.215


def splits_sql(repeats: int, seed: str, source: str = "known") -> str:
    return f"""splits AS MATERIALIZED (
    SELECT cust, period, label, x, y, g, n <= floor({TEST_SHARE}::DOUBLE * size) AS is_test FROM (
        SELECT *, row_number() OVER (PARTITION BY g, label ORDER BY draw, cust, period) AS n,
               count(*) OVER (PARTITION BY g, label) AS size
        FROM (SELECT k.*, g::INTEGER AS g, {sql_draw(seed, 'cust', 'period', 'g')} AS draw FROM {source} k CROSS JOIN range(1, {repeats + 1}) AS t(g))
    )
)"""


TESTED = f"coalesce(sum({GAIN}) FILTER (WHERE is_test AND {PROB} > {CHOSEN}::DOUBLE), 0) / {TEST_SHARE}::DOUBLE"


def _split_table(spark, folder, repeats, seed):
    return models.split_bits(known_rows(spark, folder), repeats, test_share=TEST_SHARE, seed=seed, draw=md5_draw)


@query(
    KNOWN + f", {splits_sql(SPLITS, '13')}, train AS (SELECT g, x, y FROM splits WHERE NOT is_test), {stump_sql('train', 'stump')}"
    f" SELECT g::BIGINT AS seed, round({TESTED}, 2) AS gain FROM splits k JOIN stump s USING (g) GROUP BY g"
)
def stump_monte_carlo(spark, folder):
    """Fifty splits, fitted side by side and scored in one pass."""

    def fit(rows):
        return models.train_tree(rows, ["tenure"], **STUMP)

    marked = _split_table(spark, folder, SPLITS, 13)
    return rounded(models.split_gains(marked, range(1, SPLITS + 1), fit, ["tenure"], test_share=TEST_SHARE, threshold=CHOSEN), ["gain"], 2)


# The least rows that the grid tries.
LEAST_ROWS = (10, 20, 50, 100, 200, 400, 600, 800, 1000)
LEAST_GAINS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.008)
GRID_SPLITS = 3


@query(
    KNOWN + f""", {splits_sql(GRID_SPLITS, '14')}, grid AS (
        SELECT least_rows, least_gain FROM unnest({list(LEAST_ROWS)}) a(least_rows), unnest({list(LEAST_GAINS)}::DOUBLE[]) b(least_gain)
    ), train AS (SELECT least_rows, least_gain, g, x, y FROM splits, grid WHERE NOT is_test),
    {stump_sql('train', 'stump', groups='least_rows, least_gain, g', least='least_rows', gain='least_gain')},
    runs AS (
        SELECT least_rows, least_gain, g, {TESTED} AS gain FROM splits k JOIN stump s USING (g) GROUP BY ALL
    )
    SELECT least_rows, least_gain, round(avg(gain), 2) AS mean_gain, count(*) AS runs FROM runs GROUP BY ALL"""
)
def stump_grid(spark, folder):
    """All 54 tuples of the grid; the search is stopped after a part of them and goes on."""
    marked, path = _split_table(spark, folder, GRID_SPLITS, 14), fresh_folder(spark, "grid")
    grid = spark.createDataFrame([(a, b) for a in LEAST_ROWS for b in LEAST_GAINS], "least_rows int, least_gain double")
    parameters = ["least_rows", "least_gain"]

    def run(point):
        def fit(rows):
            return models.train_tree(rows, ["tenure"], minInstancesPerNode=point["least_rows"], minInfoGain=point["least_gain"], **STUMP)

        return models.split_gains(marked, range(1, GRID_SPLITS + 1), fit, ["tenure"], test_share=TEST_SHARE, threshold=CHOSEN, threads=1)

    models.grid_search(grid.where("least_rows >= 600"), parameters, run, path)
    details = models.grid_search(grid, parameters, run, path)
    return rounded(grid_summary(details, parameters, "gain", n=len(LEAST_ROWS) * len(LEAST_GAINS)), ["mean_gain"], 2)


FOLDS, FOLD_ROWS = 5, (1, 300)


@query(
    KNOWN + f""", folded AS (
        SELECT cust, period, label, x, y, (1 + (row_number() OVER (PARTITION BY label ORDER BY draw, cust, period) - 1) % {FOLDS})::INT AS fold
        FROM (SELECT *, {sql_draw('19', 'cust', 'period')} AS draw FROM known WHERE {BEFORE_TEST})
    ), pairs AS (SELECT f.g, f.least_rows, k.* FROM folded k CROSS JOIN (SELECT g, least_rows FROM range(1, {FOLDS + 1}) t(g), unnest({list(FOLD_ROWS)}) u(least_rows)) f),
    train AS (SELECT least_rows, g, x, y FROM pairs WHERE fold <> g),
    {stump_sql('train', 'stump', groups='least_rows, g', least='least_rows')},
    curve AS (
        SELECT least_rows, g, sum({GAIN}) OVER (PARTITION BY least_rows, g ORDER BY {PROB} DESC, cust, period ROWS UNBOUNDED PRECEDING) AS upto
        FROM pairs k JOIN stump s USING (least_rows, g) WHERE fold = g
    )
    SELECT least_rows, round(sum(best), 2)::DOUBLE AS gain FROM (
        SELECT least_rows, g, max(upto) AS best FROM curve GROUP BY ALL) GROUP BY ALL"""
)
def stump_cross_validation(spark, folder):
    """Five stratified folds, the folds' and points' fits side by side: the summed best gains of the held out folds."""
    known = known_rows(spark, folder).where(BEFORE_TEST)
    folded = sampling.stratified_fold(known, (1,) * FOLDS, ["label"], KEYS, 19, draw=md5_draw)
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="target", **STUMP)
    grid = ParamGridBuilder().addGrid(tree.minInstancesPerNode, list(FOLD_ROWS)).build()
    evaluator = models.GainEvaluator("target_test", KEYS)
    _, gains = models.cross_validate(cut_lineage(folded), ["tenure"], tree, grid, evaluator, fold="fold", folds=FOLDS)
    rows = [(int(point[tree.minInstancesPerNode]), round(float(g * FOLDS), 2)) for point, g in zip(grid, gains)]
    return spark.createDataFrame(rows, "least_rows int, gain double")


# --- ensembles ------------------------------------------------------------------------------------------------------

TREES = 512
REPORT = (1, 2, 4, 8, 16, 32, 64, 128, 256, 384, 512)
#: Which of the two columns each tree sees, drawn as ``subspace_trees`` draws them.
SEEN = [random.Random(23 * 100_003 + i).sample(["tenure", "views"], 1)[0] for i in range(1, TREES + 1)]


@query(
    KNOWN + f""", train AS (SELECT 1 AS g, x, z, y FROM known WHERE {BEFORE_TEST}), {stump_sql('train', 'one')}, {stump_sql('train', 'two', x='z')},
    rates AS (
        SELECT cust, period, label, CASE WHEN k.x <= one.thr THEN one.low ELSE one.high END AS by_tenure,
               CASE WHEN k.z <= two.thr THEN two.low ELSE two.high END AS by_views
        FROM known k CROSS JOIN one CROSS JOIN two WHERE {TEST_DAYS}
    ), sizes AS (SELECT * FROM (VALUES {', '.join(f"({n}, {SEEN[:n].count('tenure')}, {SEEN[:n].count('views')})" for n in REPORT)}) t(trees, a, b)),
    summed AS (SELECT *, a * by_tenure + b * by_views > trees * {CHOSEN}::DOUBLE AS chosen FROM rates, sizes)
    SELECT trees, coalesce(sum({GAIN}) FILTER (WHERE chosen), 0)::BIGINT AS gain, count(*) FILTER (WHERE chosen) AS contacts
    FROM summed GROUP BY trees"""
)
def stump_bagging_report(spark, folder):
    """512 trees that see one of two columns each, scored in one pass."""
    known, columns = known_rows(spark, folder), ["tenure", "views"]
    trees = models.subspace_trees(known.where(BEFORE_TEST), columns, TREES, seed=23, **STUMP)
    scores = models.subspace_scores(trees, known.where(TEST_DAYS), [*KEYS, "label"])
    return models.bagging_report(scores, KEYS, REPORT, threshold=CHOSEN)


SEEDS = tuple(range(101, 121))


@query(ONE + f" SELECT cust, period, round({PROB}, 9) AS prob FROM known k CROSS JOIN stump s WHERE {TEST_DAYS}")
def stump_seed_ensemble(spark, folder):
    """Twenty stored models; a second run loads them all, and their mean is taken in one pass."""
    known, path = known_rows(spark, folder), fresh_folder(spark, "models")

    def fit(seed):
        return models.train_forest(known.where(BEFORE_TEST), ["tenure"], numTrees=2, bootstrap=False, featureSubsetStrategy="all", seed=seed, **STUMP)

    models.seed_ensemble(fit, SEEDS, path, models.load_forest)
    scored = models.score_saved({s: f"{path}/seed_{s}" for s in SEEDS}, known.where(TEST_DAYS), ["tenure"], KEYS)
    return rounded(scored, ["prob"], 9)


# --- boosting stopped by the gain -----------------------------------------------------------------------------------

ROUNDS, RATE = 12, 0.3


def boosting_sql() -> str:
    """Boosting written out: each round fits one split to the slopes of the log loss at the sums so far."""
    steps = []
    for i in range(1, ROUNDS + 1):
        slope = "n1 - n0" if i == 1 else "n1 * (4 / (1 + exp(2 * f))) - n0 * (4 / (1 + exp(-2 * f)))"
        weight = 1.0 if i == 1 else RATE
        steps.append(f"""
c{i} AS (
    SELECT x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
    FROM (SELECT x, n0 + n1 AS n, ({slope})::DOUBLE AS s FROM f{i - 1} WHERE n0 + n1 > 0) WINDOW w AS (ORDER BY x)
), t{i} AS (
    SELECT (x + nx) / 2 AS thr, sl / nl AS low, (st - sl) / (nt - nl) AS high FROM c{i} WHERE nx IS NOT NULL
    ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, x LIMIT 1
), f{i} AS MATERIALIZED (
    SELECT x, n0, n1, f + {weight}::DOUBLE * CASE WHEN x <= thr THEN low ELSE high END AS f FROM f{i - 1}, t{i}
)""")
    stages = " UNION ALL ".join(f"SELECT {i} AS trees, x, f FROM f{i}" for i in range(1, ROUNDS + 1))
    return KNOWN + f""", f0 AS (
    SELECT x, count(*) FILTER (WHERE {TRAIN_DAYS} AND y = 0) AS n0, count(*) FILTER (WHERE {TRAIN_DAYS} AND y = 1) AS n1, 0::DOUBLE AS f
    FROM known GROUP BY x
),{",".join(steps)}, stages AS ({stages}),
sums AS (
    SELECT trees, 1 / (1 + exp(-2 * f)) AS prob, sum({GAIN}) AS gain FROM known JOIN stages USING (x) WHERE {VALID_DAYS} GROUP BY ALL
), upto AS (SELECT trees, prob, sum(gain) OVER (PARTITION BY trees ORDER BY prob DESC) AS gain FROM sums),
best AS (SELECT trees, max(gain) AS max_gain, arg_min(prob, (-gain, -prob)) AS threshold FROM upto GROUP BY trees),
chosen AS (SELECT trees, threshold FROM best ORDER BY max_gain DESC, trees LIMIT 1)
"""


@query(boosting_sql() + "SELECT trees::INT AS trees, max_gain::BIGINT AS max_gain, round(threshold, 9) AS threshold FROM best")
def boosting_gain_by_trees(spark, folder):
    """The gain on the validation days after each number of boosted trees, from one scoring of the rows."""
    _, gains, _ = _boosted(spark, folder)
    return rounded(gains.select("trees", "max_gain", "threshold"), ["threshold"], 9)


@query(
    boosting_sql() + f"""SELECT cust, period, c.trees::INT AS trees, round(1 / (1 + exp(-2 * f)), 9) AS prob,
        CASE WHEN 1 / (1 + exp(-2 * f)) >= threshold THEN 1 ELSE 0 END AS Predicted
    FROM known JOIN stages USING (x) JOIN chosen c USING (trees) WHERE {TEST_DAYS}"""
)
def boosting_stopped_by_gain(spark, folder):
    """The test days scored by the model cut to its best number of trees, and contacted above the best threshold."""
    cut, gains, known = _boosted(spark, folder)
    threshold = gains.where(F.col("trees") == cut.trees).first()["threshold"]
    scored = packed.mean_packed(cut, known.where(TEST_DAYS), KEYS)
    chosen = profit.label_by_threshold("prob", threshold, strict=False)
    return scored.select(*KEYS, F.lit(cut.trees).alias("trees"), r("prob", 9).alias("prob"), chosen.alias("Predicted"))


def _boosted(spark, folder):
    known = known_rows(spark, folder)
    model = models.train_gbt(known.where(TRAIN_DAYS), ["tenure"], maxIter=ROUNDS, stepSize=RATE, seed=17, **STUMP)
    cut, gains = models.stop_by_gain(model, known.where(VALID_DAYS), ["tenure"], profit.gain())
    return cut, gains, known


# --- what the trees look like ---------------------------------------------------------------------------------------


@query(ONE + " SELECT t.tree::INT AS tree, 2::BIGINT AS leaves, round(thr, 6) AS threshold, nt::BIGINT AS rows FROM stump, range(3) t(tree)")
def stump_leaves_and_splits(spark, folder):
    known = known_rows(spark, folder)
    forest = models.train_forest(known.where(BEFORE_TEST), ["tenure"], numTrees=3, bootstrap=False, featureSubsetStrategy="all", **STUMP)
    table = models.split_table(forest, fresh_folder(spark, "splits"))
    splits = models.splits_on(table, 0).select("tree", r("threshold").alias("threshold"), "rows")
    return models.leaves_per_tree(table).join(splits, "tree")


@query(
    ONE + f""", leaves AS (SELECT cust, period, label, CASE WHEN k.x <= s.thr THEN 0 ELSE 1 END AS leaf FROM known k CROSS JOIN stump s WHERE {TEST_DAYS}),
    members AS (
        SELECT *, sum(n) OVER (PARTITION BY label) AS size FROM (SELECT label, leaf, count(*) AS n FROM leaves GROUP BY ALL))
    SELECT l.cust, l.period, m.label, round(m.n::DOUBLE / m.size, 9) AS proximity FROM leaves l JOIN members m USING (leaf)"""
)
def stump_proximity(spark, folder):
    """Mean proximity of each row to each class in a forest of four equal trees."""
    known = known_rows(spark, folder)
    forest = models.train_forest(known.where(BEFORE_TEST), ["tenure"], numTrees=4, bootstrap=False, featureSubsetStrategy="all", **STUMP)
    leaves = models.with_leaves(forest, known.where(TEST_DAYS), ["tenure"])
    return rounded(models.group_proximity(cut_lineage(leaves), KEYS, "label"), ["proximity"], 9)


@query(
    ONE + ", views AS (SELECT 1 AS g, z AS x, y FROM known WHERE " + BEFORE_TEST + "), " + stump_sql("views", "other") + f""", leaves AS (
        SELECT cust, period, CASE WHEN k.x <= s.thr THEN 0 ELSE 1 END AS a, CASE WHEN k.z <= o.thr THEN 0 ELSE 1 END AS b
        FROM known k CROSS JOIN stump s CROSS JOIN other o WHERE {TEST_DAYS}
    ), pairs AS (
        SELECT q.cust, q.period, l.cust AS near_cust, l.period AS near_period, (q.a = l.a)::INT + (q.b = l.b)::INT AS shared
        FROM leaves q JOIN leaves l ON (q.a = l.a OR q.b = l.b) AND NOT (q.cust = l.cust AND q.period = l.period) WHERE q.cust % 100 = 0
    )
    SELECT cust, period, (row_number() OVER w)::INT AS rank, near_cust, near_period, shared / 2.0::DOUBLE AS proximity
    FROM pairs WINDOW w AS (PARTITION BY cust, period ORDER BY shared DESC, near_cust, near_period) QUALIFY row_number() OVER w <= 5"""
)
def stump_nearest_rows(spark, folder):
    """The five rows nearest to each row of every hundredth customer, in a forest of one tree over each of two columns."""
    known = known_rows(spark, folder)
    leaves = known.where(TEST_DAYS)
    for column, name in (("tenure", "_a"), ("views", "_b")):
        forest = models.train_forest(known.where(BEFORE_TEST), [column], numTrees=1, bootstrap=False, featureSubsetStrategy="all", **STUMP)
        leaves = models.with_leaves(forest, leaves, [column], name)
    leaves = leaves.select(*KEYS, F.concat("_a", "_b").alias("leaves"))
    return nearest_by_proximity(leaves, F.col("cust") % 100 == 0, KEYS, 5)


@query(
    ONE + f""", leaves AS (SELECT period, CASE WHEN k.x <= s.thr THEN 0 ELSE 1 END AS leaf FROM known k CROSS JOIN stump s)
    SELECT period, 'rf_00' || t.tree || '_00' || leaf AS leaf, count(*) AS n FROM leaves, range(1, 3) t(tree) GROUP BY ALL"""
)
def stump_leaf_columns(spark, folder):
    """How often each 0/1 column of a leaf embedding is set, by day."""
    from pyspark.ml.functions import vector_to_array

    known = known_rows(spark, folder)
    forest = models.train_forest(known.where(BEFORE_TEST), ["tenure"], numTrees=2, bootstrap=False, featureSubsetStrategy="all", **STUMP)
    leaves = models.with_leaves(forest, known, ["tenure"])
    vectors, names = models.leaf_embedding(leaves, 2, leaves.where(BEFORE_TEST))
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("leaf"), vector_to_array("leaf_vector").alias("on"))
    on = vectors.select("period", F.explode(named).alias("c")).where("c.on = 1")
    return on.groupBy("period", F.col("c.leaf").alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
