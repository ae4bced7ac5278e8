import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import models, packed, sampling, trials
from tidemark.sources import tables

COLUMNS, KEYS = ["x", "y", "z"], ["cust", "period"]


@pytest.fixture(scope="module")
def table(spark):
    rng, rows = random.Random(8), []
    for cust in range(300):
        x, y, z = rng.random(), rng.random(), rng.random()
        hit = x + 0.2 * rng.random() > 0.9
        rows.append((cust, cust % 5, x, y, None if cust % 20 == 0 else z, float(hit), "BAJA+2" if hit else "CONTINUA"))
    df = spark.createDataFrame(rows, "cust int, period int, x double, y double, z double, target double, label string")
    return models.impute(df, COLUMNS, "median").cache()


@pytest.fixture(scope="module")
def forest(table):
    return models.train_forest(table, COLUMNS, numTrees=6, maxDepth=3, seed=1)


@pytest.fixture(scope="module")
def leaves(forest, table):
    return models.with_leaves(forest, table, COLUMNS).cache()


def test_imputation(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, 7)], "a int, b int")
    filled = models.impute(df, ["a", "b"], "mean", sentinels={"a": -999})
    assert sorted(tuple(r) for r in filled.collect()) == [(-999.0, 7.0), (1.0, 6.0), (2.0, 5.0)]
    assert models.impute(df, ["b"], values={"b": 1.0}).where("b = 1").count() == 1


@pytest.mark.parametrize("rows_per_task", [10**6, 3])
def test_exact_fill_values(spark, rows_per_task):
    import statistics

    rng = random.Random(1)
    rows = [(rng.choice([None, 1.0, 2.0, 3.0, 7.0, float("nan")]), rng.randint(0, 6), None, 5.0 if i < 4 else None) for i in range(41)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double")
    for name, rule in (("mean", statistics.mean), ("median", statistics.median), ("mode", lambda v: min(statistics.multimode(v)))):
        got = models.fill_values(df, ["a", "b", "c", "d"], name, rows_per_task=rows_per_task)
        known = [[x for x in column if x is not None and x == x] for column in zip(*rows)]
        assert got == pytest.approx({c: float(rule(v)) if v else 0.0 for c, v in zip("abcd", known)})
    with pytest.raises(ValueError):
        models.fill_values(df, ["a"], "guess")


def test_scores_find_the_signal(forest, table):
    scored = models.score(forest, table, COLUMNS, ["target"])
    means = {r["target"]: r["m"] for r in scored.groupBy("target").agg(F.avg("prob").alias("m")).collect()}
    assert means[1.0] > 3 * means[0.0]


def test_one_scan_scores_all_models(table, tmp_path):
    def fit(seed):
        return models.train_forest(table, COLUMNS, numTrees=3, maxDepth=2, seed=seed)

    made = models.seed_ensemble(fit, [1, 2], str(tmp_path), models.load_forest)

    def refuse(seed):
        raise AssertionError("stored models must be loaded")

    again = models.seed_ensemble(refuse, [1, 2], str(tmp_path), models.load_forest)
    long = models.score_models(again, table, COLUMNS, KEYS)
    assert long.count() == 600
    for seed, model in made.items():
        alone = {r["cust"]: r["prob"] for r in models.score(model, table, COLUMNS, ["cust"]).collect()}
        assert {r["cust"]: r["prob"] for r in long.where(f"model = {seed}").collect()} == pytest.approx(alone)
    mean = {r["cust"]: r["prob"] for r in models.mean_ensemble(long, KEYS).collect()}
    paths = {s: f"{tmp_path}/seed_{s}" for s in (1, 2)}
    saved = models.score_saved(paths, table, COLUMNS, KEYS)
    assert {r["cust"]: r["prob"] for r in saved.collect()} == pytest.approx(mean)


def test_embedding_has_one_leaf_per_tree(leaves):
    vectors, names = models.leaf_embedding(leaves, 6, leaves.where("period < 3"))
    row = vectors.select(F.aggregate(vector_to_array("leaf_vector"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert {r["s"] for r in row.collect()} == {6.0}
    assert len(names) == vectors.first()["leaf_vector"].size
    assert names[0] == "rf_001_000"


def test_leaf_table(leaves):
    assert models.leaf_table(leaves, KEYS).count() == 1800


def test_group_proximity_against_all_pairs(leaves):
    rows = [(r["cust"], r["label"], r["leaves"]) for r in leaves.collect()]
    got = {(r["cust"], r["label"]): r["proximity"] for r in models.group_proximity(leaves, KEYS, "label").collect()}
    for cust, _, mine in rows[:40]:
        for label in ("BAJA+2", "CONTINUA"):
            others = [sum(a == b for a, b in zip(mine, other)) / 6 for _, other_label, other in rows if other_label == label]
            assert got.get((cust, label), 0.0) == pytest.approx(sum(others) / len(others))


@pytest.mark.parametrize("sent, block", [(2_000_000, 8_192), (30, 16)])
def test_nearest_by_proximity_against_all_pairs(leaves, monkeypatch, sent, block):
    from tidemark.operators import neighbours

    monkeypatch.setattr(neighbours, "SENT_LEAVES", sent)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rows = [(tuple(r[c] for c in KEYS), r["leaves"]) for r in leaves.collect()]
    near = neighbours.nearest_by_proximity(leaves.repartition(3), F.col("cust") % 7 == 0, KEYS, 4)
    got = {}
    for r in near.orderBy("rank").collect():
        got.setdefault(tuple(r[c] for c in KEYS), []).append((r["proximity"], tuple(r[f"near_{c}"] for c in KEYS)))
    expected = {}
    for key, mine in rows:
        if key[KEYS.index("cust")] % 7 == 0:
            shares = [(sum(a == b for a, b in zip(mine, other)) / 6, k) for k, other in rows if k != key]
            expected[key] = sorted([s for s in shares if s[0]], key=lambda s: (-s[0], s[1]))[:4]
    assert got == {k: v for k, v in expected.items() if v} and got
    assert neighbours.nearest_by_proximity(leaves, F.lit(False), KEYS, 4).isEmpty()


def test_canaries_lose(spark, table):
    marked = sampling.add_canaries(table, 3, KEYS, seed=1)
    names = ["canarito_1", "canarito_2", "canarito_3", *COLUMNS]
    model = models.train_forest(marked, names, numTrees=20, maxDepth=3, seed=1)
    kept = models.above_canaries(models.importance_table(model, names, spark))
    assert "x" in {r["feature"] for r in kept.collect()}
    assert all(not r["feature"].startswith("canarito") for r in kept.collect())


def test_split_table(forest, tmp_path):
    table = models.split_table(forest, str(tmp_path / "m"))
    assert table.where("is_leaf").count() == sum(t.numNodes // 2 + 1 for t in forest.trees)
    assert models.leaves_per_tree(table).count() == 6
    assert models.splits_on(table, 0).count() > 0


def test_evaluator_and_cross_validation(table):
    from pyspark.ml.regression import DecisionTreeRegressor
    from pyspark.ml.tuning import ParamGridBuilder

    folded = sampling.stratified_fold(table, (1, 1, 1), ["label"], KEYS, 3)
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="target")
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [0, 3]).build()
    evaluator = models.GainEvaluator("target", KEYS, threshold=0.5)
    best, gains = models.cross_validate(folded, COLUMNS, tree, grid, evaluator, fold="fold", folds=3)
    assert gains[1] > gains[0] == 0.0
    assert best.depth > 0


@pytest.mark.parametrize("threads", [1, 3])
def test_grid_search_resumes(spark, tmp_path, threads):
    path, ran = str(tmp_path / "grid"), []
    grid = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "depth int, rows int")

    def run(point):
        ran.append(point["depth"])
        if point["depth"] == 2 and ran.count(2) == 1:
            raise RuntimeError("stopped")
        return spark.createDataFrame([(1, 10.0 * point["depth"])], "seed long, gain double")

    with pytest.raises(RuntimeError):
        models.grid_search(grid.where("depth < 3"), ["depth", "rows"], run, path, threads)
    details = models.grid_search(grid, ["depth", "rows"], run, path, threads)
    assert sorted(ran) == [1, 2, 2, 3] and details.columns == ["depth", "rows", "seed", "gain"]
    assert [r["depth"] for r in trials.grid_summary(details, ["depth", "rows"], "gain").collect()] == [3, 2, 1]


def test_a_failed_fit_lets_the_others_finish(spark):
    from tidemark.operators.fits import concurrently

    done = []

    def call(i):
        if i == 1:
            raise ValueError("one")
        done.append(i)
        return i

    assert concurrently([lambda i=i: i * i for i in range(20)], 4, spark) == [i * i for i in range(20)]
    with pytest.raises(ValueError):
        concurrently([lambda i=i: call(i) for i in range(6)], 3, spark)
    assert sorted(done) == [0, 2, 3, 4, 5]


def test_monte_carlo_by_hand_and_by_threads(table):
    def fit(rows):
        return models.train_tree(rows, COLUMNS, maxDepth=2, seed=3)

    marked = models.split_bits(table, 6, seed=4)
    gains = [models.split_gains(marked, range(1, 7), fit, COLUMNS, threshold=0.2, threads=t).collect() for t in (1, 8)]
    assert gains[0] == gains[1] and [r["seed"] for r in gains[0]] == [1, 2, 3, 4, 5, 6]
    assert len({r["gain"] for r in gains[0]}) > 1
    for r in gains[0][:3]:
        inside = sampling.in_split("_test", r["seed"])
        scored = models.score(fit(marked.where(~inside)), marked.where(inside), COLUMNS, ["label"]).collect()
        by_hand = sum(780_000 if x["label"] == "BAJA+2" else -20_000 for x in scored if x["prob"] > 0.2) / 0.3
        assert r["gain"] == pytest.approx(by_hand)


@pytest.mark.parametrize("nodes", [packed.PART_NODES, 5])
def test_packed_trees_score_as_spark_does(spark, table, forest, nodes):
    tree = models.train_tree(table, ["y"], maxDepth=4, seed=1)
    arrays = packed.pack(spark, {7: forest, 3: tree}, COLUMNS, own_columns={3: ["y"]})
    assert arrays.trees == 7 and (len(arrays.parts(nodes)) > 1) == (nodes == 5)
    got = {(r["cust"], r["model"]): r["prob"] for r in packed.score_packed(arrays, table, ["cust"], nodes).collect()}
    own = {r["cust"]: r["prob"] for r in models.score(forest, table, COLUMNS, ["cust"]).collect()}
    other = {r["cust"]: r["prob"] for r in models.score(tree, table, ["y"], ["cust"]).collect()}
    assert got == pytest.approx({**{(c, 7): v for c, v in own.items()}, **{(c, 3): v for c, v in other.items()}})
    mean = {r["cust"]: r["prob"] for r in packed.mean_packed(arrays, table, ["cust"], nodes=nodes).collect()}
    assert mean == pytest.approx({c: (own[c] + other[c]) / 2 for c in own})


def test_packed_classifiers_too(spark, table):
    from pyspark.ml.classification import RandomForestClassifier

    forest = RandomForestClassifier(featuresCol="features", labelCol="target", numTrees=4, maxDepth=3, seed=5).fit(models.assemble(table, COLUMNS))
    got = {r["cust"]: r["prob"] for r in packed.mean_packed(packed.pack(spark, {1: forest}, COLUMNS), table, ["cust"]).collect()}
    assert got == pytest.approx({r["cust"]: r["prob"] for r in models.score(forest, table, COLUMNS, ["cust"]).collect()})


def test_packed_trees_take_no_missing_values(spark, forest):
    from pyspark.errors import PythonException

    holes = spark.createDataFrame([(1.0, None, 2.0)], "x double, y double, z double")
    with pytest.raises(PythonException, match="missing"):
        packed.mean_packed(packed.pack(spark, {1: forest}, COLUMNS), holes, []).collect()


def test_512_trees_in_one_pass(spark, table):
    trees = models.subspace_trees(table, COLUMNS, 512, seed=2, fraction=0.7, maxDepth=2)
    assert len({id(m) for _, m in trees.values()}) == 3  # three pairs of columns
    arrays = models.pack_subspace(trees, COLUMNS, spark)
    assert arrays.trees == 512
    got = {(r["cust"], r["model"]): r["prob"] for r in packed.score_packed(arrays, table.limit(20), ["cust"]).collect()}
    assert len(got) == 20 * 512
    for i in (1, 77, 512):
        names, model = trees[i]
        own = models.score(model, table, names, ["cust"]).collect()
        assert all(got[(r["cust"], i)] == pytest.approx(r["prob"]) for r in own if (r["cust"], i) in got)


@pytest.mark.parametrize("nodes", [packed.PART_NODES, 7])
def test_stages_are_shorter_trainings(spark, table, nodes):
    options = {"maxDepth": 2, "stepSize": 0.3, "seed": 5}
    model = models.train_gbt(table, COLUMNS, maxIter=6, **options)
    arrays = packed.pack(spark, {0: model}, COLUMNS)
    staged = {r["cust"]: r["stages"] for r in packed.staged_scores(arrays, table, ["cust"], nodes=nodes).collect()}
    for trees in (1, 3, 6):
        shorter = models.train_gbt(table, COLUMNS, maxIter=trees, **options)
        own = {r["cust"]: r["prob"] for r in models.score(shorter, table, COLUMNS, ["cust"]).collect()}
        assert {c: s[trees - 1] for c, s in staged.items()} == pytest.approx(own)
        cut = {r["cust"]: r["prob"] for r in packed.mean_packed(arrays.first(trees), table, ["cust"]).collect()}
        assert cut == pytest.approx(own)


def test_boosting_stops_at_the_best_gain(spark, table):
    from tidemark.operators.profit import gain

    model = models.train_gbt(table.where("period < 3"), COLUMNS, maxIter=8, maxDepth=2, stepSize=0.4, seed=5)
    valid = table.where("period >= 3")
    cut, gains = models.stop_by_gain(model, valid, COLUMNS, gain())
    arrays = packed.pack(spark, {0: model}, COLUMNS)
    brute = {}
    for trees in range(1, 9):
        scored = packed.mean_packed(arrays.first(trees), valid, ["label"]).collect()
        cuts = {r["prob"] for r in scored}
        worth = {c: sum(780_000 if r["label"] == "BAJA+2" else -20_000 for r in scored if r["prob"] >= c) for c in cuts}
        brute[trees] = (max(worth.values()), max(c for c in cuts if worth[c] == max(worth.values())))
    got = {r["trees"]: (r["max_gain"], r["threshold"]) for r in gains.collect()}
    assert {t: g for t, (g, _) in got.items()} == {t: g for t, (g, _) in brute.items()}
    assert {t: c for t, (_, c) in got.items()} == pytest.approx({t: c for t, (_, c) in brute.items()})
    assert cut.trees == min(t for t in brute if brute[t][0] == max(g for g, _ in brute.values()))


def test_best_stage():
    pairs = [(1, 5), (2, 7), (3, 7), (4, 6), (5, 9)]
    assert models.best_stage(pairs) == 5 and models.best_stage(pairs, patience=2) == 2 and models.best_stage(pairs, patience=3) == 5


def test_bagging_counts_trees(table):
    made = models.subspace_trees(table, COLUMNS, 4, seed=2, fraction=0.7, maxDepth=2)
    assert all(len(names) == 2 for names, _ in made.values())
    scores = models.subspace_scores(made, table, [*KEYS, "label"])
    report = models.bagging_report(scores, KEYS, [1, 2, 4], threshold=0.3)
    for r in report.collect():
        summed = scores.where(f"model <= {r['trees']}").groupBy("cust").agg(F.sum("prob").alias("p"))
        assert r["contacts"] == summed.where(F.col("p") > r["trees"] * 0.3).count()


def test_segments_and_profiles(spark, table, leaves):
    vectors, _ = models.leaf_embedding(leaves, 6)
    clustered = models.segment(vectors, "leaf_vector", k=3).drop("leaf_vector").cache()
    assert clustered.select("cluster").distinct().count() == 3
    top = models.profile_clusters(clustered, COLUMNS, n=1, numTrees=5, maxDepth=3, seed=1)
    assert top.count() == 3


def test_unsupervised_forest(table):
    model = models.unsupervised_forest(table, COLUMNS, KEYS, numTrees=4, maxDepth=3)
    assert model.getNumTrees == 4


def test_min_rows_scale():
    assert models.rescale_min_rows(100, 1000, 2500) == 250


def test_boosting_with_weights(table):
    weighted = table.withColumns({"w": F.lit(2.0), "valid": F.col("period") == 0})
    model = models.train_gbt(weighted, COLUMNS, maxIter=5, weightCol="w", validationIndicatorCol="valid", seed=1)
    assert models.score(model, table, COLUMNS, KEYS).count() == 300


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, 202101, 1.5), (2, 202102, None)], "numero_de_cliente int, foto_mes int, m double")
    tables.write_panel(df, str(tmp_path / "p"))
    assert tables.read_panel(spark, str(tmp_path / "p"), [202101]).count() == 1
    tables.write_csv(df, str(tmp_path / "c"))
    assert tables.read_panel_csv(spark, str(tmp_path / "c")).where("m is null").count() == 1
    tables.write_submission(df.withColumn("Predicted", F.lit(1)), str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).columns == ["numero_de_cliente", "Predicted"]
    calls = []
    for _ in range(2):
        built = tables.load_or_build(spark, str(tmp_path / "f"), lambda: calls.append(1) or df, periods=[202102])
        assert built.count() == 1
    assert calls == [1]
