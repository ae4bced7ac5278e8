"""Trees that are grown together against Spark's own, fitted one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, packed, together

COLUMNS = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        a, b, c, d = rng.randint(0, 4), round(rng.lognormvariate(0, 1), 2), rng.choice([0.0, 0.0, 0.0, rng.random()]), rng.randint(-60, 60)
        rows.append((i, float(a), b, c, float(d), 7.0, float(rng.random() < 0.05 + 0.1 * (a > 2) + 0.2 * (b > 1.5) * (d < 0)), rng.gauss(d, 3)))
    return spark.createDataFrame(rows, "cust int, a double, b double, c double, d double, e double, target double, amount double").cache()


@pytest.mark.parametrize("label", ["target", "amount"])
@pytest.mark.parametrize("options", [{"maxDepth": 4, "minInstancesPerNode": 10}, {"maxDepth": 1, "maxBins": 256}, {"maxDepth": 3, "minInfoGain": 0.001}, {"maxDepth": 0}])
def test_same_trees_as_fitted_one_by_one(table, label, options):
    subsets = [("a", "b"), ("b", "c", "d"), ("e",), ("a", "c", "d", "e"), ("d",)]
    for names, model in zip(subsets, together.grow(table, COLUMNS, subsets, label, **options)):
        got = {r["cust"]: r["prob"] for r in models.score(model, table, names, ["cust"]).collect()}
        own = {r["cust"]: r["prob"] for r in models.score(models.train_tree(table, names, label, **options), table, names, ["cust"]).collect()}
        assert got == pytest.approx(own), names


def test_parts_of_nodes(table, monkeypatch):
    subsets = [("a", "b", "c"), ("b", "c", "d")]
    whole = together.grow(table, COLUMNS, subsets, maxDepth=3)
    monkeypatch.setattr(together, "CELLS", 1)
    for x, y in zip(whole, together.grow(table, COLUMNS, subsets, maxDepth=3)):
        assert np.array_equal(x.tree.feature, y.tree.feature) and np.array_equal(x.tree.value, y.tree.value)


def test_jobs_do_not_grow_with_trees(spark, table):
    columns, jobs = COLUMNS[:4] + ["cust", "amount"], {}
    for trees in (4, 200):
        spark.sparkContext.setJobGroup(f"trees-{trees}", "")
        made = models.subspace_trees(table, columns, trees, seed=3, maxDepth=3, minInstancesPerNode=5)
        assert len({id(m) for _, m in made.values()}) == (20 if trees == 200 else len({tuple(n) for n, _ in made.values()}))
        arrays = models.pack_subspace(made, columns, spark)
        jobs[trees] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{trees}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert arrays.trees == 200 and jobs[200] <= jobs[4] + 5
    got = packed.score_packed(arrays, table.limit(5), ["cust"]).collect()
    names, model = made[150]
    own = {r["cust"]: r["prob"] for r in models.score(model, table, names, ["cust"]).collect()}
    assert all(r["prob"] == own[r["cust"]] for r in got if r["model"] == 150)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 100])
def test_thresholds_by_walking_all_values(table, rows_per_task):
    names = ["b", "c", "amount", "a", "e"]
    got = together.thresholds(table, names, 32, rows_per_task)
    for name, cuts in zip(names, got):
        counts = {}
        for r in table.select(name).collect():
            counts[r[0]] = counts.get(r[0], 0) + 1
        values, expected = sorted(counts), []
        if len(values) <= 32:
            expected = [(x + y) / 2 for x, y in zip(values, values[1:])]
        else:
            upto, target = counts[values[0]], 3000 / 32
            for x, y in zip(values, values[1:]):
                last, upto = upto, upto + counts[y]
                if abs(last - target) < abs(upto - target):
                    expected.append((x + y) / 2)
                    target += 3000 / 32
        assert cuts.tolist() == expected, name


def test_missing_values_are_refused(table):
    with pytest.raises(ValueError):
        together.grow(table.withColumn("a", F.nullif("a", F.lit(1.0))), ["a", "b"], [("a",)], maxDepth=1)
    for missing in (None, float("nan")):
        holes = table.withColumn("target", F.when(F.col("cust") == 5, F.lit(missing)).otherwise(F.col("target")))
        with pytest.raises(ValueError):
            together.grow(holes, ["a", "b"], [("a",)], maxDepth=1)
