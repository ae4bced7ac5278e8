import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalar import draw, md5_draw
from tidemark.operators import sampling

KEYS = ["cust", "period"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(2)
    rows = [(c, p, rng.choices(["CONTINUA", "BAJA+1", "BAJA+2", None], [20, 2, 1, 1])[0], rng.random()) for c in range(200) for p in range(6)]
    return spark.createDataFrame(rows, "cust int, period int, label string, v double")


def keys_of(df):
    return {(r["cust"], r["period"]) for r in df.collect()}


def test_exact_undersample(panel):
    many = F.col("label") == "CONTINUA"
    n = panel.where(many).count()
    sample = sampling.undersample(panel, many, 0.13, KEYS, seed=4)
    assert sample.where(many).count() == int(0.13 * n)
    assert sample.where("label is null or label <> 'CONTINUA'").count() == panel.count() - n
    assert keys_of(sample) == keys_of(sampling.undersample(panel.repartition(7), many, 0.13, KEYS, seed=4))
    assert keys_of(sample) != keys_of(sampling.undersample(panel, many, 0.13, KEYS, seed=5))


@pytest.mark.parametrize("count", [0, 1, 57, 10**6])
def test_fixed_size(panel, count):
    many = F.col("label") == "CONTINUA"
    sample = sampling.sample_majority(panel, many, count, KEYS)
    assert sample.where(many).count() == min(count, panel.where(many).count())


@pytest.mark.parametrize("rows_per_task", [10**6, 50])
def test_folds_have_the_division_in_every_class(panel, rows_per_task):
    folds = sampling.stratified_fold(panel, (3, 7), ["label"], KEYS, 9, rows_per_task=rows_per_task)
    counts, sizes = Counter(), Counter()
    for r in folds.collect():
        counts[(r["label"], r["fold"])] += 1
        sizes[r["label"]] += 1
    for label, n in sizes.items():
        assert counts[(label, 1)] == n // 10 * 3 + min(n % 10, 3)


def test_folds_do_not_depend_on_partitions(panel):
    one = sampling.stratified_fold(panel, (1, 1), ["label"], KEYS, 9)
    two = sampling.stratified_fold(panel.repartition(11, "v"), (1, 1), ["label"], KEYS, 9, rows_per_task=40)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}


def test_repeated_splits(panel):
    splits = sampling.repeated_splits(panel, 5, 0.3, ["label"], KEYS, keep=["v"])
    sizes = {r["label"]: r["count"] for r in panel.groupBy("label").count().collect()}
    for r in splits.groupBy("repeat", "label").agg(F.count_if("is_public").alias("p"), F.count("*").alias("n")).collect():
        assert r["n"] == sizes[r["label"]] and r["p"] == int(0.3 * r["n"])
    chosen = [keys_of(splits.where(f"repeat = {i} and is_public")) for i in (1, 2)]
    assert chosen[0] != chosen[1]


@pytest.mark.parametrize("repeats,share", [(70, 0.5), (5, 0.0), (5, 1.0)])
def test_bits_of_repeated_splits(panel, repeats, share):
    """More repeats than a number has bits, empty and whole splits: bits against sorting."""
    marked = sampling.repeated_bits(panel, repeats, share, ["label"], KEYS, seed=9, draw=md5_draw).collect()
    assert len(marked) == panel.count()
    for repeat in {1, repeats, min(63, repeats)}:
        drawn = {(r["cust"], r["period"]): r["d"] for r in panel.withColumn("d", md5_draw([*KEYS], F.lit(f"{repeat}|9"))).collect()}
        word, place = divmod(repeat - 1, sampling.WORD)
        for label in {r["label"] for r in marked}:
            rows = sorted((drawn[(r["cust"], r["period"])], r["cust"], r["period"], r["bits"][word] >> place & 1) for r in marked if r["label"] == label)
            assert [x[3] for x in rows] == [int(i < int(len(rows) * share)) for i in range(len(rows))]


def test_cuts_of_draws_that_are_not_uniform(panel):
    def skewed(keys, seed):
        return F.pow(draw(keys, seed), F.lit(6.0))

    splits = sampling.repeated_splits(panel, 4, 0.3, ["label"], KEYS, draw=skewed)
    sizes = {r["label"]: r["count"] for r in panel.groupBy("label").count().collect()}
    for r in splits.groupBy("repeat", "label").agg(F.count_if("is_public").alias("p")).collect():
        assert r["p"] == int(0.3 * sizes[r["label"]])


def test_shuffles_keep_values(panel):
    apart = sampling.shuffle_apart(panel, ["v", "period"], KEYS, 1, rows_per_task=100)
    together = sampling.shuffle_together(panel, ["v", "label"], KEYS, 1, rows_per_task=100)
    values = sorted(r["v"] for r in panel.collect())
    assert sorted(r["v"] for r in apart.collect()) == values
    assert sorted(r["canarito_v"] for r in together.collect()) == values
    pairs = Counter((r["v"], r["label"]) for r in panel.collect())
    assert Counter((r["canarito_v"], r["canarito_label"]) for r in together.collect()) == pairs
    assert sum(r["canarito_v"] == r["v"] for r in together.collect()) < 30


def test_draws_are_uniform_and_repeatable(panel):
    drawn = panel.withColumn("d", draw(KEYS, 1))
    low, high, mean = drawn.agg(F.min("d"), F.max("d"), F.avg("d")).first()
    assert 0 <= low < 0.02 and 0.98 < high < 1 and abs(mean - 0.5) < 0.03
    assert {tuple(r) for r in drawn.collect()} == {tuple(r) for r in drawn.repartition(3).collect()}


def test_canaries_come_first(panel):
    made = sampling.add_canaries(panel, 3, KEYS)
    assert made.columns[:4] == ["canarito_1", "canarito_2", "canarito_3", "cust"]
    assert made.where("canarito_1 = canarito_2").count() == 0


@pytest.mark.parametrize("bins, edge_rows", [(4096, 500_000), (4, 3), (2, 1)])
def test_smallest_draws_with_finer_bins(panel, bins, edge_rows):
    drawn = panel.withColumn("d", draw(KEYS, 3))
    marked = sampling._mark_smallest(drawn, ["label"], "d", KEYS, F.floor(F.col("_rows") * 0.4), "in", bins, edge_rows)
    groups = {}
    for r in marked.collect():
        groups.setdefault(r["label"], []).append((r["d"], r["in"]))
    assert sum(map(len, groups.values())) == panel.count()
    for members in groups.values():
        flags = [flag for _, flag in sorted(members)]
        assert flags == [i < int(0.4 * len(flags)) for i in range(len(flags))]


def test_each_draw_is_taken_once(panel, monkeypatch):
    """One draw in all stored tables and what reads them, in as many tasks as there are draws for."""
    plans, store = [], sampling.cut_lineage

    def stored(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df)

    monkeypatch.setattr(sampling, "cut_lineage", stored)
    monkeypatch.setattr(sampling, "DRAWS_PER_TASK", panel.count() * 50 // 4, raising=False)
    marked = sampling.repeated_bits(panel, 50, 0.3, ["label"], KEYS, seed=9, draw=md5_draw)
    plans.append(marked._jdf.queryExecution().optimizedPlan().toString())
    assert sum(plan.count("md5(") for plan in plans) == 1
    assert any("Repartition 4, true" in plan for plan in plans)


def test_bits_of_groups_without_a_name(spark):
    rows = [(i, i % 2, None if i % 3 else "x") for i in range(400)]
    df = spark.createDataFrame(rows, "cust int, period int, label string")
    splits = sampling.repeated_splits(df, 3, 0.3, ["label"], KEYS, seed=4, draw=md5_draw)
    got = {(r["repeat"], r["label"]): (r["p"], r["n"]) for r in splits.groupBy("repeat", "label").agg(F.count_if("is_public").alias("p"), F.count("*").alias("n")).collect()}
    assert got == {(i, label): (n * 3 // 10, n) for i in (1, 2, 3) for label, n in ((None, 266), ("x", 134))}
    assert sampling.repeated_bits(df.where("cust < 0"), 3, 0.3, [], KEYS, draw=md5_draw).count() == 0
    assert {r["bits"][0] for r in sampling.repeated_bits(df, 3, 1.0, [], KEYS, draw=md5_draw).collect()} == {7}


def test_hashes_are_compared_as_their_draws(spark):
    rows = [(i if i % 7 else None, i % 5 if i % 3 else None) for i in range(120)]
    taken = spark.createDataFrame(rows, "cust int, period int").select(
        md5_draw(KEYS, F.lit("3|9")).alias("d"), md5_draw.hashed(md5_draw.text(KEYS), F.lit("3|9")).alias("h")
    )
    assert taken.where(md5_draw.number(F.col("h")) != F.col("d")).count() == 0
    drawn = [r["d"] for r in taken.distinct().collect()]
    around = [x for d in drawn[:20] for x in (math.nextafter(d, -1), d, math.nextafter(d, 2))]
    ends = spark.createDataFrame([(x,) for x in [*around, -1e30, -0.1, 0.0, 2.0**-48, 0.3, 1 - 2.0**-48, math.nextafter(1, 0), 1.0, 1.5, 1e30]], "x double")
    both = taken.crossJoin(ends.withColumn("b", md5_draw.bound(F.col("x"))))
    assert both.where((F.col("h") < F.col("b")) != (F.col("d") < F.col("x"))).count() == 0


def test_keys_are_written_once_for_all_draws_of_a_row(panel, monkeypatch):
    """The text of the keys is made below the dealing of rows, and hashes are compared without becoming numbers first."""
    plans, store = [], sampling.cut_lineage

    def stored(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df)

    monkeypatch.setattr(sampling, "cut_lineage", stored)
    sampling.repeated_bits(panel, 50, 0.3, ["label"], KEYS, seed=9, draw=md5_draw)
    drawing = [line for plan in plans for line in plan.splitlines() if "md5(" in line]
    assert len(drawing) == 1 and "concat_ws(" not in drawing[0]
    assert drawing[0].index(" < _low") < drawing[0].index("conv(")
