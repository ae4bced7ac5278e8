import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, profit, quality, ranks


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [(i, m, rng.choice(["BAJA+2", "CONTINUA", "BAJA+1", None]), round(rng.random(), 2)) for m in "ab" for i in range(700)]
    return spark.createDataFrame(rows, "cust int, model string, label string, prob double")


def gains_of(scored, model):
    rows = sorted((r for r in scored.collect() if r["model"] == model), key=lambda r: (-r["prob"], r["cust"]))
    return rows, np.cumsum([780000 if r["label"] == "BAJA+2" else -20000 for r in rows])


@pytest.mark.parametrize("rows_per_task", [10**6, 100])
@pytest.mark.parametrize("width", [5, 101, 1001])
def test_plateau(scored, width, rows_per_task):
    curve = profit.cumulative_gain(scored, by=["model"], group_rows="group_rows", rows_per_task=rows_per_task)
    for partial in (True, False):
        got = {}
        for r in profit.plateau(curve, width, by=["model"], partial=partial, block=150).collect():
            got[(r["model"], r["position"])] = r["gan_meseta"]
        for model in "ab":
            _, total = gains_of(scored, model)
            for i in range(len(total)):
                seen = total[max(0, i - width // 2) : i + width // 2 + 1]
                value = got[(model, i + 1)]
                if partial or len(seen) == width:
                    assert value == pytest.approx(seen.mean())
                else:
                    assert value is None


def test_top_k_is_exact_and_takes_the_best(scored):
    labelled = profit.label_top_k(scored, 50, by=["model"], rows_per_task=90)
    for model in "ab":
        best = {r["cust"] for r in gains_of(scored, model)[0][:50]}
        assert {r["cust"] for r in labelled.where(f"model = '{model}' and Predicted = 1").collect()} == best


def test_best_count_and_threshold(scored):
    curve = profit.cumulative_gain(scored, by=["model"])
    for r in profit.gain_summary(curve, by=["model"]).collect():
        rows, total = gains_of(scored, r["model"])
        at = int(total.argmax())
        assert (r["max_gain"], r["contacts"], r["threshold"]) == (total[at], at + 1, rows[at]["prob"])


def test_threshold_may_be_strict(spark):
    df = spark.createDataFrame([(0.024,), (0.025,), (0.026,)], "prob double")
    strict, loose = profit.label_by_threshold(), profit.label_by_threshold(strict=False)
    assert [tuple(r) for r in df.select(strict, loose).collect()] == [(0, 0), (0, 1), (1, 1)]


def test_auc_of_ties_and_perfect_order(spark):
    df = spark.createDataFrame([(1, 0.9, "p"), (0, 0.1, "p"), (1, 0.5, "t"), (0, 0.5, "t")], "y int, prob double, g string")
    assert {r["g"]: r["auc"] for r in profit.auc(df, F.col("y") == 1, by=["g"]).collect()} == {"p": 1.0, "t": 0.5}


def test_apo_counts_all_models(scored):
    means, best, near = profit.apo_experiment(scored, [10, 100, 300], model="model")
    expected = {k: np.mean([gains_of(scored, m)[1][k - 1] for m in "ab"]) for k in (10, 100, 300)}
    assert {r["cutoff"]: r["mean_gain"] for r in means.collect()} == pytest.approx(expected)
    top = best.first()
    assert top["mean_gain"] == max(expected.values())
    distances = [(abs(g - top["mean_gain"]), m, i + 1) for m in "ab" for i, g in enumerate(gains_of(scored, m)[1])]
    row = near.first()
    assert (row["distance"], row["model"], row["position"]) == min(distances)


def test_stability_of_a_column_with_itself(spark):
    rng = random.Random(1)
    rows = [(i % 2, rng.gauss(0, 1) if i % 9 else None, 1.0 if i % 5 else 7.0) for i in range(800)]
    df = spark.createDataFrame(rows, "side int, x double, y double")
    both = df.where("side = 0")
    table = quality.psi_table(both, ["x", "y"], F.lit(True), F.lit(True))
    assert {r["feature"]: r["psi"] for r in table.collect()} == {"x": 0.0, "y": 0.0}


def test_stability_of_an_empty_bin(spark):
    rows = [("e", float(i)) for i in range(100)] + [("a", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "side string, x double")
    sides = (F.col("side") == "e", F.col("side") == "a")
    plain = quality.psi(df, "x", *sides, buckets=2).first()["psi"]
    shares = quality.psi(df, "x", *sides, buckets=2, epsilon=0.001).first()["psi"]
    assert plain == np.inf
    assert shares == pytest.approx(0.5 * np.log(2) + (0.001 - 0.5) * np.log(0.001 / 0.5))
    assert quality.psi(df, "x", F.col("side") == "e", F.lit(False), buckets=2).first()["psi"] is None


def test_signed_rank_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (2, 1, 5.0), (3, 1, 9.0), (4, 1, -2.0), (5, 1, 0.0), (6, 1, None)], "cust int, period int, v double"
    )
    for rows_per_task in (10**6, 1):
        got = {r["cust"]: r["v"] for r in ranks.signed_rank(df, ["v"], ["period"], ["cust"], rows_per_task).collect()}
        assert got == {1: 0.5, 2: 0.5, 3: 1.0, 4: -1.0, 5: 0.0, 6: None}


@pytest.mark.parametrize("n", [1, 3, 10, 23])
def test_tiles(spark, n):
    df = spark.range(n).select(F.col("id").alias("cust"), F.lit(1).alias("g"), (F.col("id") % 7).alias("v"))
    made = ranks.add_group_ranks(df, "v", ["g"], ["cust"], (4, 10))
    df.createOrReplaceTempView("tile_input")
    plain = spark.sql("select cust, ntile(4) over (order by v, cust) a, ntile(10) over (order by v, cust) b from tile_input")
    expected = {r["cust"]: (r["a"], r["b"]) for r in plain.collect()}
    assert {r["cust"]: (r["v_tile4"], r["v_tile10"]) for r in made.collect()} == expected


def test_deflator_chain(spark):
    table = spark.createDataFrame([(202001, 10.0), (202002, 20.0), (202003, 5.0)], "foto_mes int, inflacion double")
    table = table.withColumnRenamed("inflacion", "inflation")
    got = {r["foto_mes"]: r["factor"] for r in features.deflators(table, base=202002).collect()}
    assert got[202001] is None and got[202002] == 1.0 and got[202003] == pytest.approx(1 / 1.32)


def test_bonus_by_hand(spark):
    rows = [(1, m, p, c) for m, p, c in [(202104, 100.0, 1), (202105, 100.0, 1), (202106, 160.0, 2), (202107, 100.0, 1)]]
    rows += [(2, 202105, 0.0, 1), (2, 202106, 50.0, 2)]
    df = spark.createDataFrame(rows, "numero_de_cliente int, foto_mes int, mpayroll double, cpayroll_trx int")
    got = {(r[0], r[1]): (r[2], r[3]) for r in features.spread_bonus(df).collect()}
    assert got[(1, 202104)] == (110.0, 1) and got[(1, 202106)] == (110.0, 1) and got[(1, 202107)] == (110.0, 1)
    # Two earlier rows are needed.
    assert got[(2, 202106)] == (50.0, 2)


@pytest.mark.parametrize("bins,edge_rows,k", [(4096, 100_000, 7), (4, 3, 0), (4, 3, 1), (4, 3, 60), (2, 1, 7), (2, 1, 10**6)])
def test_top_k_without_ranking(spark, bins, edge_rows, k):
    """Skewed and tied scores, a group with one score, a group smaller than k, a null group."""
    import random

    rng = random.Random(k)
    rows = [(g, i, 2.0 ** rng.randint(-300, 300) * rng.choice([1, -1]) if g == "x" else float(rng.randint(0, 3)) if g == "y" else 0.5) for g in ("x", "y", None) for i in range(80)]
    rows += [("s", i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, cust int, prob double")
    got = profit.label_top_k(df, k, by=["g"], bins=bins, edge_rows=edge_rows).collect()
    assert len(got) == len(rows)
    for g in ("x", "y", "s", None):
        best = sorted((-p, c) for h, c, p in rows if h == g)[:k]
        assert sorted((-r["prob"], r["cust"]) for r in got if r["g"] == g and r["Predicted"] == 1) == best


@pytest.mark.parametrize("odd", [None, float("nan")])
def test_top_k_of_scores_that_are_no_numbers(spark, odd):
    rows = [(i, odd if i % 3 == 0 else float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "cust int, prob double")
    got = {r["cust"] for r in profit.label_top_k(df, 5).where("Predicted = 1").collect()}
    assert got == ({11, 10, 8, 7, 5} if odd is None else {0, 3, 6, 9, 11})


def test_repeated_leaderboard_reads_its_scores_once(spark, tmp_path):
    """All but the first pass read the stored rows; a model that contacts nobody keeps its rows."""
    rows = [(i, 1, "BAJA+2" if i % 4 else "CONTINUA", m, 0.9 if m == "a" else 0.1) for i in range(80) for m in "ab"]
    spark.createDataFrame(rows, "cust int, period int, label string, model string, prob double").write.parquet(str(tmp_path / "scores"))
    scored = spark.read.parquet(str(tmp_path / "scores"))
    board = profit.repeated_leaderboard(scored, ["cust", "period"], F.col("prob") >= 0.6, repeats=4, share=0.25)
    assert not [f for f in board.inputFiles() if "scores" in f]
    got = {(r["repeat"], r["model"]): (r["public"], r["private"]) for r in board.collect()}
    public, private = (15 * 780_000 - 5 * 20_000) / 0.25, (45 * 780_000 - 15 * 20_000) / 0.75
    assert got == {(i, m): (public, private) if m == "a" else (0.0, 0.0) for i in range(1, 5) for m in "ab"}
