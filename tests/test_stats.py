import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import stats

# Published profits of two trees on nine splits, in order.
FIRST = [301800000, 314800000, 326600000, 299733333, 275333333, 290800000, 268200000, 271866667, 252400000]
SECOND = [252666667, 224266667, 278000000, 235266667, 205600000, 251533333, 219800000, 270800000, 261733333]
P_VALUES = [1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125, 0.015625, 0.0078125, 0.01171875]


@pytest.fixture(scope="module")
def gains(spark):
    rows = [("trees", i, a, b) for i, (a, b) in enumerate(zip(FIRST, SECOND), 1)]
    return spark.createDataFrame(rows, "pair string, ordinal int, gain1 long, gain2 long")


def test_published_p_values(gains):
    tests = {r["prefix"]: r["p_value"] for r in stats.sequential_test(gains, ["pair"], "ordinal").collect()}
    assert [tests[i] for i in range(1, 10)] == pytest.approx(P_VALUES)


def test_six_seeds_decide(gains):
    row = stats.sequential_choice(stats.sequential_test(gains, ["pair"], "ordinal"), ["pair"]).first()
    assert (row["winner"], row["pairs_used"]) == (1, 6)
    capped = stats.sequential_choice(stats.sequential_test(gains, ["pair"], "ordinal"), ["pair"], cap=5).first()
    assert (capped["winner"], capped["pairs_used"]) == (0, 5)


def test_distribution_by_enumeration(spark):
    table = {(r["n"], r["v"]): r["cdf"] for r in stats.signed_rank_distribution(spark, 9).collect()}
    for n in range(1, 9):
        sums = [sum(c) for k in range(n + 1) for c in itertools.combinations(range(1, n + 1), k)]
        for v in range(n * (n + 1) // 2 + 1):
            assert table[(n, v)] == sum(s <= v for s in sums) / 2**n


def test_ties_and_zeros_use_the_normal_approximation(spark):
    diffs = [3, 3, -1, 0, 5, 7, -3, 8, 2]
    rows = [("x", float(d), 0.0) for d in diffs]
    got = stats.signed_rank_test(spark.createDataFrame(rows, "g string, gain1 double, gain2 double"), ["g"]).first()
    # Ranks of 1, 2, 3, 3, 3, 5, 7, 8 are 1, 2, 4, 4, 4, 6, 7, 8; the negative ones are 1 and 4.
    n, v = 8, 36 - 5
    sigma = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (27 - 3) / 48)
    z = (v - n * (n + 1) / 4 - 0.5) / sigma
    assert got["v"] == v
    assert got["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_no_difference_gives_no_p_value(spark):
    df = spark.createDataFrame([("x", 1.0, 1.0)], "g string, gain1 double, gain2 double")
    assert stats.signed_rank_test(df, ["g"]).first()["p_value"] is None


def test_erfc(spark):
    from tidemark.functions.scalar import erfc

    xs = [i / 37 for i in range(-400, 400)] + [0.0, 25.0, 2.0, 1.9999999]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc(F.col("x")).alias("y")).collect()
    for r in got:
        assert r["y"] == pytest.approx(math.erfc(r["x"]), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("exact_below", [50, 1, 7])
def test_adding_pairs_one_by_one_is_ranking_every_prefix(spark, exact_below):
    rng = random.Random(3)
    rows = [(g, i, float(rng.randint(0, 9)), float(rng.randint(0, 9)) if i % 5 else None) for g in "ab" for i in range(1, 30) if i not in (4, 5)]
    gains = spark.createDataFrame(rows, "g string, ordinal int, gain1 double, gain2 double")
    got = {(r["g"], r["prefix"]): r for r in stats.sequential_test(gains, ["g"], "ordinal", exact_below=exact_below).collect()}
    prefixes = [(g, k, a, b) for g, i, a, b in rows for k in range(i, 30)]
    whole = stats.signed_rank_test(spark.createDataFrame(prefixes, "g string, prefix int, gain1 double, gain2 double"), ["g", "prefix"], exact_below=exact_below)
    expected = {(r["g"], r["prefix"]): r for r in whole.collect()}
    assert set(got) == set(expected)
    for k, r in expected.items():
        for c in ("pairs", "v", "mean1", "mean2", "p_value"):
            assert (got[k][c] is None) == (r[c] is None) and (r[c] is None or got[k][c] == pytest.approx(r[c])), (k, c)
