"""The two-level ranking against plain Python, on groups with a hot value, NULLs and a group with most rows."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.ordering import exact_quantiles, ranked


def make_rows(n=1500):
    rng, rows = random.Random(3), []
    for k in range(n):
        group = None if k % 17 == 0 else "big" if k % 3 else f"g{k % 4}"
        value = None if rng.random() < 0.1 else 5.0 if rng.random() < 0.4 else round(rng.gauss(0, 2), 1)
        rows.append((k, group, value, rng.choice([-20, 780])))
    return rows


def expected_positions(rows, descending):
    out, groups = {}, {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for members in groups.values():
        sign = -1 if descending else 1
        members.sort(key=lambda r: (r[2] is None, sign * (r[2] or 0), r[0]))
        total = 0
        for i, row in enumerate(members, 1):
            total += row[3]
            equal = [j for j, other in enumerate(members, 1) if other[2] == row[2]]
            out[row[0]] = (i, total, len(members), equal[0], equal[-1])
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows_per_task", [10**6, 400, 60])
def test_positions_totals_and_ties(spark, descending, rows_per_task):
    rows = make_rows()
    df = spark.createDataFrame(rows, "k int, g string, v double, gain long").repartition(5)
    placed = ranked(
        df,
        ["g"],
        ["-v" if descending else "v", "k"],
        running={"total": F.col("gain")},
        group_rows="n",
        ties=("first", "last"),
        rows_per_task=rows_per_task,
    )
    got = {r["k"]: (r["position"], r["total"], r["n"], r["first"], r["last"]) for r in placed.collect()}
    assert got == expected_positions(rows, descending)


@pytest.mark.parametrize("literal, sample, sent", [(3, 200, 10**6), (16, 10**5, 0)])
def test_split_points_beyond_those_of_the_plan(spark, monkeypatch, literal, sample, sent):
    monkeypatch.setattr(ordering, "LITERAL_SPLITS", literal)
    monkeypatch.setattr(ordering, "SENT_SPLITS", sent)
    monkeypatch.setattr(ordering, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(ordering, "SAMPLE_PER_SPLIT", 4)
    rows = make_rows()
    df = spark.createDataFrame(rows, "k int, g string, v double, gain long").repartition(5)
    placed = ranked(df, ["g"], ["-v", "k"], running={"total": F.col("gain")}, group_rows="n", ties=("first", "last"), rows_per_task=60)
    got = {r["k"]: (r["position"], r["total"], r["n"], r["first"], r["last"]) for r in placed.collect()}
    assert got == expected_positions(rows, True)


def test_the_input_is_computed_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).mapInArrow(count, "k long, v long")
    placed = ranked(df, ["v"], ["-k"], ties=("first", "last"), rows_per_task=200)
    assert placed.where(F.col("position") != F.floor((4999 - F.col("k")) / 7) + 1).isEmpty()
    assert read.value <= 2 * 5000


def test_one_value_everywhere(spark):
    df = spark.range(900).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    placed = ranked(df, [], ["-v", "k"], ties=("first", "last"), rows_per_task=100)
    for row in placed.collect():
        assert (row["position"], row["first"], row["last"]) == (row["k"] + 1, 1, 900)


def test_text_and_date_keys(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(i, f"name {i * 7 % 50:02d}", day + datetime.timedelta(days=i * 3 % 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, name string, day date")
    placed = ranked(df, ["day"], ["-name", "k"], rows_per_task=5)
    got = {r["k"]: r["position"] for r in placed.collect()}
    for d in {r[2] for r in rows}:
        members = sorted((r for r in rows if r[2] == d), key=lambda r: r[0])
        members.sort(key=lambda r: r[1], reverse=True)
        assert [got[r[0]] for r in members] == list(range(1, len(members) + 1))


def test_uniform_order_needs_no_sample(spark):
    from tidemark.functions.scalar import draw

    df = spark.range(2000).withColumn("d", draw(["id"], 5))
    a = ranked(df, [], ["d", "id"], uniform=True, rows_per_task=100)
    b = ranked(df, [], ["d", "id"])
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


@pytest.mark.parametrize("rows_per_task", [10**6, 80])
def test_quantiles(spark, rows_per_task):
    rows, probabilities = make_rows(), [0, 0.1, 0.25, 0.5, 0.9, 1]
    df = spark.createDataFrame(rows, "k int, g string, v double, gain long")
    found = exact_quantiles(df, ["g"], "v", probabilities, rows_per_task=rows_per_task)
    for row in found.collect():
        values = [r[2] for r in rows if r[1] == row["g"] and r[2] is not None]
        assert np.allclose(row["quantiles"], np.quantile(values, probabilities))


def test_large_group_is_spread_over_tasks(spark):
    """A group with almost all rows must not arrive in one task."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("g"), F.col("id").alias("k"), F.lit(0.5).alias("v")
    )
    placed = ranked(df, ["g"], ["-v", "k"], rows_per_task=500).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
    assert max(sizes) < 15000


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, k int, v double")
    assert ranked(df, ["g"], ["v", "k"]).count() == 0
    assert ranked(df, [], ["v", "k"], rows_per_task=0).count() == 0


def test_null_sums_and_types_are_alike_at_every_size(spark):
    rows = [(g, k, None if k < 3 or k % 4 == 0 else k) for g in ("a", None) for k in range(40)]
    df = spark.createDataFrame(rows, "g string, k int, x int")

    def made(rows_per_task):
        out = ranked(df, ["g"], ["k"], position="n", running={"s": F.col("x")}, rows_per_task=rows_per_task)
        return out.dtypes, sorted(map(str, out.collect()))

    assert made(5) == made(10**9)


@pytest.mark.parametrize("by", [["g"], []])
def test_a_hot_value_stays_off_the_driver(spark, monkeypatch, by):
    rows = [("a" if k % 3 else None, 0.0 if k % 10 else float(k)) for k in range(6000)]
    df, probabilities = spark.createDataFrame(rows, "g string, v double"), [0, 0.05, 0.9, 0.95, 1]
    taken, collect = [], type(df).collect

    def counted(self):
        taken.append(collect(self))
        return taken[-1]

    monkeypatch.setattr(type(df), "collect", counted)
    found = exact_quantiles(df, by, "v", probabilities, rows_per_task=100)
    ranked(df, [], ["v"], rows_per_task=100)
    assert taken and max(map(len, taken)) <= 601  # distinct values, not 6000 rows
    for row in collect(found):
        values = [v for g, v in rows if not by or g == row["g"]]
        assert np.allclose(row["quantiles"], np.quantile(values, probabilities))
