"""Samples, folds, splits and control columns. Draws are MD5 hashes here, so that the oracle can repeat them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import draw, md5_draw
from tidemark.operators import sampling
from tidemark.plans import panels as p
from tidemark.plans.profit_queries import DRAW, KEYS, REPEATS, SPLITS, sql_draw
from tidemark.plans.registry import query, r, rounded

DRAWN = p.LABELS + f""", drawn AS (SELECT *, {sql_draw('3', 'cust', 'period')} AS draw FROM labelled)
"""
MAJORITY = "label = 'CONTINUA'"


def _majority_sql(take):
    return DRAWN + f"""SELECT cust, period, label FROM (
        SELECT *, {MAJORITY} AS many, row_number() OVER (PARTITION BY coalesce({MAJORITY}, false) ORDER BY draw, cust, period) AS n,
               count(*) OVER (PARTITION BY coalesce({MAJORITY}, false)) AS size FROM drawn
    ) WHERE NOT coalesce(many, false) OR n <= {take}"""


@query(_majority_sql("floor(size * 0.1::DOUBLE)"))
def undersampled_exactly(spark, folder):
    sample = sampling.undersample(p.labelled(spark, folder), F.expr(MAJORITY), 0.1, KEYS, 3, md5_draw)
    return sample.select(*KEYS, "label")


@query(_majority_sql("200"))
def majority_of_fixed_size(spark, folder):
    sample = sampling.sample_majority(p.labelled(spark, folder), F.expr(MAJORITY), 200, KEYS, 3, md5_draw)
    return sample.select(*KEYS, "label")


@query(DRAWN + "SELECT cust, period, label FROM drawn WHERE label IN ('BAJA+1', 'BAJA+2') OR draw <= 0.05::DOUBLE")
def undersampled_by_draw(spark, folder):
    keep = F.col("label").isin("BAJA+1", "BAJA+2")
    return sampling.undersample_by_draw(p.labelled(spark, folder), keep, 0.05, KEYS, 3, md5_draw).select(*KEYS, "label")


@query(
    DRAWN + """SELECT cust, period, label, [1, 1, 1, 1, 1, 1, 1, 2, 2, 2][1 + (n - 1) % 10] AS fold,
        CAST(1 + (n - 1) % 5 AS INTEGER) AS fold5 FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY draw, cust, period) AS n FROM drawn
    )"""
)
def stratified_folds(spark, folder):
    panel = p.labelled(spark, folder).select(*KEYS, "label")
    folds = sampling.stratified_fold(panel, (7, 3), ["label"], KEYS, 3, draw=md5_draw)
    return sampling.stratified_fold(
        folds, (1, 1, 1, 1, 1), ["label"], KEYS, 3, name="fold5", draw=md5_draw, rows_per_task=500
    )


@query(SPLITS + "SELECT cust, period, label, repeat, is_public FROM splits")
def repeated_stratified_splits(spark, folder):
    known = p.labelled(spark, folder).where(F.col("label").isNotNull())
    return sampling.repeated_splits(known, REPEATS, 0.3, ["label"], KEYS, seed=5, draw=md5_draw)


@query(
    p.DAY + f"""SELECT {', '.join(f"round({sql_draw(str(11 + i), 'cust', 'period')}, 9) AS canarito_{i}" for i in (1, 2, 3))},
        cust, period, m_total FROM panel_day"""
)
def canary_columns(spark, folder):
    panel = p.panel_day(spark, folder).select(*KEYS, "m_total")
    names = [f"canarito_{i}" for i in (1, 2, 3)]
    return rounded(sampling.add_canaries(panel, 3, KEYS, seed=11, draw=md5_draw), names, 9)


@query(
    p.DAY + f""", by_key AS (SELECT cust, period, row_number() OVER (ORDER BY cust, period) AS n FROM panel_day),
    by_draw AS (
        SELECT m_total AS canarito_m_total, m_net AS canarito_m_net,
               row_number() OVER (ORDER BY {sql_draw('4', 'cust', 'period')}, cust, period) AS n FROM panel_day
    )
    SELECT cust, period, canarito_m_total, canarito_m_net FROM by_key JOIN by_draw USING (n)"""
)
def rows_shuffled_together(spark, folder):
    panel = p.panel_day(spark, folder)
    mixed = sampling.shuffle_together(panel, ["m_total", "m_net"], KEYS, 4, draw=md5_draw)
    return mixed.select(*KEYS, "canarito_m_total", "canarito_m_net")


def _mixed_sql(i, c):
    return f"""mixed{i} AS (
        SELECT CAST({c} AS DOUBLE) AS {c},
               row_number() OVER (ORDER BY {DRAW.format(text=f"cust || '|' || period || '|{i}|4'")}, cust, period) AS n
        FROM panel_day
    )"""


@query(
    p.DAY + f""", by_key AS (SELECT cust, period, row_number() OVER (ORDER BY cust, period) AS n FROM panel_day),
    {_mixed_sql(0, 'm_total')}, {_mixed_sql(1, 'c_click')}
    SELECT cust, period, m_total, CAST(c_click AS DOUBLE) AS c_click, 1 AS real FROM panel_day
    UNION ALL SELECT cust, period, m_total, c_click, 0 FROM by_key JOIN mixed0 USING (n) JOIN mixed1 USING (n)"""
)
def real_and_shuffled_rows(spark, folder):
    return sampling.contrast_set(p.panel_day(spark, folder), ["m_total", "c_click"], KEYS, 4, md5_draw)


@query(
    p.DAY + """SELECT CASE WHEN period < 20 THEN 'train' WHEN period < 25 THEN 'validation' ELSE 'test' END AS part,
        period, CASE period WHEN 3 THEN 0.5::DOUBLE WHEN 7 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w_train, cust
    FROM panel_day"""
)
def split_by_period(spark, folder):
    weighted = sampling.period_weights(p.panel_day(spark, folder), {3: 0.5, 7: 2.0})
    last = weighted.agg(F.max("period")).first()[0]
    parts = {"train": range(20), "validation": range(20, 25), "test": range(25, (last or 0) + 1)}
    sides = sampling.period_split(weighted, {n: list(v) for n, v in parts.items()})
    frames = [side.select(F.lit(n).alias("part"), "period", "w_train", "cust") for n, side in sides.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    p.LABELS + """SELECT cust, period, CASE label WHEN 'BAJA+2' THEN 1.00002::DOUBLE WHEN 'BAJA+1' THEN 1.00001::DOUBLE
        ELSE 1.0::DOUBLE END AS weight FROM labelled"""
)
def class_weights(spark, folder):
    return p.labelled(spark, folder).select(*KEYS, sampling.class_weight(F.col("label")).alias("weight"))


@query()
def default_draw_spread(spark, folder):
    """Rows per tenth of the default draw; no oracle, since the hash is Spark's own."""
    drawn = p.panel_day(spark, folder).select(draw(KEYS, 1).alias("draw"))
    return drawn.groupBy(F.floor(F.col("draw") * 10).alias("tenth")).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("draw")).alias("mean")
    )
