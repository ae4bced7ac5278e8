"""The panels and score tables the queries run on, made from the given tables; and the same in SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import period_of
from tidemark.operators.labels import churn_label

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
COUNTS = [f"c_{t}" for t in EVENT_TYPES]
DAY_VALUES = ["n_events", "m_total", "m_avg", "m_max", "m_net", *COUNTS]
MODELS = ("a", "b", "c")

PANEL_DAY_SQL = """
panel_day AS (
    SELECT cust, period, n_events, m_total, m_total / n_events AS m_avg, m_max, m_net,
           nullif(c_click, 0) AS c_click, nullif(c_error, 0) AS c_error, nullif(c_purchase, 0) AS c_purchase,
           nullif(c_signup, 0) AS c_signup, nullif(c_view, 0) AS c_view,
           CAST(row_number() OVER (PARTITION BY cust ORDER BY period) AS INTEGER) AS tenure
    FROM (
        SELECT user_id AS cust, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
               count(*) AS n_events, round(sum(value), 2) AS m_total, max(value) AS m_max,
               round(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN value
                              WHEN event_type = 'error' THEN -value ELSE 0 END), 2) AS m_net,
               count(*) FILTER (WHERE event_type = 'click') AS c_click,
               count(*) FILTER (WHERE event_type = 'error') AS c_error,
               count(*) FILTER (WHERE event_type = 'purchase') AS c_purchase,
               count(*) FILTER (WHERE event_type = 'signup') AS c_signup,
               count(*) FILTER (WHERE event_type = 'view') AS c_view
        FROM events GROUP BY ALL
    )
)
"""

PANEL_MONTH_SQL = """
panel_month AS (
    SELECT o_custkey AS cust, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS foto_mes,
           count(*) AS n_orders, round(sum(o_totalprice), 2) AS m_price, round(sum(disc), 4) AS m_disc,
           CAST(sum(lines) AS BIGINT) AS c_lines
    FROM orders LEFT JOIN (
        SELECT l_orderkey, sum(l_extendedprice * l_discount) AS disc, count(*) AS lines FROM lineitem GROUP BY ALL
    ) ON o_orderkey = l_orderkey
    GROUP BY ALL
)
"""

LABELLED_SQL = """
labelled AS (
    SELECT * EXCLUDE (i1, i2, last),
           CASE WHEN period < last AND (i1 IS NULL OR i1 > period + 1) THEN 'BAJA+1'
                WHEN period < last - 1 AND i1 = period + 1 AND (i2 IS NULL OR i2 > period + 2) THEN 'BAJA+2'
                WHEN period < last - 1 THEN 'CONTINUA' END AS label
    FROM (
        SELECT *, lead(period, 1) OVER (PARTITION BY cust ORDER BY period) AS i1,
               lead(period, 2) OVER (PARTITION BY cust ORDER BY period) AS i2, max(period) OVER () AS last
        FROM panel_day
    )
)
"""

SCORES_SQL = """
scores AS (
    SELECT cust, period, label, model,
           round(((cust * 7919 + period * 104729 + number * 15485863) % 10007) / 10007.0::DOUBLE, 2) AS prob
    FROM labelled CROSS JOIN (VALUES ('a', 1), ('b', 2), ('c', 3)) AS m(model, number)
    WHERE label IS NOT NULL
)
"""

DAY = "WITH " + PANEL_DAY_SQL
MONTH = "WITH " + PANEL_MONTH_SQL
LABELS = DAY + "," + LABELLED_SQL
SCORES = LABELS + "," + SCORES_SQL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def panel_day(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user and day with events. A hot user's events are counted before the shuffle."""
    is_type = {t: F.col("event_type") == t for t in EVENT_TYPES}
    signed = F.when(is_type["purchase"] | is_type["signup"], F.col("value")).when(is_type["error"], -F.col("value"))
    per_day = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("cust"), F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("period"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.round(F.sum("value"), 2).alias("m_total"),
            F.max("value").alias("m_max"),
            F.round(F.sum(signed.otherwise(0.0)), 2).alias("m_net"),
            *[F.nullif(F.count_if(is_type[t]), F.lit(0).cast("long")).alias(f"c_{t}") for t in EVENT_TYPES],
        )
    )
    rows = Window.partitionBy("cust").orderBy("period")
    return per_day.select(
        "cust",
        "period",
        "n_events",
        "m_total",
        (F.col("m_total") / F.col("n_events")).alias("m_avg"),
        "m_max",
        "m_net",
        *COUNTS,
        F.row_number().over(rows).alias("tenure"),
    )


def panel_month(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and month with orders. Lines are summed per order before the join."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"), F.count(F.lit(1)).alias("lines"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy(F.col("o_custkey").alias("cust"), period_of(F.col("o_orderdate")).alias("foto_mes"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.round(F.sum("o_totalprice"), 2).alias("m_price"),
            F.round(F.sum("disc"), 4).alias("m_disc"),
            F.sum("lines").alias("c_lines"),
        )
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return churn_label(panel_day(spark, folder))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three models' scores of every labelled row: an arithmetic hash, rounded so that ties occur."""
    mixed = F.col("cust") * 7919 + F.col("period") * 104729 + F.col("number") * 15485863
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("number")) for i, m in enumerate(MODELS, 1)])
    return (
        labelled(spark, folder)
        .where(F.col("label").isNotNull())
        .select("cust", "period", "label", F.inline(models))
        .select("cust", "period", "label", "model", F.round((mixed % 10007) / 10007, 2).alias("prob"))
    )
