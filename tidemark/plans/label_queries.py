"""Churn labels and histories aligned on the churn date."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import month_end, month_index, month_start, months_between_dates, period_of
from tidemark.operators import labels, stats
from tidemark.operators.windows import add_leads
from tidemark.plans import panels as p
from tidemark.plans.registry import query, r

CLASSES = [labels.GONE_NEXT, labels.GONE_AFTER_NEXT, labels.STAYS]


@query(
    p.LABELS + """SELECT period, count(*) FILTER (WHERE label = 'BAJA+1') AS "BAJA+1",
        count(*) FILTER (WHERE label = 'BAJA+2') AS "BAJA+2", count(*) FILTER (WHERE label = 'CONTINUA') AS "CONTINUA"
    FROM labelled GROUP BY period"""
)
def classes_per_period(spark, folder):
    counts = p.labelled(spark, folder).groupBy("period").pivot("label", CLASSES).count()
    return counts.fillna(0, CLASSES)


@query(p.LABELS + "SELECT cust, period, label FROM labelled")
def churn_label_gap(spark, folder):
    return p.labelled(spark, folder).select("cust", "period", "label")


HELD_MONTHS = p.MONTH + """, numbered AS (SELECT *, foto_mes // 100 * 12 + foto_mes % 100 AS m FROM panel_month),
held AS (SELECT cust, list(m) AS months FROM numbered GROUP BY cust), edge AS (SELECT max(m) AS final FROM numbered)
"""


@query(
    HELD_MONTHS + """SELECT cust, foto_mes, if(m >= final - 1 AND NOT list_contains(months, m + 2) OR m = final, NULL,
        if(list_contains(months, m + 1), if(list_contains(months, m + 2), 'CONTINUA', 'BAJA+2'), 'BAJA+1')) AS label
    FROM numbered JOIN held USING (cust), edge"""
)
def churn_label_calendar(spark, folder):
    panel = p.panel_month(spark, folder)
    labelled = labels.churn_label_join(panel, index=month_index(F.col("foto_mes")))
    return labelled.select("cust", "foto_mes", "label")


@query(
    HELD_MONTHS + """, seen AS (
        SELECT cust, foto_mes, m, list_filter(months, lambda x: x > m) AS later, len(months) AS held_months
        FROM numbered JOIN held USING (cust), edge WHERE m + 2 <= final
    )
    SELECT cust, foto_mes,
        CAST(if(len(later) = 0, NULL, held_months - len(later) + 1) AS INTEGER) AS min_later_tenure,
        CAST(list_max(list_filter(later, lambda x: x <= m + 2)) AS INTEGER) AS last_within_two,
        ['BAJA+1', 'BAJA+2', 'CONTINUA'][1 + (len(later) > 0)::INT + coalesce(list_max(later) > m + 1, false)::INT] AS label
    FROM seen"""
)
def churn_label_never_back(spark, folder):
    from pyspark.sql import Window

    tenure = F.row_number().over(Window.partitionBy("cust").orderBy("foto_mes"))
    panel = p.panel_month(spark, folder).withColumn("tenure", tenure)
    labelled = labels.churn_label_final(panel, index=month_index(F.col("foto_mes")))
    return labelled.select("cust", "foto_mes", "min_later_tenure", "last_within_two", "label")


@query(
    p.DAY + """, span AS (SELECT list_sort(list(DISTINCT period)) AS every FROM panel_day),
    own AS (SELECT cust, list(period) AS mine FROM panel_day GROUP BY cust),
    placed AS (SELECT cust, period, mine, every, list_position(every, period) AS k FROM panel_day JOIN own USING (cust), span)
    SELECT DISTINCT cust, period, 1 AS present_0,
        if(k + 1 > len(every), NULL, list_contains(mine, every[k + 1])::INT) AS present_1,
        if(k + 2 > len(every), NULL, list_contains(mine, every[k + 2])::INT) AS present_2 FROM placed"""
)
def churn_flags_on_lattice(spark, folder):
    ahead = labels.presence_ahead(p.panel_day(spark, folder))
    return ahead.select("cust", "period", "present_0", "present_1", "present_2")


@query(
    p.LABELS + """SELECT cust, period, CAST(label = 'BAJA+2' AS TINYINT) AS target_test,
        CAST(label IN ('BAJA+1', 'BAJA+2') AS TINYINT) AS target FROM labelled"""
)
def binary_targets(spark, folder):
    return labels.binarize_label(p.labelled(spark, folder)).select("cust", "period", "target_test", "target")


@query(
    p.DAY + """SELECT cust, period, lead(period, 1) OVER w AS period_lead1, lead(period, 2) OVER w AS period_lead2
    FROM panel_day WINDOW w AS (PARTITION BY cust ORDER BY period)"""
)
def next_rows(spark, folder):
    led = add_leads(p.panel_day(spark, folder), ["period"], (1, 2))
    return led.select("cust", "period", "period_lead1", "period_lead2")


MONTH_ENDS = p.MONTH + """, dated AS (
    SELECT *, last_day(make_date(foto_mes // 100, foto_mes % 100, 1)) AS ends FROM panel_month
)
"""


@query(
    MONTH_ENDS + """SELECT foto_mes, CAST((foto_mes // 100) * 12 + foto_mes % 100 AS INTEGER) AS month_no, ends,
        make_date(foto_mes // 100, foto_mes % 100, 1) AS starts, CAST(foto_mes % 100 AS INTEGER) AS kmes,
        CAST(year(ends) * 100 + month(ends) AS INTEGER) AS again,
        CAST(strftime(CAST(last_day(ends + INTERVAL 2 MONTH) AS DATE), '%Y%m') AS INTEGER) AS two_later,
        CAST((2001 - year(ends)) * 12 + (8 - month(ends)) AS INTEGER) AS months_left, count(*) AS n
    FROM dated GROUP BY ALL"""
)
def month_arithmetic(spark, folder):
    period = F.col("foto_mes")
    ends = month_end(period)
    return (
        p.panel_month(spark, folder)
        .select(
            period,
            month_index(period).alias("month_no"),
            ends.alias("ends"),
            month_start(period).alias("starts"),
            (period % 100).cast("int").alias("kmes"),
            period_of(ends).alias("again"),
            period_of(F.last_day(F.add_months(ends, 2))).alias("two_later"),
            months_between_dates(F.lit("2001-08-31").cast("date"), ends).alias("months_left"),
        )
        .groupBy("foto_mes", "month_no", "ends", "starts", "kmes", "again", "two_later", "months_left")
        .agg(F.count(F.lit(1)).alias("n"))
    )


HISTORY_SQL = p.LABELS + """, history AS (
    SELECT *, gone - period AS periods_until_churn FROM (
        SELECT *, max(CASE WHEN label = 'BAJA+2' THEN period END) OVER (PARTITION BY cust) + 2 AS gone,
               max(period) OVER (PARTITION BY cust) AS seen, max(period) OVER () AS last FROM labelled
    ) WHERE gone IS NOT NULL AND seen < gone AND period < last
)
"""


@query(HISTORY_SQL + "SELECT cust, period, m_total, periods_until_churn FROM history")
def churn_aligned_history(spark, folder):
    history = stats.churn_history(p.labelled(spark, folder))
    return history.select("cust", "period", "m_total", "periods_until_churn")


@query(
    HISTORY_SQL + """SELECT periods_until_churn, CASE WHEN n_events > 2 THEN 'busy' ELSE 'calm' END AS kind,
        round(avg(m_total), 6) AS m_total, round(avg(c_click), 6) AS c_click FROM history GROUP BY ALL"""
)
def evolution_until_churn(spark, folder):
    history = stats.churn_history(p.labelled(spark, folder)).withColumn(
        "kind", F.when(F.col("n_events") > 2, "busy").otherwise("calm")
    )
    means = stats.group_evolution(history, ["m_total", "c_click"], ["kind"])
    return means.select("periods_until_churn", "kind", r("m_total").alias("m_total"), r("c_click").alias("c_click"))
