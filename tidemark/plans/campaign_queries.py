"""The whole way from a raw panel to a contact list: the features with SQL for all steps, the contacts as rows only."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import features, models
from tidemark.plans.campaign import FeatureOptions, build_features, choose_contacts
from tidemark.plans.registry import query, rounded
from tidemark.plans.window_queries import BANK, BANK_KEYS, INFLATION_SQL, bank_panel
from tidemark.session import cut_lineage

MONEY = ("mpayroll", "mpayroll_sobre_edad", "Visa_msaldototal")
ENDINGS = ("", "_trend_3m", "_min6", "_max6", "_lag1", "_lag2", "_delta1", "_delta2")
BONUS_LIST = ", ".join(map(str, features.BONUS_MONTHS))


def _flat(column):
    return f"count({column}) OVER month > 1 AND min({column}) OVER month = max({column}) OVER month"


def _history(column):
    return f"""CASE WHEN regr_count({column}, cliente_antiguedad) OVER four > 1
            THEN regr_slope({column}, cliente_antiguedad) OVER four END AS {column}_trend_3m,
        min({column}) OVER six AS {column}_min6, max({column}) OVER six AS {column}_max6,
        lag({column}, 1) OVER own AS {column}_lag1, {column} - lag({column}, 1) OVER own AS {column}_delta1,
        lag({column}, 2) OVER own AS {column}_lag2, {column} - lag({column}, 2) OVER own AS {column}_delta2"""


CAMPAIGN_SQL = BANK + f""", raw AS (
    SELECT numero_de_cliente AS who, foto_mes, mpayroll, cliente_edad, Visa_msaldototal, foto_mes // 100 * 12 + foto_mes % 100 AS m,
        row_number() OVER (PARTITION BY numero_de_cliente ORDER BY foto_mes) AS cliente_antiguedad FROM bank
), held AS (SELECT who, list(m) AS months FROM raw GROUP BY who), edge AS (SELECT max(m) AS final FROM raw),
labelled AS (
    SELECT raw.*, if(m = final OR m = final - 1 AND NOT list_contains(months, m + 2), NULL,
        if(NOT list_contains(months, m + 1), 'BAJA+1', if(list_contains(months, m + 2), 'CONTINUA', 'BAJA+2'))) AS label
    FROM raw JOIN held USING (who), edge
), halves AS (
    SELECT *, foto_mes IN ({BONUS_LIST}) AS bonus_month, if(foto_mes > {max(features.BONUS_MONTHS)}, {max(features.BONUS_MONTHS)},
        foto_mes // 100 * 100 + if(foto_mes % 100 <= 6, 6, 12)) AS half FROM labelled
), rises AS (
    SELECT now.who, now.half, now.mpayroll - one.mpayroll AS rise FROM halves now
    JOIN raw one ON one.who = now.who AND one.cliente_antiguedad = now.cliente_antiguedad - 1
    JOIN raw two ON two.who = now.who AND two.cliente_antiguedad = now.cliente_antiguedad - 2
    WHERE now.bonus_month AND now.mpayroll / one.mpayroll >= 1.3 AND now.mpayroll / two.mpayroll >= 1.3
), spread AS (
    SELECT halves.* EXCLUDE (mpayroll),
        CASE WHEN rise IS NULL THEN mpayroll WHEN bonus_month THEN mpayroll - rise + rise / 6 ELSE mpayroll + rise / 6 END AS mpayroll
    FROM halves LEFT JOIN rises USING (who, half)
), varied AS (
    SELECT who, foto_mes, label, {', '.join(f'CASE WHEN NOT ({_flat(c)}) THEN {c} END AS {c}'
                                            for c in ('mpayroll', 'cliente_edad', 'Visa_msaldototal', 'cliente_antiguedad'))}
    FROM spread WINDOW month AS (PARTITION BY foto_mes)
), rates(foto_mes, inflacion) AS (VALUES {INFLATION_SQL}),
factors AS (
    SELECT foto_mes, CASE WHEN foto_mes = 201901 THEN 1.0::DOUBLE
        ELSE 1 / product(1 + inflacion / 100) OVER (ORDER BY foto_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS factor FROM rates
), priced AS (
    SELECT who, foto_mes, label, cliente_antiguedad, mpayroll * factor AS mpayroll, Visa_msaldototal * factor AS Visa_msaldototal,
        coalesce(mpayroll, 0) / nullif(cliente_edad, 0) * factor AS mpayroll_sobre_edad FROM varied LEFT JOIN factors USING (foto_mes)
), history AS (
    SELECT *, {', '.join(map(_history, MONEY))} FROM priced
    WINDOW own AS (PARTITION BY who ORDER BY foto_mes),
        four AS (PARTITION BY who ORDER BY foto_mes ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
        six AS (PARTITION BY who ORDER BY foto_mes ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
)
SELECT foto_mes, count(*) AS n, {', '.join(f'round(avg({c}{e}), 4) AS {c}{e}' for c in MONEY for e in ENDINGS)},
    round(avg((label = 'BAJA+2')::INT), 4) AS target_test, round(avg((label IN ('BAJA+1', 'BAJA+2'))::INT), 4) AS target
FROM history GROUP BY foto_mes"""


def raw_panel(spark, folder):
    rows = Window.partitionBy("numero_de_cliente").orderBy("foto_mes")
    return bank_panel(spark, folder).withColumn("cliente_antiguedad", F.row_number().over(rows))


@query(CAMPAIGN_SQL)
def campaign_features(spark, folder):
    options = FeatureOptions(trends=(3,), rolling={6: ("min", "max")}, drop_prefixes=("Master_", "tc_c"))
    table = build_features(raw_panel(spark, folder), options)
    means = [F.round(F.avg(c), 4).alias(c) for c in table.columns if c.startswith(("mpayroll", "Visa_msaldototal", "target"))]
    return table.groupBy("foto_mes").agg(F.count(F.lit(1)).alias("n"), *means)


@query()
def campaign_contacts(spark, folder):
    options = FeatureOptions(trends=(), lags=(1,), drop_prefixes=("Master_", "Visa_", "tc_"))
    table = cut_lineage(build_features(raw_panel(spark, folder), options))

    def fit(rows, inputs, seed):
        return models.train_forest(rows, inputs, numTrees=10, maxDepth=4, seed=seed)

    months = sorted(row[0] for row in table.select("foto_mes").distinct().collect())  # a few dozen
    train, future = ([m for m in months if (m < 201901) == early] for early in (True, False))
    chosen = choose_contacts(table, train, future, 100, fit, [31, 47])
    return rounded(chosen.select(*BANK_KEYS, "prob", "Predicted"), ["prob"])
