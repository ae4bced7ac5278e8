"""History features per customer, ranks inside a period and features inside a row."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import clip, scale_outliers
from tidemark.operators import features, ranks, windows
from tidemark.operators.columns import matching
from tidemark.operators.quality import z_score
from tidemark.plans import panels as p
from tidemark.plans.registry import query, r, rounded

W = "WINDOW w AS (PARTITION BY cust ORDER BY period)"
HISTORY = ["m_total", "c_click"]


@query(
    p.DAY + f"""SELECT cust, period, {', '.join(f'{c}_lag{k}' for c in HISTORY for k in (1, 2, 6, 12))},
        {', '.join(f'round({c} - {c}_lag{k}, 4) AS {c}_delta{k}' for c in HISTORY for k in (1, 2, 6, 12))}
    FROM (SELECT *, {', '.join(f'lag({c}, {k}) OVER w AS {c}_lag{k}' for c in HISTORY for k in (1, 2, 6, 12))}
          FROM panel_day {W})"""
)
def lags_and_deltas(spark, folder):
    lags = (1, 2, 6, 12)
    made = windows.add_deltas(windows.add_lags(p.panel_day(spark, folder), HISTORY, lags), [*HISTORY, "gone"], lags)
    deltas = matching(made, "_delta")
    return rounded(made.select("cust", "period", *matching(made, "_lag"), *deltas), deltas, 4)


@query(
    p.DAY + f"""SELECT cust, period, {', '.join(f'{f}({c}) OVER w6 AS {c}_{f}6' for c in HISTORY for f in ('min', 'max'))},
        {', '.join(f'round(avg({c}) OVER w6, 6) AS {c}_avg6, round({c} / nullif(avg({c}) OVER w6, 0), 6) AS {c}_ratioavg6'
                   for c in HISTORY)}
    FROM panel_day WINDOW w6 AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""
)
def rolling_and_ratio(spark, folder):
    made = windows.add_ratio_avg(windows.add_rolling(p.panel_day(spark, folder), HISTORY, 6), HISTORY, 6)
    picked = matching(made, "6$")
    return rounded(made.select("cust", "period", *picked), matching(made, "avg6$"))


@query(
    p.DAY + """SELECT cust, period, round(avg(m_total) OVER f, 6) AS avg4, max(m_total) OVER f AS max4,
        min(m_total) OVER f AS min4, count(*) OVER f AS rows4
    FROM panel_day WINDOW f AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""
)
def named_window_frames(spark, folder):
    return spark.sql(
        """SELECT cust, period, round(avg(m_total) OVER f, 6) AS avg4, max(m_total) OVER f AS max4,
                  min(m_total) OVER f AS min4, count(*) OVER f AS rows4
        FROM {panel} WINDOW f AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
        panel=p.panel_day(spark, folder),
    )


def _slope(y, x, frame, digits=6):
    return f"CASE WHEN regr_count({y}, {x}) OVER {frame} > 1 THEN round(regr_slope({y}, {x}) OVER {frame}, {digits}) END"


@query(
    p.DAY + f"""SELECT cust, period, {_slope('m_total', 'tenure', 'f3')} AS m_total_trend_3m,
        {_slope('c_click', 'tenure', 'f3')} AS c_click_trend_3m, {_slope('m_total', 'tenure', 'f6')} AS m_total_trend_6m
    FROM panel_day
    WINDOW f3 AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
           f6 AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
)
def trends(spark, folder):
    made = windows.add_trend(p.panel_day(spark, folder), HISTORY, 3)
    made = windows.add_trend(made, ["m_total"], 6)
    picked = matching(made, "_trend_")
    return rounded(made.select("cust", "period", *picked), picked)


def _history_sql(c):
    known = f"count({c}) OVER f > 1"
    return f"""CASE WHEN {known} THEN round(regr_slope({c}, place) OVER f, 6) END AS {c}_tend6,
        CASE WHEN {known} THEN min({c}) OVER f END AS {c}_min6, CASE WHEN {known} THEN max({c}) OVER f END AS {c}_max6,
        CASE WHEN {known} THEN round(avg({c}) OVER f, 6) END AS {c}_avg6,
        CASE WHEN {known} THEN round({c} / nullif(avg({c}) OVER f, 0), 6) END AS {c}_ratioavg6,
        CASE WHEN {known} THEN round({c} / nullif(max({c}) OVER f, 0), 6) END AS {c}_ratiomax6"""


@query(
    p.DAY + f"""SELECT cust, period, {', '.join(map(_history_sql, HISTORY))}
    FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY period) AS place FROM panel_day)
    WINDOW f AS (PARTITION BY cust ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""
)
def history_of_six(spark, folder):
    made = windows.add_history(p.panel_day(spark, folder), HISTORY, 6)
    picked = matching(made, "6$")
    return rounded(made.select("cust", "period", *picked), matching(made, "(tend|avg|ratioavg|ratiomax)6$"))


@query(
    p.DAY + """SELECT cust, period, CAST(row_number() OVER t AS INTEGER) AS tenure_row_number,
        round(percent_rank() OVER v, 9) AS tenure_percent_rank, round(cume_dist() OVER v, 9) AS tenure_cume_dist,
        CAST(ntile(4) OVER t AS INTEGER) AS tenure_tile4, CAST(ntile(10) OVER t AS INTEGER) AS tenure_tile10,
        CAST(row_number() OVER (PARTITION BY cust ORDER BY period) AS INTEGER) AS tenure_again
    FROM panel_day WINDOW t AS (PARTITION BY period ORDER BY tenure NULLS LAST, cust),
                          v AS (PARTITION BY period ORDER BY tenure NULLS LAST)"""
)
def tenure_ranks(spark, folder):
    made = ranks.add_group_ranks(p.panel_day(spark, folder), "tenure", ["period"], ["cust"])
    made = made.withColumn("tenure_again", F.row_number().over(Window.partitionBy("cust").orderBy("period")))
    picked = made.select("cust", "period", *matching(made, "^tenure_"))
    return rounded(picked, ["tenure_percent_rank", "tenure_cume_dist"], 9)


def _signed_rank_sql(c):
    def share(condition, size):
        return (
            f"(rank() OVER (PARTITION BY period, {condition} ORDER BY {size}) + "
            f"(count(*) OVER (PARTITION BY period, {condition}, {size}) - 1) / 2) / "
            f"count(*) OVER (PARTITION BY period, {condition})"
        )

    positive, negative = share(f"{c} > 0", c), share(f"{c} < 0", f"abs({c})")
    return (
        f"round(CASE WHEN {c} IS NULL THEN NULL WHEN {c} = 0 THEN 0.0::DOUBLE WHEN {c} > 0 THEN {positive} "
        f"ELSE -({negative}) END, 9) AS {c}"
    )


@query(p.DAY + f"SELECT cust, period, {', '.join(map(_signed_rank_sql, ['m_net', 'm_total', 'c_view']))} FROM panel_day")
def signed_ranks(spark, folder):
    columns = ["m_net", "m_total", "c_view"]
    made = ranks.signed_rank(p.panel_day(spark, folder), columns, ["period"], ["cust"])
    return rounded(made.select("cust", "period", *columns), columns, 9)


@query(
    p.DAY + """SELECT cust, period, round((m_total - avg(m_total) OVER w) / nullif(stddev_samp(m_total) OVER w, 0), 6) AS z,
        round(ln(m_total + 1), 9) AS log_total, CASE WHEN m_total > 100 THEN m_total * 1000 ELSE m_total END AS stretched,
        CASE WHEN m_net > 50 THEN 1.0::DOUBLE WHEN m_net < 0 THEN 0.0::DOUBLE ELSE m_net / 50 END AS clipped,
        round(exp(m_net / 1000) + pow(2, n_events), 6) AS grown, CAST(sign(m_net) AS INTEGER) AS direction
    FROM panel_day WINDOW w AS (PARTITION BY period)"""
)
def scaled_values(spark, folder):
    made = z_score(p.panel_day(spark, folder), "m_total", ["period"], "z")
    return made.select(
        "cust",
        "period",
        r("z").alias("z"),
        r(F.log1p("m_total"), 9).alias("log_total"),
        scale_outliers(F.col("m_total"), 100, 1000).alias("stretched"),
        clip(F.col("m_net") / 50).alias("clipped"),
        r(F.exp(F.col("m_net") / 1000) + F.pow(F.lit(2.0), "n_events")).alias("grown"),
        F.signum("m_net").cast("int").alias("direction"),
    )


# --- a bank panel from orders and lines ----------------------------------------------------------------------------

MEASURES = {
    "cash": "round(sum({on} * l_extendedprice * l_discount), 4)",
    "debt": "round(sum({on} * l_extendedprice), 2)",
    "limit": "sum({on} * l_quantity * 1000)",
    "least": "round(sum({on} * l_quantity * l_tax), 2)",
    "count": "CAST(sum({on} * l_linenumber) AS DOUBLE)",
}
MEASURE_OF = {
    "mpagado": "cash", "mpagospesos": "cash", "mpagosdolares": "cash", "mpagominimo": "least", "mlimitecompra": "limit",
    "mfinanciacion_limite": "limit", "delinquency": "count", "status": "count", "cconsumos": "count",
    "cadelantosefectivo": "count",
}
CARDS = {"Master_": "R", "Visa_": "A"}


def _bank_panel(lines: str) -> str:
    """One SQL text for both engines: months 20 years later, one card per return flag, NULL without lines."""
    sums = ", ".join(
        f"{text.format(on=f'(CASE WHEN l_returnflag = {flag!r} THEN 1 END)')} AS {card}{measure}"
        for card, flag in CARDS.items()
        for measure, text in MEASURES.items()
    )
    attributes = ", ".join(
        f"{card}{MEASURE_OF.get(a, 'debt')} AS {card}{a}" for card in CARDS for a in features.CARD_ATTRIBUTES
    )
    return f"""
    SELECT numero_de_cliente, foto_mes, mpayroll, cpayroll_trx, cliente_edad, {attributes},
           CAST(Master_count AS BIGINT) AS cinversion1, CAST(Visa_count AS BIGINT) AS cinversion2,
           Master_cash AS minversion1_pesos, Visa_cash AS minversion2
    FROM (
        SELECT o_custkey AS numero_de_cliente,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) + 2000 AS INTEGER) AS foto_mes,
               round(sum(total), 2) AS mpayroll, count(*) AS cpayroll_trx, CAST(o_custkey % 60 AS INTEGER) AS cliente_edad,
               {', '.join(f'round(sum({card}{m}), 4) AS {card}{m}' for card in CARDS for m in MEASURES)}
        FROM (
            SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice AS total, l.*
            FROM {{orders}} o LEFT JOIN (SELECT l_orderkey, {sums} FROM {lines} GROUP BY l_orderkey) l
            ON o_orderkey = l_orderkey
        ) GROUP BY o_custkey, year(o_orderdate) * 100 + month(o_orderdate)
    )"""


BANK = "WITH bank AS (" + _bank_panel("lineitem").replace("{orders}", "orders") + ")"
BANK_KEYS = ["numero_de_cliente", "foto_mes"]


def bank_panel(spark, folder):
    tables = {t: p.table(spark, folder, t) for t in ("orders", "lineitem")}
    return spark.sql(_bank_panel("{lineitem}"), **tables)


def _cards_sql():
    sums = ", ".join(
        f"coalesce(Master_{a}, 0) + coalesce(Visa_{a}, 0) AS tc_{a}" for a in features.CARD_ATTRIBUTES
    )
    return BANK + f""", added AS (SELECT *, {sums} FROM bank)
    SELECT numero_de_cliente, foto_mes, {', '.join(f'tc_{a}' for a in features.CARD_ATTRIBUTES)},
        CAST(foto_mes % 100 AS INTEGER) AS kmes, mpayroll / nullif(cliente_edad, 0) AS mpayroll_sobre_edad,
        tc_mpagado / nullif(tc_msaldopesos, 0) AS tc_porc_pagos_saldo,
        tc_msaldototal / nullif(tc_mlimitecompra, 0) AS tc_porc_utilizacion,
        tc_mpagado / nullif(tc_mpagominimo, 0) AS tc_porc_pago_pagominimo,
        tc_mpagominimo / nullif(tc_mlimitecompra, 0) AS tc_porc_pagominimo_saldo,
        CASE WHEN tc_mpagado < tc_mpagominimo THEN 1 ELSE 0 END AS tc_flag_pago_pagominimo FROM added"""


@query(_cards_sql())
def intra_month_card_features(spark, folder):
    made = features.intra_month_features(bank_panel(spark, folder))
    sums = [f"tc_{a}" for a in features.CARD_ATTRIBUTES]
    ratios = ["mpayroll_sobre_edad", "tc_porc_pagos_saldo", "tc_porc_utilizacion", "tc_porc_pago_pagominimo"]
    return made.select(*BANK_KEYS, "kmes", *sums, *ratios, "tc_porc_pagominimo_saldo", "tc_flag_pago_pagominimo")


@query(
    BANK + """SELECT numero_de_cliente, foto_mes, Visa_msaldototal / nullif(Visa_mlimitecompra, 0) AS Visa_putilizacion,
        Visa_mpagado / nullif(Visa_msaldototal, 0) AS Visa_ppagos,
        Visa_mpagado / nullif(Visa_mpagominimo, 0) AS Visa_ppagomin, cinversion1 + cinversion2 AS cinversion,
        round(minversion1_pesos + minversion2, 4) AS minversion_pesos,
        CASE cpayroll_trx WHEN 1 THEN cliente_edad * 5.0::DOUBLE WHEN 2 THEN cliente_edad * 2.0::DOUBLE
            WHEN 3 THEN round(cliente_edad * 1.2::DOUBLE, 6) ELSE cliente_edad END AS normalised FROM bank"""
)
def card_portfolio_ratios(spark, folder):
    made = features.card_portfolio(bank_panel(spark, folder)).withColumn(
        "normalised", r(features.tenure_normalised(F.col("cliente_edad"), F.col("cpayroll_trx")))
    )
    ratios = ["Visa_putilizacion", "Visa_ppagos", "Visa_ppagomin"]
    picked = made.select(*BANK_KEYS, *ratios, "cinversion", "minversion_pesos", "normalised")
    return rounded(picked, ["minversion_pesos"], 4)


INFLATION_SQL = ", ".join(f"({m}, {rate}::DOUBLE)" for m, rate in sorted(features.MONTHLY_INFLATION.items()))


@query(
    BANK + f""", rates(foto_mes, inflacion) AS (VALUES {INFLATION_SQL}),
    grown AS (SELECT foto_mes, 1 / product(1 + inflacion / 100) OVER (ORDER BY foto_mes) AS factor FROM rates),
    factors AS (
        SELECT foto_mes, CASE WHEN foto_mes = 201901 THEN 1 ELSE lag(factor) OVER (ORDER BY foto_mes) END AS factor FROM grown
    )
    SELECT numero_de_cliente, foto_mes, round(mpayroll * factor, 4) AS mpayroll,
        round(Visa_msaldototal * factor, 4) AS Visa_msaldototal FROM bank LEFT JOIN factors USING (foto_mes)"""
)
def deflated_money(spark, folder):
    money = ["mpayroll", "Visa_msaldototal"]
    made = features.deflate(bank_panel(spark, folder), money)
    return rounded(made.select(*BANK_KEYS, *money), money, 4)


BONUS_SQL = BANK + """, placed AS (
    SELECT *, row_number() OVER (PARTITION BY numero_de_cliente ORDER BY foto_mes) AS place,
        list_contains([201906, 201912, 202006, 202012, 202106], foto_mes) AS listed,
        least(foto_mes, 202106) // 100 * 2 + (least(foto_mes, 202106) % 100 > 6)::INT AS half FROM bank
), rises AS (
    SELECT now.numero_de_cliente, now.half, now.mpayroll - one.mpayroll AS rise,
        if(now.cpayroll_trx > one.cpayroll_trx, one.cpayroll_trx, NULL) AS earlier_count
    FROM placed now JOIN placed one ON one.numero_de_cliente = now.numero_de_cliente AND one.place = now.place - 1
    JOIN placed two ON two.numero_de_cliente = now.numero_de_cliente AND two.place = now.place - 2
    WHERE now.listed AND now.mpayroll / one.mpayroll >= 1.3 AND now.mpayroll / two.mpayroll >= 1.3
)
SELECT numero_de_cliente, foto_mes, round(mpayroll - if(listed, coalesce(rise, 0), 0) + coalesce(rise, 0) / 6, 4) AS mpayroll,
    if(listed AND rise IS NOT NULL, earlier_count, cpayroll_trx) AS cpayroll_trx
FROM placed LEFT JOIN rises USING (numero_de_cliente, half)"""


@query(BONUS_SQL)
def spread_bonus_pay(spark, folder):
    made = features.spread_bonus(bank_panel(spark, folder))
    return rounded(made.select(*BANK_KEYS, "mpayroll", "cpayroll_trx"), ["mpayroll"], 4)


@query(
    p.DAY + """SELECT count(*) AS n_rows,
        (SELECT count(*) FROM (SELECT 1 FROM panel_day GROUP BY cust, period HAVING count(*) > 1)) AS repeated_keys,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM panel_day GROUP BY cust)) AS largest_customer,
        count(DISTINCT period) AS periods FROM panel_day"""
)
def panel_key_check(spark, folder):
    return windows.check_panel_key(p.panel_day(spark, folder))
