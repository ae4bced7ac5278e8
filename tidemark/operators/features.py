"""Features inside one row, inflation and the twice-yearly bonus payment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import assign_in_order, month_number, safe_ratio, sum_without_null
from tidemark.operators.columns import present
from tidemark.operators.sizes import small_side

# Attributes both cards have, added up as tc_<attribute>.
CARD_ATTRIBUTES = (
    "delinquency",
    "status",
    "mfinanciacion_limite",
    "msaldototal",
    "msaldopesos",
    "msaldodolares",
    "mconsumospesos",
    "mconsumosdolares",
    "mlimitecompra",
    "madelantopesos",
    "madelantodolares",
    "mpagado",
    "mpagospesos",
    "mpagosdolares",
    "mconsumototal",
    "cconsumos",
    "cadelantosefectivo",
    "mpagominimo",
)

# Monthly inflation in percent.
MONTHLY_INFLATION = {
    201901: 2.9, 201902: 3.8, 201903: 4.7, 201904: 3.4, 201905: 3.1, 201906: 2.7,
    201907: 2.2, 201908: 4.0, 201909: 5.9, 201910: 3.3, 201911: 4.3, 201912: 3.7,
    202001: 2.3, 202002: 2.0, 202003: 3.3, 202004: 1.5, 202005: 1.5, 202006: 2.2,
    202007: 1.9, 202008: 2.7, 202009: 2.8, 202010: 3.8, 202011: 3.2, 202012: 4.0,
    202101: 4.0, 202102: 3.6, 202103: 4.8, 202104: 4.1, 202105: 3.3, 202106: 3.2,
    202107: 3.0, 202108: 2.5, 202109: 3.5,
}

# Months with a bonus payment, and the rise over both earlier rows that shows it.
BONUS_MONTHS = (201906, 201912, 202006, 202012, 202106)
BONUS_RISE = 1.3


def intra_month_features(
    df: DataFrame,
    *,
    period: str = "foto_mes",
    cards: tuple[str, str] = ("Master_", "Visa_"),
    attributes: Sequence[str] = CARD_ATTRIBUTES,
    payroll: str = "mpayroll",
    age: str = "cliente_edad",
) -> DataFrame:
    """Month number, sums over both cards (NULL counts as zero), pay over age, and card ratios.

    A ratio whose divisor is zero is NULL.
    """
    first, second = cards
    sums = {f"tc_{a}": sum_without_null(F.col(first + a), F.col(second + a)) for a in attributes}
    base = df.select(
        "*",
        month_number(F.col(period)).alias("kmes"),
        *[total.alias(name) for name, total in sums.items()],
        safe_ratio(F.coalesce(F.col(payroll), F.lit(0)), F.col(age)).alias("mpayroll_sobre_edad"),
    )
    paid, minimum, limit = F.col("tc_mpagado"), F.col("tc_mpagominimo"), F.col("tc_mlimitecompra")
    return base.select(
        "*",
        safe_ratio(paid, F.col("tc_msaldopesos")).alias("tc_porc_pagos_saldo"),
        safe_ratio(F.col("tc_msaldototal"), limit).alias("tc_porc_utilizacion"),
        safe_ratio(paid, minimum).alias("tc_porc_pago_pagominimo"),
        safe_ratio(minimum, limit).alias("tc_porc_pagominimo_saldo"),
        F.when(paid < minimum, 1).otherwise(0).alias("tc_flag_pago_pagominimo"),
    )


def tenure_normalised(count: Column, tenure: Column) -> Column:
    """Quarterly transactions scaled up for customers younger than a quarter."""
    # Factors for one, two and three months of tenure.
    return assign_in_order(
        count.cast("double"), (tenure == 1, count * 5.0), (tenure == 2, count * 2.0), (tenure == 3, count * 1.2)
    )


def card_portfolio(df: DataFrame, card: str = "Visa_") -> DataFrame:
    """Use of the limit, payments over balance and over the minimum, and the two kinds of investment added up."""
    paid, balance = F.col(f"{card}mpagado"), F.col(f"{card}msaldototal")
    return df.select(
        "*",
        safe_ratio(balance, F.col(f"{card}mlimitecompra")).alias(f"{card}putilizacion"),
        safe_ratio(paid, balance).alias(f"{card}ppagos"),
        safe_ratio(paid, F.col(f"{card}mpagominimo")).alias(f"{card}ppagomin"),
        (F.col("cinversion1") + F.col("cinversion2")).alias("cinversion"),
        (F.col("minversion1_pesos") + F.col("minversion2")).alias("minversion_pesos"),
    )


def inflation_table(spark: SparkSession, rates: Mapping[int, float] | None = None, period: str = "foto_mes") -> DataFrame:
    rates = MONTHLY_INFLATION if rates is None else rates
    return spark.createDataFrame(sorted(rates.items()), f"{period} int, inflation double")


def deflators(inflation: DataFrame, base: int = 201901, period: str = "foto_mes") -> DataFrame:
    """Factor of each month: one over the growth of the earlier months; 1 in the base month.

    The first month has no earlier one, so its factor is NULL unless it is the base. One row per month, so the
    window without a partition holds one row per month too.
    """
    months = Window.orderBy(period)
    growth = F.sum(F.log(1 + F.col("inflation") / 100)).over(months.rowsBetween(Window.unboundedPreceding, -1))
    return inflation.select(
        period, F.when(F.col(period) == base, 1.0).otherwise(F.exp(-growth)).alias("factor")
    )


def deflate(
    df: DataFrame,
    columns: Sequence[str],
    inflation: DataFrame | None = None,
    base: int = 201901,
    period: str = "foto_mes",
) -> DataFrame:
    """Money columns in prices of the base month. A month without a factor gives NULL."""
    columns = present(df, columns)
    if not columns:
        return df
    if inflation is None:
        inflation = inflation_table(df.sparkSession, period=period)
    factors = small_side(deflators(inflation, base, period))
    return (
        df.join(factors, period, "left")
        .withColumns({c: F.col(c) * F.col("factor") for c in columns})
        .select(*df.columns)
    )


def spread_bonus(
    df: DataFrame,
    *,
    key: str = "numero_de_cliente",
    period: str = "foto_mes",
    pay: str = "mpayroll",
    count: str = "cpayroll_trx",
    bonus_months: Sequence[int] = BONUS_MONTHS,
    rise: float = BONUS_RISE,
) -> DataFrame:
    """Spread a bonus payment over the months of its half-year.

    A bonus is a listed month whose pay is at least ``rise`` times that of both earlier rows. The bonus month keeps a
    sixth of the rise and every other month of the half-year gets a sixth; months after the last listed one look at
    that one. The payment count of a bonus month goes back to the earlier row's when it rose, else it is NULL.

    The bonus row belongs to the same customer, so it is found in the customer's window and not by a join.
    """
    rows = Window.partitionBy(key).orderBy(period)
    p = F.col(period)
    last = max(bonus_months)
    half_year = (
        F.when(p > last, last)
        .when(p % 100 <= 6, F.floor(p / 100) * 100 + 6)
        .otherwise(F.floor(p / 100) * 100 + 12)
    )
    lagged = df.select(
        "*",
        F.lag(pay, 1).over(rows).alias("_pay1"),
        F.lag(pay, 2).over(rows).alias("_pay2"),
        F.lag(count, 1).over(rows).alias("_count1"),
    )

    def rose(before: Column) -> Column:
        # A rise from zero is unlimited, as in floating-point division.
        return F.when(before == 0, F.col(pay) >= 0).otherwise(F.col(pay) / F.nullif(before, F.lit(0)) >= rise)

    is_bonus = p.isin(*bonus_months) & rose(F.col("_pay1")) & rose(F.col("_pay2"))
    marked = lagged.select(
        "*",
        half_year.cast("int").alias("_half"),
        F.when(is_bonus, F.col(pay) - F.col("_pay1")).alias("_own_rise"),
    )
    same_half = Window.partitionBy(key, "_half")
    found = marked.withColumn(
        "_rise", F.max(F.when(p == F.col("_half"), F.col("_own_rise"))).over(same_half)
    )
    in_bonus_month = p.isin(*bonus_months)
    share = F.col("_rise") / 6
    new_pay = (
        F.when(F.col("_rise").isNull(), F.col(pay))
        .when(in_bonus_month, F.col(pay) - F.col("_rise") + share)
        .otherwise(F.col(pay) + share)
    )
    new_count = F.when(F.col("_rise").isNull() | ~in_bonus_month, F.col(count)).when(
        F.col(count) - F.col("_count1") > 0, F.col("_count1")
    )
    return found.withColumns({pay: new_pay, count: new_count}).select(*df.columns)
