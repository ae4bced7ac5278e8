"""From a raw customer panel to a contact list: label, clean, make features, train seeds, score, choose.

Every step stays a DataFrame; features that look at a customer's history share one shuffle by customer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import month_index
from tidemark.operators import columns, features, labels, models, profit, quality, ranks, sampling, windows
from tidemark.session import cut_lineage

# Name prefixes of money columns.
MONEY_PREFIXES = ("m", "Visa_m", "Master_m", "tc_m")


@dataclass(frozen=True)
class FeatureOptions:
    key: str = "numero_de_cliente"
    period: str = "foto_mes"
    tenure: str = "cliente_antiguedad"
    label: str = "target"
    fix_bonus: bool = True
    fix_constant_months: bool = True
    rank_money: bool = False
    deflate_money: bool = True
    trends: Sequence[int] = (3,)
    rolling: dict[int, Sequence[str]] = field(default_factory=dict)
    lags: Sequence[int] = (1, 2)
    drop_prefixes: Sequence[str] = ()


def build_features(raw: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """The feature table of a raw panel, with ``target`` and ``target_test`` in 0, 1 or NULL."""
    o = options
    keys = {o.key, o.period, o.label}
    df = labels.churn_label_join(raw, key=o.key, index=month_index(F.col(o.period)), name=o.label)
    if o.fix_bonus:
        df = features.spread_bonus(df, key=o.key, period=o.period)
    if o.fix_constant_months:
        df = quality.null_constant_months(df, columns.numeric(df, keys), o.period)
    df = features.intra_month_features(df, period=o.period)
    attributes = columns.all_but(df, keys)
    money = [c for c in columns.with_prefix(df, MONEY_PREFIXES) if c in attributes]
    if o.rank_money:
        df = ranks.signed_rank(df, money, [o.period], [o.key])
    elif o.deflate_money:
        df = features.deflate(df, money, period=o.period)
    where = {"key": o.key, "period": o.period}
    for steps in o.trends:
        df = windows.add_trend(df, attributes, steps, o.tenure, **where)
    for size, functions in o.rolling.items():
        df = windows.add_rolling(df, attributes, size, functions, **where)
    df = windows.add_deltas(windows.add_lags(df, attributes, o.lags, **where), attributes, o.lags)
    df = df.withColumnRenamed(o.label, "_label")
    df = labels.binarize_label(df, "_label").drop("_label")
    return columns.drop_with_prefix(df, list(o.drop_prefixes))


def choose_contacts(
    table: DataFrame,
    train_periods: Sequence[int],
    future_periods: Sequence[int],
    contacts: int,
    fit: Callable[[DataFrame, Sequence[str], int], Model],
    seeds: Sequence[int],
    *,
    key: str = "numero_de_cliente",
    period: str = "foto_mes",
    majority_fraction: float = 0.1,
    folder: str | None = None,
    load: Callable[[str], Model] | None = None,
) -> DataFrame:
    """Key, average probability and ``Predicted`` (1 for the best ``contacts``) of the future rows.

    Trains one model per seed on the undersampled training periods. ``fit`` gets rows, feature names and the seed.
    """
    inputs = columns.numeric(table, {key, period, "target", "target_test"})
    split = sampling.period_split(table, {"train": list(train_periods), "future": list(future_periods)}, period)
    train = sampling.undersample(split["train"], F.col("target") == 0, majority_fraction, [key, period], seeds[0])
    train = train.where("target is not null")
    fills = models.fill_values(train, inputs)
    ready = cut_lineage(models.impute(train, inputs, values=fills))
    made = models.seed_ensemble(lambda seed: fit(ready, inputs, seed), seeds, folder, load)
    scored = models.score_models(made, models.impute(split["future"], inputs, values=fills), inputs, [key, period])
    averaged = cut_lineage(models.mean_ensemble(scored, [key, period]))
    return profit.label_top_k(averaged, contacts, key=[key, period])
