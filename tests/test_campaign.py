import random

from pyspark.sql import functions as F

from tidemark.operators import features, labels, models, quality, windows
from tidemark.functions.scalar import month_index
from tidemark.plans.campaign import FeatureOptions, build_features, choose_contacts

KEYS = ["numero_de_cliente", "foto_mes"]


def raw(spark):
    rng, rows = random.Random(4), []
    for cust in range(120):
        gone = rng.choice([99, 99, 99, 5, 7])
        for i, month in enumerate([202011, 202012, 202101, 202102, 202103, 202104, 202105, 202106]):
            if i < gone:
                cards = [float(rng.randint(0, 50)) if rng.random() < 0.8 else None for _ in range(36)]
                rows.append((cust, month, i + 1, 20 + cust % 40, 100.0 * rng.randint(1, 3), rng.randint(1, 3), *cards))
    names = [f"{card}_{a}" for card in ("Master", "Visa") for a in features.CARD_ATTRIBUTES]
    head = "numero_de_cliente int, foto_mes int, cliente_antiguedad int, cliente_edad int, mpayroll double, cpayroll_trx int"
    return spark.createDataFrame(rows, head + "".join(f", {n} double" for n in names))


def test_steps_are_applied_in_order(spark):
    panel = raw(spark)
    made = build_features(panel, FeatureOptions(trends=(3,), rolling={3: ("avg",)}, drop_prefixes=("Master_",)))
    assert made.count() == panel.count()
    assert not [c for c in made.columns if c.startswith("Master_")]

    by_hand = labels.churn_label_join(panel, key=KEYS[0], index=month_index(F.col("foto_mes")))
    by_hand = features.spread_bonus(by_hand)
    by_hand = quality.null_constant_months(by_hand, ["mpayroll", "cliente_antiguedad"], "foto_mes")
    by_hand = features.deflate(by_hand, ["mpayroll"])
    by_hand = windows.add_lags(by_hand, ["mpayroll"], (1, 2), key=KEYS[0], period=KEYS[1])
    wanted = [*KEYS, "mpayroll", "mpayroll_lag1", "mpayroll_lag2", "cliente_antiguedad"]
    assert {tuple(r) for r in made.select(*wanted).collect()} == {tuple(r) for r in by_hand.select(*wanted).collect()}
    assert made.where("target = 1").count() == by_hand.where("label like 'BAJA%'").count()


def test_history_needs_one_shuffle_by_customer(spark):
    panel = raw(spark)
    made = build_features(panel, FeatureOptions(trends=(3, 6), rolling={6: ("min", "max", "avg")}))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_contacts(spark):
    table = build_features(raw(spark), FeatureOptions(trends=(), lags=(1,), drop_prefixes=("Master_", "Visa_")))

    def fit(rows, inputs, seed):
        return models.train_forest(rows, inputs, numTrees=3, maxDepth=2, seed=seed)

    chosen = choose_contacts(table, [202101, 202102], [202103], 11, fit, [1, 2], majority_fraction=0.5)
    assert chosen.where("Predicted = 1").count() == 11
    assert chosen.count() == table.where("foto_mes = 202103").count()
    worst = chosen.where("Predicted = 1").agg(F.min("prob")).first()[0]
    assert chosen.where("Predicted = 0").agg(F.max("prob")).first()[0] <= worst
