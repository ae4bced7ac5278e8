"""Aggregates over labels and scores, campaign profit, cutoffs and leaderboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import md5_draw, row_arg_max
from tidemark.operators import profit, sampling
from tidemark.plans import panels as p
from tidemark.plans.registry import query, r

GAIN = "CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END"
BY_SCORE = "PARTITION BY model ORDER BY prob DESC, cust, period"
CURVE = p.SCORES + f""", curve AS (
    SELECT *, CAST(row_number() OVER w AS INTEGER) AS position,
           CAST(sum({GAIN}) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gan_acum,
           count(*) OVER (PARTITION BY model) AS group_rows
    FROM scores WINDOW w AS ({BY_SCORE})
)
"""
KEYS = ["cust", "period"]


def curve(spark, folder, **options):
    return profit.cumulative_gain(
        p.scores(spark, folder), by=["model"], key=KEYS, group_rows="group_rows", **options
    )


# --- counts, rates and gains ---------------------------------------------------------------------------------------


@query(p.LABELS + "SELECT period, label, count(*) AS n FROM labelled GROUP BY ALL")
def count_by_period_and_class(spark, folder):
    return p.labelled(spark, folder).groupBy("period", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    p.LABELS + """SELECT period, count(*) FILTER (WHERE label = 'BAJA+2') AS leavers,
        round(avg(CASE WHEN label = 'BAJA+2' THEN 1.0::DOUBLE ELSE 0 END), 9) AS share FROM labelled GROUP BY period"""
)
def class_share(spark, folder):
    is_hit = F.coalesce(F.col("label") == "BAJA+2", F.lit(False))
    return p.labelled(spark, folder).groupBy("period").agg(
        F.count_if(is_hit).alias("leavers"), r(F.avg(is_hit.cast("double")), 9).alias("share")
    )


@query(
    p.LABELS + """, rates AS (
        SELECT period, avg(hit) FILTER (WHERE n_events < 2) AS rate_inside, avg(hit) AS rate
        FROM (SELECT *, CASE WHEN label = 'BAJA+2' THEN 1.0::DOUBLE ELSE 0 END AS hit FROM labelled) GROUP BY period
    )
    SELECT period, round(rate_inside, 9) AS rate_inside, round(rate, 9) AS rate,
           round(rate_inside / nullif(rate, 0), 9) AS lift FROM rates"""
)
def predicate_lift(spark, folder):
    rates = profit.rate_and_lift(
        p.labelled(spark, folder), F.col("n_events") < 2, F.col("label") == "BAJA+2", by=["period"]
    )
    return rates.select("period", *[r(c, 9).alias(c) for c in ("rate_inside", "rate", "lift")])


@query(
    p.LABELS + f"""SELECT period, CAST(sum({GAIN}) AS BIGINT) AS everyone,
        CAST(coalesce(sum({GAIN}) FILTER (WHERE n_events < 2), 0) AS BIGINT) AS rare,
        CAST(coalesce(sum({GAIN}) FILTER (WHERE n_events < 3 AND m_net < 20), 0) AS BIGINT) AS both
    FROM labelled GROUP BY period"""
)
def predicate_gains(spark, folder):
    rare, both = F.col("n_events") < 2, (F.col("n_events") < 3) & (F.col("m_net") < 20)
    predicates = {"everyone": F.lit(True), "rare": rare, "both": both}
    return profit.total_gain(p.labelled(spark, folder), predicates, profit.gain(), by=["period"])


CUTS_SQL = p.LABELS + f""", cuts AS (
    SELECT CAST(t AS INTEGER) AS cut,
           CAST(coalesce(sum(CASE WHEN m_total / 10 < t THEN {GAIN} END), 0) AS BIGINT) AS gain
    FROM range(0, 33) AS c(t) CROSS JOIN labelled GROUP BY t
)
"""


@query(CUTS_SQL + "SELECT * FROM cuts")
def gain_of_every_cut(spark, folder):
    panel = p.labelled(spark, folder).withColumn("tens", F.col("m_total") / 10)
    return profit.cut_gains(panel, "tens", profit.gain(), 0, 32)


@query(CUTS_SQL + "SELECT cut, gain FROM cuts ORDER BY gain DESC, cut LIMIT 1")
def best_cut(spark, folder):
    panel = p.labelled(spark, folder).withColumn("tens", F.col("m_total") / 10)
    return profit.best_cut(panel, "tens", profit.gain(), 0, 32)


@query(
    p.SCORES + f"""SELECT model, round(avg(gain), 4) AS mean, min(gain) AS low, max(gain) AS high,
        round(stddev_samp(gain), 4) AS sd FROM (
            SELECT model, period, CAST(sum({GAIN}) FILTER (WHERE prob > 0.5) AS BIGINT) AS gain FROM scores GROUP BY ALL
        ) GROUP BY ALL"""
)
def gain_statistics(spark, folder):
    gains = p.scores(spark, folder).groupBy("model", "period").agg(
        F.sum(F.when(F.col("prob") > 0.5, profit.gain())).alias("gain")
    )
    return gains.groupBy("model").agg(
        r(F.avg("gain"), 4).alias("mean"),
        F.min("gain").alias("low"),
        F.max("gain").alias("high"),
        r(F.stddev_samp("gain"), 4).alias("sd"),
    )


# --- cumulative gain -----------------------------------------------------------------------------------------------


@query(CURVE + "SELECT model, cust, period, prob, position, gan_acum FROM curve")
def cumulative_gain_per_model(spark, folder):
    return curve(spark, folder).select("model", "cust", "period", "prob", "position", "gan_acum")


@query(CURVE + "SELECT model, cust, period, prob, position, gan_acum FROM curve")
def cumulative_gain_in_buckets(spark, folder):
    """The same curve with groups cut into many buckets, as on large data."""
    return curve(spark, folder, rows_per_task=500).select("model", "cust", "period", "prob", "position", "gan_acum")


@query(
    CURVE + """, best AS (SELECT model, max(gan_acum) AS max_gain, count(*) AS n_rows FROM curve GROUP BY model)
    SELECT b.model, max_gain, min(position) AS contacts, arg_min(prob, position) AS threshold, any_value(n_rows) AS n_rows
    FROM best b JOIN curve c ON b.model = c.model AND c.gan_acum = max_gain GROUP BY b.model, max_gain"""
)
def best_number_of_contacts(spark, folder):
    return profit.gain_summary(curve(spark, folder), by=["model"])


@query(
    CURVE + """SELECT model, cust, period, round(avg(gan_acum) OVER f, 2) AS meseta,
        CASE WHEN count(*) OVER f = 1001 THEN round(avg(gan_acum) OVER f, 2) END AS meseta_inner
    FROM curve WINDOW f AS (PARTITION BY model ORDER BY position ROWS BETWEEN 500 PRECEDING AND 500 FOLLOWING)"""
)
def plateau_curve(spark, folder):
    both = profit.plateau(curve(spark, folder), 1001, by=["model"], name="meseta", block=2000)
    both = profit.plateau(both, 1001, by=["model"], partial=False, name="meseta_inner", block=2000)
    return both.select(
        "model", "cust", "period", r("meseta", 2).alias("meseta"), r("meseta_inner", 2).alias("meseta_inner")
    )


@query(
    CURVE + """SELECT model, round(max(meseta), 2) AS plateau_gain FROM (
        SELECT model, avg(gan_acum) OVER (PARTITION BY model ORDER BY position
            ROWS BETWEEN 1000 PRECEDING AND 1000 FOLLOWING) AS meseta FROM curve
    ) GROUP BY model"""
)
def best_plateau(spark, folder):
    best = profit.plateau_gain(curve(spark, folder), 2001, by=["model"])
    return best.select("model", r("plateau_gain", 2).alias("plateau_gain"))


@query(
    p.SCORES + f"""SELECT model, cust, period, fold, CAST(row_number() OVER w AS INTEGER) AS position,
        CAST(sum(2 * {GAIN}) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gan_acum
    FROM (SELECT *, 1 + period % 2 AS fold FROM scores)
    WINDOW w AS (PARTITION BY model, fold ORDER BY prob DESC, cust, period)"""
)
def cumulative_gain_per_fold(spark, folder):
    folds = p.scores(spark, folder).withColumn("fold", 1 + F.col("period") % 2)
    return profit.fold_curves(folds, "prob", key=KEYS, by=["model"]).select("model", *KEYS, "fold", "position", "gan_acum")


# --- sorts, cutoffs and thresholds ---------------------------------------------------------------------------------


@query(
    p.SCORES + """SELECT model, prob, cust, period FROM scores ORDER BY model, prob DESC, cust, period LIMIT 25"""
)
def ordered_head(spark, folder):
    order = ["model", F.col("prob").desc(), "cust", "period"]
    return p.scores(spark, folder).select("model", "prob", "cust", "period").orderBy(*order).limit(25)


@query(p.SCORES + f"""SELECT model, cust, period, CASE WHEN row_number() OVER ({BY_SCORE}) <= 700 THEN 1 ELSE 0 END
    AS Predicted FROM scores""")
def top_k_labels(spark, folder):
    labelled = profit.label_top_k(p.scores(spark, folder), 700, by=["model"], key=KEYS)
    return labelled.select("model", *KEYS, "Predicted")


CUTOFFS = [100, 500, 1000, 2000, 3000, 4_000_000_000]


@query(
    CURVE + f"""SELECT model, CAST(cutoff AS BIGINT) AS cutoff, gan_acum AS gain
    FROM curve JOIN (SELECT unnest([{', '.join(map(str, CUTOFFS))}]) AS cutoff)
    ON position = least(cutoff, group_rows)"""
)
def gain_at_cutoffs(spark, folder):
    return profit.sweep_top_k(p.scores(spark, folder), CUTOFFS, by=["model"], key=KEYS)


@query(
    CURVE + """SELECT * FROM (
        SELECT model, CAST(abs(gan_acum - 5000000) AS BIGINT) AS distance, position, gan_acum,
               row_number() OVER (PARTITION BY model ORDER BY abs(gan_acum - 5000000), position) AS n FROM curve
    ) WHERE n = 1"""
)
def nearest_to_target_gain(spark, folder):
    nearest = profit.nearest_row(curve(spark, folder), "gan_acum", F.lit(5_000_000), ["position"], by=["model"])
    return nearest.withColumn("n", F.lit(1).cast("long"))


@query(
    p.SCORES + f"""SELECT model, round(coalesce(sum({GAIN}) FILTER (WHERE prob > 0.25), 0) / 0.3::DOUBLE, 2) AS gain,
        count(*) FILTER (WHERE prob > 0.25) AS contacts,
        count(*) FILTER (WHERE prob > 0.25 AND label = 'BAJA+2') AS hits,
        count(*) FILTER (WHERE prob >= 0.25) AS contacts_with_equal
    FROM scores GROUP BY model"""
)
def gain_above_threshold(spark, folder):
    scored = p.scores(spark, folder)
    strict = profit.label_by_threshold("prob", 0.25) == 1
    loose = profit.label_by_threshold("prob", 0.25, strict=False) == 1
    found = profit.normalised_gain(scored, strict, 0.3, by=["model"])
    equal = scored.groupBy("model").agg(F.count_if(loose).alias("contacts_with_equal"))
    return found.join(equal, "model").withColumn("gain", r("gain", 2))


@query(
    p.SCORES + """SELECT model, round(sum(wins) / nullif(sum(pairs), 0), 9) AS auc FROM (
        SELECT x.model, sum(CASE WHEN x.prob > y.prob THEN 1.0::DOUBLE WHEN x.prob = y.prob THEN 0.5 ELSE 0 END) AS wins,
               count(*) AS pairs
        FROM scores x JOIN scores y ON x.model = y.model AND x.label = 'BAJA+2' AND y.label <> 'BAJA+2' GROUP BY x.model
    ) GROUP BY model"""
)
def area_under_curve(spark, folder):
    found = profit.auc(p.scores(spark, folder), F.col("label") == "BAJA+2", by=["model"])
    return found.withColumn("auc", r("auc", 9))


# --- leaderboards --------------------------------------------------------------------------------------------------

DRAW = "('0x' || substr(md5({text}), 1, 12))::BIGINT / 281474976710656.0::DOUBLE"


def sql_draw(seed: str, *keys: str) -> str:
    return DRAW.format(text=" || '|' || ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], f"CAST({seed} AS VARCHAR)"]))


FOLDED = p.SCORES + f""", truth AS (
    SELECT cust, period, label, [1, 1, 1, 2, 2, 2, 2, 2, 2, 2][1 + (n - 1) % 10] AS fold FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY draw, cust, period) AS n
        FROM (SELECT cust, period, label, {sql_draw('7', 'cust', 'period')} AS draw FROM labelled WHERE label IS NOT NULL)
    )
), predicted AS (
    SELECT model, cust, period, CASE WHEN row_number() OVER ({BY_SCORE}) <= 1200 THEN 1 ELSE 0 END AS Predicted FROM scores
)
"""


@query(
    FOLDED + f"""SELECT model, round(coalesce(sum({GAIN}) FILTER (WHERE fold = 1 AND Predicted = 1), 0) / 0.3::DOUBLE, 2) AS public,
        round(coalesce(sum({GAIN}) FILTER (WHERE fold = 2 AND Predicted = 1), 0) / 0.7::DOUBLE, 2) AS private,
        CAST(coalesce(sum({GAIN}) FILTER (WHERE Predicted = 1), 0) AS BIGINT) AS total
    FROM truth JOIN predicted USING (cust, period) GROUP BY model"""
)
def public_and_private_gain(spark, folder):
    known = p.labelled(spark, folder).where(F.col("label").isNotNull()).select(*KEYS, "label")
    truth = sampling.stratified_fold(known, (3, 7), ["label"], KEYS, seed=7, draw=md5_draw)
    predictions = profit.label_top_k(p.scores(spark, folder).drop("label"), 1200, by=["model"], key=KEYS)
    board = profit.leaderboard(truth, predictions, KEYS, by=["model"])
    return board.select("model", r("public", 2).alias("public"), r("private", 2).alias("private"), "total")


REPEATS = 50
SPLITS = p.SCORES + f""", splits AS (
    SELECT cust, period, label, repeat, n <= floor(0.3::DOUBLE * size) AS is_public FROM (
        SELECT *, row_number() OVER (PARTITION BY repeat, label ORDER BY draw, cust, period) AS n,
               count(*) OVER (PARTITION BY repeat, label) AS size
        FROM (
            SELECT cust, period, label, CAST(repeat AS INTEGER) AS repeat,
                   {sql_draw('5', 'cust', 'period', 'repeat')} AS draw
            FROM labelled CROSS JOIN range(1, {REPEATS + 1}) AS t(repeat) WHERE label IS NOT NULL
        )
    )
), board AS (
    SELECT repeat, model, coalesce(sum({GAIN.replace('label', 's.label')}) FILTER (WHERE is_public AND chosen), 0) / 0.3::DOUBLE AS public,
           coalesce(sum({GAIN.replace('label', 's.label')}) FILTER (WHERE NOT is_public AND chosen), 0) / 0.7::DOUBLE AS private
    FROM splits s JOIN (SELECT *, prob >= 0.6 AS chosen FROM scores) USING (cust, period) GROUP BY ALL
)
"""


def repeated_board(spark, folder):
    scored = p.scores(spark, folder)
    return profit.repeated_leaderboard(
        scored, KEYS, F.col("prob") >= 0.6, repeats=REPEATS, share=0.3, seed=5, draw=md5_draw
    )


@query(SPLITS + "SELECT repeat, model, round(public, 2) AS public, round(private, 2) AS private FROM board")
def repeated_leaderboards(spark, folder):
    board = repeated_board(spark, folder)
    return board.select("repeat", "model", r("public", 2).alias("public"), r("private", 2).alias("private"))


@query(
    SPLITS + """, best AS (
        SELECT repeat, arg_min(model, (-round(public, 2), model)) AS best_public,
               arg_min(model, (-round(private, 2), model)) AS best_private FROM board GROUP BY repeat
    )
    SELECT best_public, count(*) FILTER (WHERE best_private = 'a') AS a, count(*) FILTER (WHERE best_private = 'b') AS b,
           count(*) FILTER (WHERE best_private = 'c') AS c FROM best GROUP BY best_public"""
)
def best_public_against_best_private(spark, folder):
    board = repeated_board(spark, folder).withColumns({"public": r("public", 2), "private": r("private", 2)})
    return profit.public_private_table(board, p.MODELS)


@query(
    SPLITS + """, wide AS (
        SELECT repeat, round(max(public) FILTER (WHERE model = 'a'), 2) AS a_public,
               round(max(public) FILTER (WHERE model = 'b'), 2) AS b_public,
               round(max(public) FILTER (WHERE model = 'c'), 2) AS c_public FROM board GROUP BY repeat
    ), long AS (UNPIVOT wide ON a_public, b_public, c_public INTO NAME model_type VALUE gain)
    SELECT repeat, split_part(model_type, '_', 1) AS model, split_part(model_type, '_', 2) AS side, gain,
        CASE WHEN a_public >= greatest(b_public, c_public) THEN 'a_public' WHEN b_public >= c_public THEN 'b_public'
             ELSE 'c_public' END AS best FROM long JOIN wide USING (repeat)"""
)
def board_in_long_form(spark, folder):
    names = [f"{m}_public" for m in p.MODELS]
    wide = repeated_board(spark, folder).groupBy("repeat").agg(
        *[r(F.max(F.when(F.col("model") == m, F.col("public"))), 2).alias(f"{m}_public") for m in p.MODELS]
    )
    best = wide.withColumn("best", row_arg_max(names))
    long = best.unpivot(["repeat", "best"], names, "model_type", "gain")
    parts = F.split("model_type", "_")
    return long.select("repeat", parts[0].alias("model"), parts[1].alias("side"), "gain", "best")


@query(
    CURVE + """, at_cut AS (
        SELECT cutoff, avg(gan_acum) AS mean_gain FROM curve JOIN (SELECT unnest([200, 600, 1200, 2400]) AS cutoff)
        ON position = least(cutoff, group_rows) GROUP BY cutoff
    ), best AS (SELECT mean_gain AS target, cutoff AS best_cutoff FROM at_cut ORDER BY mean_gain DESC, cutoff LIMIT 1)
    SELECT best_cutoff, round(target, 4) AS mean_gain, model AS near_model, position AS near_position,
           gan_acum AS near_gain
    FROM curve CROSS JOIN best ORDER BY abs(gan_acum - target), model, position LIMIT 1"""
)
def apo_experiment(spark, folder):
    _, best, near = profit.apo_experiment(p.scores(spark, folder), [200, 600, 1200, 2400], model="model", key=KEYS)
    return near.select(
        best.select("cutoff").scalar().alias("best_cutoff"),
        r(best.select("mean_gain").scalar(), 4).alias("mean_gain"),
        F.col("model").alias("near_model"),
        F.col("position").alias("near_position"),
        F.col("gan_acum").alias("near_gain"),
    )


@query(
    CURVE + """SELECT cutoff::BIGINT AS cutoff, round(avg(gan_acum), 4) AS mean_gain
    FROM curve JOIN (SELECT unnest([200, 600, 1200, 2400]) AS cutoff) ON position = least(cutoff, group_rows) GROUP BY cutoff"""
)
def apo_means_per_cutoff(spark, folder):
    means, _, _ = profit.apo_experiment(p.scores(spark, folder), [200, 600, 1200, 2400], model="model", key=KEYS)
    return means.select("cutoff", r("mean_gain", 4).alias("mean_gain"))


# --- gains by hyper-parameter and fold -----------------------------------------------------------------------------


@query(
    p.SCORES + f"""SELECT model, period % 2 AS fold, CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS predicted, label,
        count(*) AS n, round(sum({GAIN}) / 0.5::DOUBLE, 2) AS scaled FROM scores GROUP BY ALL"""
)
def gain_by_fold_prediction_and_class(spark, folder):
    scored = p.scores(spark, folder).withColumns(
        {"fold": F.col("period") % 2, "predicted": profit.label_by_threshold("prob", 0.5)}
    )
    return scored.groupBy("model", "fold", "predicted", "label").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum(profit.gain()) / F.lit(0.5), 2).alias("scaled")
    )


@query(
    p.DAY + """SELECT GROUPING_A AS kind, n_events, count(*) AS n, round(sum(m_total), 2) AS total
    FROM (SELECT CASE WHEN m_net > 0 THEN 'up' ELSE 'down' END AS GROUPING_A, n_events, m_total FROM panel_day)
    GROUP BY ALL"""
)
def group_by_all(spark, folder):
    return spark.sql(
        """SELECT if(m_net > 0, 'up', 'down') AS kind, n_events, count(*) AS n, round(sum(m_total), 2) AS total
        FROM {panel} GROUP BY ALL""",
        panel=p.panel_day(spark, folder),
    )


@query(p.DAY + "SELECT cust, period, m_total FROM panel_day WHERE period < (SELECT max(period) - 1 FROM panel_day)")
def before_last_period(spark, folder):
    return spark.sql(
        "SELECT cust, period, m_total FROM {panel} WHERE period < (SELECT max(period) - 1 FROM {panel})",
        panel=p.panel_day(spark, folder),
    )


@query(
    p.SCORES + """SELECT model, n, cum FROM (
        SELECT model, CAST(row_number() OVER w AS INTEGER) AS n, round(avg(gain) OVER w, 4) AS cum
        FROM (SELECT model, period, CAST(sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END) AS BIGINT) AS gain
              FROM scores WHERE prob > 0.5 GROUP BY ALL)
        WINDOW w AS (PARTITION BY model ORDER BY period)
    ) WHERE n IN (1, 5, 10, 20)"""
)
def running_mean_of_gains(spark, folder):
    from tidemark.operators.stats import running_mean

    gains = p.scores(spark, folder).where("prob > 0.5").groupBy("model", "period").agg(
        F.sum(profit.gain()).alias("gain")
    )
    numbered = gains.withColumn("seed", F.row_number().over(Window.partitionBy("model").orderBy("period")))
    means = running_mean(numbered, ["model"], "seed", "gain", [1, 5, 10, 20])
    return means.select("model", F.col("n_seeds").alias("n"), r("mean_gain", 4).alias("cum"))
