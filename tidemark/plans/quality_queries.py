"""Data quality, drift, group statistics and the experiment tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality, stats, trials
from tidemark.plans import panels as p
from tidemark.plans.profit_queries import KEYS, SPLITS, repeated_board
from tidemark.plans.registry import query, r, rounded
from tidemark.session import cut_lineage

COLUMNS = ["m_total", "m_max", "m_net", *p.COUNTS]
TRAIN, SCORE = "period < 10", "period >= 20"

# One column is broken on purpose: constant on days 5 and 6.
BROKEN = p.DAY + """, broken AS (
    SELECT * REPLACE (CASE WHEN period IN (5, 6) THEN 0 ELSE m_max END AS m_max) FROM panel_day
)
"""


def broken(spark, folder):
    return p.panel_day(spark, folder).withColumn(
        "m_max", F.when(F.col("period").isin(5, 6), 0.0).otherwise(F.col("m_max"))
    )


def _union(parts):
    return " UNION ALL ".join(parts)


# A sum of squares that should be zero may come out as a small number, so the oracle asks for equal extremes.
@query(
    BROKEN + _union(
        f"SELECT period, '{c}' AS attribute, 0.0::DOUBLE AS std_dev FROM broken GROUP BY period "
        f"HAVING count({c}) > 1 AND min({c}) = max({c})"
        for c in COLUMNS
    )
)
def constant_columns(spark, folder):
    return quality.zero_sd(broken(spark, folder), COLUMNS)


@query(
    BROKEN + f""", flat AS (
        SELECT period, {', '.join(f'count({c}) > 1 AND min({c}) = max({c}) AS flat_{c}' for c in COLUMNS)}
        FROM broken GROUP BY period
    )
    SELECT cust, period, {', '.join(f'CASE WHEN NOT flat_{c} THEN {c} END AS {c}' for c in COLUMNS)}
    FROM broken JOIN flat USING (period)"""
)
def constant_columns_removed(spark, folder):
    return quality.null_constant_months(broken(spark, folder), COLUMNS).select(*KEYS, *COLUMNS)


@query(
    p.LABELS + f"""SELECT period, label, {', '.join(f'round(avg({c}), 6) AS {c}' for c in COLUMNS)}
    FROM labelled GROUP BY period, label"""
)
def evolution_by_period_and_class(spark, folder):
    panel = p.labelled(spark, folder).select(*KEYS, "label", *COLUMNS)
    return rounded(quality.monthly_evolution(panel, ["period", "label"], exclude=["cust"]), COLUMNS)


def _drift_sql(condition, prefix):
    def one(c):
        sides = ", ".join(
            f"count(*) FILTER (WHERE {side} AND {condition.format(c=c)}) * 100.0::DOUBLE / count(*) FILTER (WHERE {side}) AS {name}"
            for side, name in ((TRAIN, "t"), (SCORE, "s"))
        )
        return f"SELECT '{c}' AS attribute, {sides} FROM panel_day"

    return p.DAY + f"""SELECT attribute, round(t, 9) AS train_{prefix}_pct, round(s, 9) AS score_{prefix}_pct,
        round(abs(s - t), 9) AS diff FROM ({_union(map(one, COLUMNS))})"""


def _drift(spark, folder, measure, prefix):
    drift = measure(p.panel_day(spark, folder), COLUMNS, F.expr(TRAIN), F.expr(SCORE))
    return rounded(drift, [f"train_{prefix}_pct", f"score_{prefix}_pct", "diff"], 9)


@query(_drift_sql("{c} IS NULL", "null"))
def null_rate_drift(spark, folder):
    return _drift(spark, folder, quality.null_rate_drift, "null")


@query(_drift_sql("{c} = 0", "zero"))
def zero_rate_drift(spark, folder):
    return _drift(spark, folder, quality.zero_rate_drift, "zero")


def _psi_sql(buckets, score=SCORE):
    probabilities = ", ".join(f"{i / buckets!r}::DOUBLE" for i in range(buckets + 1))
    long = _union(f"SELECT '{c}' AS feature, period, n_events, CAST({c} AS DOUBLE) AS value FROM panel_day" for c in COLUMNS)
    return p.DAY + f""", long AS (
        SELECT feature, value, {TRAIN} AS e, {score} AS a FROM ({long}) WHERE {TRAIN} OR {score}
    ), edges AS (
        SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probabilities}]))) AS edges FROM long
        WHERE e AND value IS NOT NULL GROUP BY feature
    ), binned AS (
        SELECT feature, e, a, value,
            CASE WHEN value >= edges[1] AND value <= edges[len(edges)]
                 THEN least(len(list_filter(edges, lambda x: x <= value)), len(edges) - 1) END AS bin
        FROM long LEFT JOIN edges USING (feature)
    ), totals AS (
        SELECT feature, count(value) FILTER (WHERE e) AS ke, count(value) FILTER (WHERE a) AS ka,
               count(*) FILTER (WHERE e) AS te, count(*) FILTER (WHERE a) AS ta FROM binned GROUP BY feature
    ), cells AS (
        SELECT feature, bin, value IS NULL AS missing, count(*) FILTER (WHERE e) AS ne, count(*) FILTER (WHERE a) AS na
        FROM binned GROUP BY ALL
    ), shares AS (
        SELECT feature, ne, na, CASE WHEN missing THEN ne / te ELSE ne / ke END AS pe,
               CASE WHEN missing THEN na / ta ELSE na / ka END AS pa
        FROM cells JOIN totals USING (feature) WHERE bin IS NOT NULL OR missing AND ne > 0 AND na > 0
    )
    SELECT feature, CASE WHEN min(least(ne, na)) = 0 THEN 'infinity'::DOUBLE
        ELSE round(sum(CASE WHEN ne > 0 AND na > 0 THEN (pa - pe) * ln(pa / pe) END), 9) END AS psi
    FROM shares GROUP BY feature"""


@query(_psi_sql(10))
def stability_index(spark, folder):
    table = quality.psi_table(p.panel_day(spark, folder), COLUMNS, F.expr(TRAIN), F.expr(SCORE))
    return rounded(table, ["psi"], 9)


ONE_EVENT = f"{SCORE} AND n_events = 1"


@query(_psi_sql(10, ONE_EVENT))
def stability_index_of_empty_bins(spark, folder):
    """Against days with one event: bins of large values are empty then, and the index infinite."""
    table = quality.psi_table(p.panel_day(spark, folder), COLUMNS, F.expr(TRAIN), F.expr(ONE_EVENT))
    return rounded(table, ["psi"], 9)


@query(_psi_sql(10))
def stability_index_in_buckets(spark, folder):
    """The same index with quantiles from ranked rows, as for columns too long for one task."""
    panel = p.panel_day(spark, folder)
    return rounded(quality.psi_table(panel, COLUMNS, F.expr(TRAIN), F.expr(SCORE), rows_per_task=300), ["psi"], 9)


@query(
    p.DAY + f""", edges AS (
        SELECT list_sort(list_distinct(quantile_cont(m_total, [{', '.join(f'{i / 20!r}::DOUBLE' for i in range(21))}]))) AS edges
        FROM panel_day WHERE {TRAIN}
    ), binned AS (
        SELECT {TRAIN} AS e, {SCORE} AS a, edges,
            CASE WHEN m_total >= edges[1] AND m_total <= edges[len(edges)]
                 THEN least(len(list_filter(edges, lambda x: x <= m_total)), len(edges) - 1) END AS bin
        FROM panel_day CROSS JOIN edges WHERE {TRAIN} OR {SCORE}
    )
    SELECT CAST(bin AS INTEGER) AS bin, round(any_value(edges)[bin], 6) AS low, round(any_value(edges)[bin + 1], 6) AS high,
           count(*) FILTER (WHERE e) AS expected, count(*) FILTER (WHERE a) AS actual
    FROM binned WHERE bin IS NOT NULL GROUP BY bin"""
)
def quantile_bins(spark, folder):
    bins = quality.quantile_histogram(p.panel_day(spark, folder), "m_total", F.expr(TRAIN), F.expr(SCORE), 20)
    return rounded(bins, ["low", "high"])


@query(
    p.LABELS + """SELECT label = 'BAJA+2' AS is_target, count(c_click) AS n, round(avg(c_click), 6) AS mean,
        round(stddev_samp(c_click), 6) AS std, min(c_click) AS min, max(c_click) AS max,
        quantile_cont(c_click, 0.25) AS q25, quantile_cont(c_click, 0.5) AS q50, quantile_cont(c_click, 0.75) AS q75,
        count(DISTINCT c_click) AS n_unique, count(*) - count(c_click) AS missing
    FROM labelled WHERE label IS NOT NULL GROUP BY ALL"""
)
def one_class_against_rest(spark, folder):
    compared = quality.compare_group_stats(p.labelled(spark, folder), "c_click", "label", "BAJA+2")
    return rounded(compared, ["mean", "std"])


@query(
    p.LABELS + _union(
        f"SELECT label, '{c}' AS feature, round(median({c}), 6) AS median FROM labelled WHERE {c} IS NOT NULL GROUP BY label"
        for c in COLUMNS
    )
)
def medians_per_class(spark, folder):
    return rounded(quality.group_medians(p.labelled(spark, folder), COLUMNS, "label"), ["median"])


@query(
    p.SCORES + """SELECT model, count(*) FILTER (WHERE label = 'BAJA+1') AS "BAJA+1",
        count(*) FILTER (WHERE label = 'BAJA+2') AS "BAJA+2", count(*) FILTER (WHERE label = 'CONTINUA') AS "CONTINUA",
        round(avg(prob), 6) AS mean_score FROM scores GROUP BY model"""
)
def classes_per_group(spark, folder):
    classes = ["BAJA+1", "BAJA+2", "CONTINUA"]
    profile = quality.group_profile(p.scores(spark, folder), "model", "label", "prob", classes)
    return rounded(profile, ["mean_score"])


@query(
    """SELECT CAST(CASE WHEN o_totalprice >= 500000 THEN 26 ELSE floor(o_totalprice / 20000) + 1 END AS BIGINT) AS bin,
        count(*) AS n FROM orders GROUP BY ALL"""
)
def price_histogram(spark, folder):
    return quality.histogram(p.table(spark, folder, "orders"), "o_totalprice", 0, 500_000, 25)


# --- experiment tables ---------------------------------------------------------------------------------------------

# Trials stand for (priority, status, year) groups of orders; their value is the mean price.
TRIALS_SQL = """WITH trials AS (
    SELECT row_number() OVER (ORDER BY status, priority, year) AS trial_number, status, priority, year, value FROM (
        SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS year,
               round(avg(o_totalprice), 0) AS value FROM orders GROUP BY ALL
    )
)
"""


def trial_table(spark, folder):
    from pyspark.sql import Window

    groups = p.table(spark, folder, "orders").groupBy(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("year"),
    ).agg(r(F.avg("o_totalprice"), 0).alias("value"))
    # One row per group.
    return groups.withColumn("trial_number", F.row_number().over(Window.orderBy("status", "priority", "year")))


@query(TRIALS_SQL + "SELECT trial_number, value FROM trials ORDER BY value DESC, trial_number LIMIT 1")
def best_trial(spark, folder):
    return trials.best_trial(trial_table(spark, folder))


@query(
    TRIALS_SQL + "SELECT count(*) AS total, max(value) AS best, min(value) AS worst, round(avg(value), 4) AS mean FROM trials"
)
def trial_statistics(spark, folder):
    return rounded(trials.trial_statistics(trial_table(spark, folder)), ["mean"], 4)


@query(TRIALS_SQL + "SELECT trial_number, value FROM trials ORDER BY value DESC, trial_number LIMIT 5")
def top_trials(spark, folder):
    return trials.top_trials(trial_table(spark, folder)).select("trial_number", "value")


@query(
    TRIALS_SQL + """SELECT status, priority, round(avg(value), 4) AS mean_gain, count(*) AS runs FROM trials
    GROUP BY status, priority ORDER BY avg(value) DESC, status, priority LIMIT 10"""
)
def grid_summary(spark, folder):
    return rounded(trials.grid_summary(trial_table(spark, folder), ["status", "priority"], "value"), ["mean_gain"], 4)


@query(TRIALS_SQL + "SELECT DISTINCT status, year FROM trials WHERE status <> 'F'")
def grid_points_left(spark, folder):
    table = trial_table(spark, folder)
    grid = table.select("status", "year").distinct()
    return trials.not_done(grid, table.where("status = 'F'"), ["status", "year"])


@query(
    TRIALS_SQL + """SELECT status || priority AS feature, round(avg(value), 4) AS importance FROM trials GROUP BY ALL
    ORDER BY avg(value) DESC, feature LIMIT 8"""
)
def mean_importance(spark, folder):
    named = trial_table(spark, folder).select(
        F.concat("status", "priority").alias("feature"), F.col("value").alias("importance")
    )
    return rounded(trials.mean_importance(named, 8), ["importance"], 4)


# --- paired tests --------------------------------------------------------------------------------------------------

# A few cents per repeat keep all differences apart, so that the exact test applies.
CENTS = {"a": 0.01, "b": 0.02, "c": 0.04}
PAIRS = SPLITS + """, marked AS (
    SELECT repeat, model, private + repeat * CASE model WHEN 'a' THEN 0.01 WHEN 'b' THEN 0.02 ELSE 0.04 END AS private FROM board
), paired AS (
    SELECT x.model || y.model AS pair, x.repeat AS ordinal, round(x.private, 2) AS gain1, round(y.private, 2) AS gain2
    FROM marked x JOIN marked y ON x.repeat = y.repeat AND x.model < y.model
), prefixes AS (
    SELECT a.pair, b.ordinal AS prefix, a.ordinal, a.gain1, a.gain2, a.gain1 - a.gain2 AS d
    FROM paired a JOIN paired b ON a.pair = b.pair AND a.ordinal <= b.ordinal
), ranks AS (SELECT *, rank() OVER (PARTITION BY pair, prefix ORDER BY abs(d)) AS rnk FROM prefixes),
measured AS (
    SELECT pair, prefix, count(*) AS n, CAST(coalesce(sum(rnk) FILTER (WHERE d > 0), 0) AS DOUBLE) AS v,
           avg(gain1) AS mean1, avg(gain2) AS mean2
    FROM ranks GROUP BY pair, prefix
), dist AS (  -- in how many ways the ranks 1..n give each sum
    WITH RECURSIVE steps(n, ways) AS (
        SELECT 0, list_transform(range(0, 1276), lambda w: CASE WHEN w = 0 THEN 1 ELSE 0 END::DOUBLE)
        UNION ALL
        SELECT n + 1, list_transform(range(0, 1276), lambda w: ways[w + 1] + CASE WHEN w > n THEN ways[w - n] ELSE 0 END)
        FROM steps WHERE n < 49
    ) SELECT * FROM steps
), shaped AS (
    SELECT *, (abs(v - n * (n + 1) / 4.0::DOUBLE) - CASE WHEN v = n * (n + 1) / 4.0::DOUBLE THEN 0 ELSE 0.5 END)
        / sqrt(n * (n + 1) * (2 * n + 1) / 24.0::DOUBLE) AS z FROM measured
), tests AS (  -- exact below 50 pairs, else the area under the normal density by Simpson's rule
    SELECT pair, prefix, m.n, v, mean1, mean2, CASE WHEN m.n < 50
        THEN least(1.0, 2 * list_sum(ways[1:least(v, m.n * (m.n + 1) / 2 - v)::INT + 1]) / pow(2, m.n))
        ELSE 1 - 2 / sqrt(2 * pi()) * z / 6000 * (SELECT sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
            * exp(-z * z * i * i / 8000000.0::DOUBLE)) FROM range(0, 2001) AS t(i)) END::DOUBLE AS p_value
    FROM shaped m LEFT JOIN dist ON dist.n = m.n
)
"""


def paired_gains(spark, folder):
    cents = F.coalesce(*[F.when(F.col("model") == m, F.lit(c)) for m, c in CENTS.items()])
    gains = r(F.col("private") + F.col("repeat") * cents, 2)
    board = repeated_board(spark, folder).select("repeat", "model", gains.alias("gain"))
    wide = board.groupBy("repeat").agg(
        *[F.max(F.when(F.col("model") == m, F.col("gain"))).alias(m) for m in p.MODELS]
    )
    pairs = [(x, y) for i, x in enumerate(p.MODELS) for y in p.MODELS[i + 1 :]]
    entries = F.array(
        *[F.struct(F.lit(x + y).alias("pair"), F.col(x).alias("gain1"), F.col(y).alias("gain2")) for x, y in pairs]
    )
    # A stored table of experiments: a row per repeat and pair.
    return cut_lineage(wide.select(F.col("repeat").alias("ordinal"), F.inline(entries)))


@query(PAIRS + "SELECT pair, prefix, v, round(p_value, 9) AS p_value FROM tests")
def sequential_signed_rank_test(spark, folder):
    tests = stats.sequential_test(paired_gains(spark, folder), ["pair"], "ordinal")
    return tests.select("pair", "prefix", "v", r("p_value", 9).alias("p_value"))


@query(
    PAIRS + """SELECT pair, coalesce(arg_min(CASE WHEN mean1 > mean2 THEN 1 WHEN mean1 < mean2 THEN 2 ELSE 0 END, prefix)
            FILTER (WHERE p_value < 0.05), 0) AS winner,
        coalesce(min(prefix) FILTER (WHERE p_value < 0.05), max(prefix)) AS pairs_used FROM tests GROUP BY pair"""
)
def sequential_choice(spark, folder):
    tests = stats.sequential_test(paired_gains(spark, folder), ["pair"], "ordinal")
    return stats.sequential_choice(tests, ["pair"])


@query(PAIRS + "SELECT pair, round(avg(CASE WHEN gain1 > gain2 THEN 1.0::DOUBLE ELSE 0 END), 9) AS win_probability "
       "FROM paired GROUP BY pair")
def win_probability(spark, folder):
    return rounded(stats.win_probability(paired_gains(spark, folder), ["pair"]), ["win_probability"], 9)
