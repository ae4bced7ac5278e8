"""Sources, sinks, projections, joins and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import assign_in_order
from tidemark.functions.sql import register_functions
from tidemark.operators import columns as cols
from tidemark.operators import joins, labels, profit
from tidemark.operators.windows import add_lags
from tidemark.plans import panels as p
from tidemark.plans.registry import fresh_folder, query, r
from tidemark.sources import tables as io

# --- sources and sinks ---------------------------------------------------------------------------------------------

MONTH_SCHEMA = "cust bigint, foto_mes int, n_orders bigint, m_price double, m_disc double, c_lines bigint"


@query(p.MONTH + "SELECT * FROM panel_month")
def csv_round_trip(spark, folder):
    path = fresh_folder(spark, "csv")
    io.write_csv(p.panel_month(spark, folder), path)
    return io.read_panel_csv(spark, path, schema=MONTH_SCHEMA)


@query(p.MONTH + "SELECT * FROM panel_month")
def csv_gzip_round_trip(spark, folder):
    path = fresh_folder(spark, "csv-gz")
    io.write_csv(p.panel_month(spark, folder), path, compression="gzip")
    return io.read_panel_csv(spark, path, schema=MONTH_SCHEMA)


@query(p.MONTH + "SELECT cust, foto_mes, m_price FROM panel_month")
def csv_tab_inferred(spark, folder):
    path = fresh_folder(spark, "tsv")
    io.write_csv(p.panel_month(spark, folder), path, sep="\t")
    read = io.read_panel_csv(spark, path, sep="\t", columns=["cust", "foto_mes", "m_price"], partitions=8)
    return read.withColumn("cust", F.col("cust").cast("long"))


@query(
    p.SCORES + """SELECT cust FROM (
        SELECT cust, row_number() OVER (PARTITION BY model ORDER BY prob DESC, cust, period) AS n FROM scores
    ) WHERE n <= 40"""
)
def submission_round_trip(spark, folder):
    chosen = profit.label_top_k(p.scores(spark, folder), 40, by=["model"], key=["cust", "period"])
    path = fresh_folder(spark, "submission")
    io.write_submission(chosen, path, key="cust", only_selected=True)
    return spark.read.csv(path, schema="cust bigint")


@query("SELECT * FROM lineitem WHERE l_linenumber IN (1, 2)")
def scan_periods(spark, folder):
    return io.read_panel(spark, f"{folder}/lineitem.parquet", [1, 2], period="l_linenumber")


@query(p.MONTH + "SELECT * FROM panel_month WHERE foto_mes IN (199601, 199602, 199712)")
def partitioned_panel(spark, folder):
    path = fresh_folder(spark, "panel")
    panel = p.panel_month(spark, folder)
    io.write_panel(panel, path)
    return io.read_panel(spark, path, [199601, 199602, 199712], columns=panel.columns)


@query(p.SCORES + "SELECT cust, period, model, prob FROM scores")
def appended_predictions(spark, folder):
    path = fresh_folder(spark, "predictions")
    scored = p.scores(spark, folder).select("cust", "period", "model", "prob")
    for model in p.MODELS:
        io.append_table(scored.where(F.col("model") == model), path)
    return spark.read.parquet(path)


@query(p.SCORES + "SELECT cust, period, model, prob, model AS written_by FROM scores")
def repeated_append(spark, folder):
    """Every model's predictions are appended, and two of them once more, as after a failure: no row is doubled."""
    path = fresh_folder(spark, "predictions")
    scored = p.scores(spark, folder).select("cust", "period", "model", "prob")
    for model in (*p.MODELS, *p.MODELS[:2]):
        io.append_once(scored.where(F.col("model") == model), path, model)
    return io.read_runs(spark, path, "written_by")


@query(
    """SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderstatus) AS trial_number,
           round(avg(o_totalprice), 2) AS value, CAST(count(*) AS DOUBLE) AS n_orders,
           CAST(year(min(o_orderdate)) AS INTEGER) AS first_train
    FROM orders GROUP BY o_orderpriority, o_orderstatus"""
)
def trial_log(spark, folder):
    groups = p.table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        r(F.avg("o_totalprice"), 2).alias("value"),
        F.count(F.lit(1)).cast("double").alias("n"),
        F.year(F.min("o_orderdate")).alias("first"),
    )
    # One row per priority and status.
    numbered = groups.withColumn("number", F.row_number().over(Window.orderBy("o_orderpriority", "o_orderstatus")))
    trial = F.struct(
        F.col("number").alias("trial_number"),
        F.create_map(F.lit("n_orders"), F.col("n")).alias("params"),
        "value",
        F.struct(F.array("first").alias("mes_train")).alias("configuracion"),
    )
    path = fresh_folder(spark, "trials")
    numbered.agg(F.to_json(F.collect_list(trial)).alias("value")).coalesce(1).write.text(path)
    log = io.read_trials(spark, path)
    return log.select(
        "trial_number",
        "value",
        F.col("params")["n_orders"].alias("n_orders"),
        F.get("configuracion.mes_train", F.lit(0)).alias("first_train"),
    )


@query(p.DAY + "SELECT period, count(*) AS n, round(sum(m_total), 2) AS total FROM panel_day GROUP BY period")
def named_intermediate(spark, folder):
    io.named_table(p.panel_day(spark, folder), "tidemark_panel_day")
    return spark.sql(
        "SELECT period, count(*) AS n, round(sum(m_total), 2) AS total FROM tidemark_panel_day GROUP BY period"
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def union_of_sources(spark, folder):
    orders = p.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    parts = [orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("F", "O", "P")]
    return joins.union_sources(*parts)


@query(p.MONTH + "SELECT * FROM panel_month")
def stored_features(spark, folder):
    path = fresh_folder(spark, "features")
    for _ in range(2):
        stored = io.load_or_build(spark, path, lambda: p.panel_month(spark, folder))
    return stored.select(*p.panel_month(spark, folder).columns)


# --- projections and filters ---------------------------------------------------------------------------------------


@query(
    p.DAY + """SELECT cust, period, c_click, c_view, c_click + c_view AS plain,
        coalesce(c_click, 0) + coalesce(c_view, 0) AS filled,
        greatest(c_click, c_view) AS larger, least(c_click, c_view) AS smaller
    FROM panel_day"""
)
def null_arithmetic(spark, folder):
    click, view = F.col("c_click"), F.col("c_view")
    return p.panel_day(spark, folder).select(
        "cust",
        "period",
        "c_click",
        "c_view",
        (click + view).alias("plain"),
        (F.coalesce(click, F.lit(0)) + F.coalesce(view, F.lit(0))).alias("filled"),
        F.greatest(click, view).alias("larger"),
        F.least(click, view).alias("smaller"),
    )


@query(
    p.DAY + """SELECT cust, period, before, round(m_total - before, 2) AS change, round((m_total - before) * 2, 2) AS twice
    FROM (SELECT *, lag(m_total) OVER (PARTITION BY cust ORDER BY period) AS before FROM panel_day)"""
)
def lateral_aliases(spark, folder):
    panel = p.panel_day(spark, folder)
    return spark.sql(
        """WITH staged AS (
            SELECT cust, period, m_total, lag(m_total) OVER (PARTITION BY cust ORDER BY period) AS before FROM {panel}
        )
        SELECT cust, period, before, round(m_total - before, 2) AS change, round(change * 2, 2) AS twice FROM staged""",
        panel=panel,
    )


@query(p.DAY + "SELECT * EXCLUDE (m_avg, tenure) REPLACE (round(m_total / 10, 3) AS m_total) FROM panel_day")
def star_without_and_replaced(spark, folder):
    panel = p.panel_day(spark, folder).withColumns({"m_total": r(F.col("m_total") / 10, 3)})
    return panel.drop("m_avg", "tenure")


@query(p.DAY + "SELECT cust, period, c_click, c_error, c_purchase, c_signup, c_view, m_max FROM panel_day")
def columns_by_name(spark, folder):
    panel = p.panel_day(spark, folder)
    counts = cols.matching(panel, "^c_.*$")
    money = [c for c in cols.with_prefix(panel, ["m_"]) if c in cols.numeric(panel, exclude=["m_avg", "m_net"])]
    kept = cols.present(panel, ["m_max", "not_there"])
    features = [c for c in cols.all_but(panel, ["cust", "period"]) if c in counts or (c in money and c in kept)]
    trimmed = cols.drop_with_prefix(panel, ["n_", "tenure"])
    return cols.first_columns(trimmed.select("cust", "period", *features), ["m_max"])


@query(
    p.LABELS + """SELECT cust, period, label FROM labelled
    WHERE period IN (3, 5, 8, 13) AND (label = 'BAJA+2' OR m_net < -20) OR label IS NULL AND m_total > 100"""
)
def compound_filter(spark, folder):
    hit = (F.col("label") == "BAJA+2") | (F.col("m_net") < -20)
    return (
        p.labelled(spark, folder)
        .where((F.col("period").isin(3, 5, 8, 13) & hit) | (F.col("label").isNull() & (F.col("m_total") > 100)))
        .select("cust", "period", "label")
    )


@query(p.LABELS + "SELECT DISTINCT period, label, c_click FROM labelled")
def distinct_rows(spark, folder):
    return p.labelled(spark, folder).select("period", "label", "c_click").distinct()


@query(
    p.DAY + """SELECT cust, period, CASE WHEN m_net > 50 THEN 'high' WHEN m_total > 100 THEN 'busy'
        WHEN n_events = 1 THEN 'single' ELSE 'other' END AS kind FROM panel_day"""
)
def conditional_assignment(spark, folder):
    kind = assign_in_order(
        F.lit("other"),
        (F.col("n_events") == 1, F.lit("single")),
        (F.col("m_total") > 100, F.lit("busy")),
        (F.col("m_net") > 50, F.lit("high")),
    )
    return p.panel_day(spark, folder).select("cust", "period", kind.alias("kind"))


TEMPLATE_COLUMNS = ["m_total", "m_max", "c_click"]


@query(
    p.DAY + "SELECT cust, period, "
    + ", ".join(
        f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c in TEMPLATE_COLUMNS for k in (1, 2, 6)
    )
    + " FROM panel_day WINDOW w AS (PARTITION BY cust ORDER BY period)"
)
def feature_templates(spark, folder):
    made = add_lags(p.panel_day(spark, folder), TEMPLATE_COLUMNS, (1, 2, 6))
    return made.select("cust", "period", *cols.matching(made, "_lag[126]$"))


def _narrow_sql():
    def whole(c):
        return (
            f"CASE WHEN min({c}) > -128 AND max({c}) < 127 THEN 'tinyint' "
            f"WHEN min({c}) > -32768 AND max({c}) < 32767 THEN 'smallint' "
            f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483647 THEN 'int' ELSE 'bigint' END AS {c}"
        )

    wholes = ["cust", "foto_mes", "n_orders", "c_lines"]
    return p.MONTH + f"SELECT {', '.join(map(whole, wholes))}, 'float' AS m_price, 'float' AS m_disc FROM panel_month"


@query(_narrow_sql())
def narrowed_types(spark, folder):
    narrow, _ = cols.narrow_types(p.panel_month(spark, folder))
    kinds = [F.lit(f.dataType.simpleString()) for f in narrow.schema]
    # The types are read off the frame; the rows only say that it is not empty.
    return narrow.agg(*[F.max(kind).alias(c) for kind, c in zip(kinds, narrow.columns)])


@query(p.MONTH + "SELECT cust, foto_mes, n_orders, c_lines, m_price::FLOAT::DOUBLE AS m_price, m_disc::FLOAT::DOUBLE AS m_disc FROM panel_month")
def narrowed_values(spark, folder):
    """Whole numbers stay what they are; the others become the nearest float."""
    narrow, _ = cols.narrow_types(p.panel_month(spark, folder))
    return narrow.withColumns({c: F.col(c).cast("double") for c in ("m_price", "m_disc")})


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(DISTINCT {c}) < 0.5 * count(*) AS is_category FROM customer" for c in ("c_name", "c_mktsegment")
    )
)
def text_categories(spark, folder):
    """Which text columns have few values."""
    names = ["c_name", "c_mktsegment"]
    _, found = cols.narrow_types(p.table(spark, folder, "customer").select(*names))
    return spark.createDataFrame([(c, c in found) for c in names], "name string, is_category boolean")


@query(p.DAY + "SELECT cust, period, CAST(coalesce(c_click, 0) + coalesce(c_view, 0) AS DOUBLE) AS both, "
       "round(m_total / nullif(c_click, 0), 6) AS ratio FROM panel_day")
def sql_functions(spark, folder):
    register_functions(spark)
    return spark.sql(
        "SELECT cust, period, sum_without_null(c_click, c_view) AS both, "
        "round(safe_ratio(m_total, c_click), 6) AS ratio FROM {panel}",
        panel=p.panel_day(spark, folder),
    )


@query(
    p.LABELS + """SELECT cust, period, sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END)
        OVER (PARTITION BY cust ORDER BY period)::BIGINT AS gain_so_far FROM labelled"""
)
def sql_function_in_window(spark, folder):
    register_functions(spark)
    return spark.sql(
        "SELECT cust, period, sum(gain_of(label, 'BAJA+2')) OVER (PARTITION BY cust ORDER BY period) AS gain_so_far "
        "FROM {panel}",
        panel=p.labelled(spark, folder),
    )


# --- joins ---------------------------------------------------------------------------------------------------------


@query(
    p.DAY + """SELECT cust, period, mean_total, m_total > mean_total AS above
    FROM panel_day JOIN (SELECT cust, round(avg(m_total), 6) AS mean_total FROM panel_day GROUP BY cust) USING (cust)"""
)
def mean_joined_to_rows(spark, folder):
    joined = joins.with_group_mean(p.panel_day(spark, folder), ["cust"], "m_total", "mean_total")
    mean = r("mean_total")  # equal to m_total where that is the mean, in spite of the order of additions
    return joined.select("cust", "period", mean.alias("mean_total"), (F.col("m_total") > mean).alias("above"))


LATTICE_SQL = p.DAY + """, span AS (SELECT list(DISTINCT period) AS every FROM panel_day),
own AS (SELECT cust, list(period) AS mine FROM panel_day GROUP BY cust),
pairs AS (SELECT cust, mine, unnest(every) AS period FROM own, span),
flagged AS (SELECT cust, period, list_contains(mine, period)::INT AS present FROM pairs)
"""


@query(LATTICE_SQL + "SELECT * FROM flagged")
def lattice_presence(spark, folder):
    return labels.presence(p.panel_day(spark, folder))


@query(
    p.SCORES + """SELECT t.cust, t.period, t.label, s.predicted FROM labelled t LEFT JOIN (
        SELECT cust, period, CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS predicted FROM scores WHERE model = 'b'
    ) s ON t.cust = s.cust AND t.period = s.period"""
)
def update_join(spark, folder):
    predictions = p.scores(spark, folder).where("model = 'b'").withColumn(
        "flag", profit.label_by_threshold("prob", 0.5)
    )
    truth = p.labelled(spark, folder).select("cust", "period", "label")
    return joins.update_column(truth, predictions, ["cust", "period"], "flag", "predicted")


@query(
    p.SCORES + """SELECT a.cust, a.period, a.label, a.prob AS prob_a, b.prob AS prob_b, c.prob AS prob_c,
        round((a.prob + b.prob + c.prob) / 3, 6) AS ensemble
    FROM scores a JOIN scores b ON a.cust = b.cust AND a.period = b.period AND b.model = 'b'
    JOIN scores c ON a.cust = c.cust AND a.period = c.period AND c.model = 'c' WHERE a.model = 'a'"""
)
def models_side_by_side(spark, folder):
    from tidemark.operators.models import mean_of_columns

    scored = p.scores(spark, folder)
    tables = {m: scored.where(F.col("model") == m).drop("model") for m in p.MODELS}
    wide = joins.join_models(tables, ["cust", "period"], "prob", shared=["label"])
    ensemble = mean_of_columns(wide, cols.matching(wide, "^prob_.*$"))
    return ensemble.withColumn("ensemble", r("ensemble"))


@query(
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
    LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def dimension_join(spark, folder):
    nation = p.table(spark, folder, "nation").where("n_nationkey < 20").withColumnRenamed("n_nationkey", "c_nationkey")
    region = p.table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    named = joins.join_dimension(p.table(spark, folder, "customer"), nation, ["c_nationkey"])
    return joins.join_dimension(named, region, ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query(
    p.LABELS + """SELECT cust, period, m_total FROM labelled
    WHERE cust IN (SELECT cust FROM labelled WHERE label = 'BAJA+2')"""
)
def history_of_leavers(spark, folder):
    panel = p.labelled(spark, folder)
    leavers = panel.where("label = 'BAJA+2'")
    return joins.only_keys_of(panel, leavers, ["cust"]).select("cust", "period", "m_total")


@query(
    p.LABELS + """SELECT h.cust, h.period, g.gone, g.size FROM labelled h JOIN (
        SELECT cust, period + 2 AS gone, CASE WHEN m_total > 50 THEN 'large' ELSE 'small' END AS size
        FROM labelled WHERE label = 'BAJA+2'
    ) g ON h.cust = g.cust"""
)
def one_to_many_join(spark, folder):
    panel = p.labelled(spark, folder)
    events = panel.where("label = 'BAJA+2'").select(
        "cust",
        (F.col("period") + 2).alias("gone"),
        F.when(F.col("m_total") > 50, "large").otherwise("small").alias("size"),
    )
    return panel.select("cust", "period").join(events, "cust")


# --- set operations ------------------------------------------------------------------------------------------------


@query(
    p.LABELS + """SELECT cust, CASE WHEN period = 29 THEN 'Z01' ELSE label END AS label FROM labelled
    UNION ALL SELECT cust, 'Z01' AS label FROM labelled WHERE period = 20"""
)
def union_with_relabelled_copy(spark, folder):
    panel = p.labelled(spark, folder)
    first = panel.select("cust", F.when(F.col("period") == 29, "Z01").otherwise(F.col("label")).alias("label"))
    return first.unionByName(panel.where("period = 20").select("cust", F.lit("Z01").alias("label")))
