import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalar import month_index
from tidemark.operators import labels, stats, windows

C, B1, B2 = "CONTINUA", "BAJA+1", "BAJA+2"

GAP_CASES = {
    "always": {1: C, 2: C, 3: C, 4: C, 5: None, 6: None},
    "leaves after 3": {1: C, 2: B2, 3: B1},
    "returns": {1: B2, 2: B1, 5: None, 6: None},
    "one period": {3: B1},
    "ends at last but one": {4: B2, 5: B1},
    "ends at last": {6: None},
    "alternates": {1: B1, 3: B1, 5: B1},
}


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(c, p, p) for c, periods in GAP_CASES.items() for p in periods]
    return spark.createDataFrame(rows, "cust string, period int, tenure int")


def by_row(df, name="label"):
    return {(r["cust"], r["period"]): r[name] for r in df.collect()}


def test_gap_rule(panel):
    expected = {(c, p): label for c, periods in GAP_CASES.items() for p, label in periods.items()}
    assert by_row(labels.churn_label(panel)) == expected
    assert by_row(labels.churn_label(panel, last=6)) == expected


def test_gap_rule_over_a_year_end(spark):
    panel = spark.createDataFrame([(1, 202011), (1, 202012), (1, 202101), (2, 202103)], "cust int, period int")
    got = by_row(labels.churn_label(panel, index=month_index(F.col("period"))))
    assert got[(1, 202011)] == C and got[(1, 202012)] == B2 and got[(1, 202101)] == B1


def test_join_rule_hides_half_known_labels(panel):
    gap, join = by_row(labels.churn_label(panel)), by_row(labels.churn_label_join(panel))
    for (cust, period), label in join.items():
        if period <= 4:
            assert label == gap[(cust, period)]
    assert gap[("alternates", 5)] == B1 and join[("alternates", 5)] is None
    assert all(label is None for (_, period), label in join.items() if period == 6)


def test_final_rule_forgives_returners(panel):
    got = by_row(labels.churn_label_final(panel))
    assert set(p for _, p in got) == {1, 2, 3, 4}
    assert got[("returns", 2)] == C and got[("returns", 1)] == C
    assert got[("leaves after 3", 3)] == B1 and got[("leaves after 3", 2)] == B2
    gap = by_row(labels.churn_label(panel))
    never_back = {"always", "leaves after 3", "one period", "ends at last but one"}
    assert all(got[k] == gap[k] for k in got if k[0] in never_back)


def test_flags_ahead_match_the_lattice(panel):
    present = {(r["cust"], r["period"]): r["present"] for r in labels.presence(panel).collect()}
    assert len(present) == 7 * 6
    for r in labels.presence_ahead(panel).collect():
        assert r["present_1"] == present.get((r["cust"], r["period"] + 1))
        assert r["present_2"] == present.get((r["cust"], r["period"] + 2))


def test_binary_targets_keep_null(panel):
    rows = labels.binarize_label(labels.churn_label(panel)).collect()
    for r in rows:
        if r["label"] is None:
            assert r["target"] is None and r["target_test"] is None
        else:
            assert r["target"] == (r["label"] != C) and r["target_test"] == (r["label"] == B2)


def test_history_leaves_out_returners(panel):
    history = stats.churn_history(labels.churn_label(panel))
    rows = {(r["cust"], r["period"]): r["periods_until_churn"] for r in history.collect()}
    assert rows == {
        ("leaves after 3", 1): 3, ("leaves after 3", 2): 2, ("leaves after 3", 3): 1,
        ("ends at last but one", 4): 2, ("ends at last but one", 5): 1,
    }


def test_panel_key_check(spark, panel):
    row = windows.check_panel_key(panel).first()
    assert (row["n_rows"], row["repeated_keys"], row["largest_customer"], row["periods"]) == (20, 0, 6, 6)
    doubled = panel.unionByName(panel.where("cust = 'one period'"))
    assert windows.check_panel_key(doubled).first()["repeated_keys"] == 1


def test_history_features_skip_null_but_keep_its_place(spark):
    values = [1.0, None, 3.0, 10.0, None, None, None, None, None, 2.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "cust int, period int, v double")
    rows = windows.add_history(df, ["v"], 6).orderBy("period").collect()
    assert rows[0]["v_tend6"] is None and rows[0]["v_min6"] is None
    assert rows[2]["v_tend6"] == pytest.approx(1.0) and rows[2]["v_avg6"] == 2.0
    # Places 1, 3 and 4 hold 1, 3 and 10.
    assert rows[3]["v_tend6"] == pytest.approx(38 / 14)
    assert rows[3]["v_ratiomax6"] == 1.0
    # Only one known value in the last six rows.
    assert rows[9]["v_max6"] is None
