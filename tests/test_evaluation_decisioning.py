import pytest
from pyspark.sql import functions as F

from keepwell.config import EconomicScenario
from keepwell.operators import decisioning as dec
from keepwell.operators import evaluation as ev


def scored(spark, y, p):
    rows = [("2024-01-01", f"C{i}", float(pi), int(yi)) for i, (yi, pi) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "cutoff_date string, customer_id string, churn_probability double, churn int")


def test_budget_metrics_hand_case(spark):
    df = scored(spark, [0, 0, 1, 1, 1], [.1, .2, .7, .8, .9])
    m = ev.evaluate_predictions(df, 0.4).first()
    assert m["contacted"] == 2 and m["precision"] == 1.0
    assert m["recall"] == pytest.approx(2 / 3)
    assert [[m["tn"], m["fp"]], [m["fn"], m["tp"]]] == [[2, 0], [1, 2]]
    assert m["roc_auc"] == 1.0 and m["average_precision"] == 1.0


def test_roc_auc_ties_count_half(spark):
    df = scored(spark, [0, 1, 0, 1], [.5, .5, .2, .9])
    assert ev.roc_auc(df).first()["roc_auc"] == pytest.approx(0.875)


def test_budget_count_floor_one():
    assert ev.budget_count(3, 0.1) == 1
    with pytest.raises(ValueError):
        ev.budget_count(3, 0.0)


def test_economics_hand_values(spark):
    s = EconomicScenario()
    df = spark.createDataFrame([("a", 0.9, 100.0), ("b", 0.9, 1000.0), ("c", 0.9, None)],
                               "customer_id string, churn_probability double, monetary_value double")
    rows = {r["customer_id"]: r for r in dec.with_economics(df, s, 180).collect()}
    assert rows["a"]["estimated_margin_at_risk"] == 20.0
    assert rows["b"]["estimated_margin_at_risk"] == pytest.approx(75.0)
    assert rows["c"]["estimated_margin_at_risk"] is None  # null value stays null
    assert s.expected_contact_cost() == pytest.approx(6.2)
    assert rows["b"]["expected_net_value"] == pytest.approx(0.9 * 0.2 * 75 - 6.2)


@pytest.mark.parametrize("budget,fraction,eligible,expected,binding", [
    (28.0, 0.5, None, 4, "financial_budget"),
    (12000.0, 0.15, None, 3, "operational_capacity"),
    (12000.0, 0.5, 2, 2, "positive_expected_value"),
    (12000.0, 0.1, 2, 2, "joint:operational_capacity+positive_expected_value"),
])
def test_capacity_binding(spark, budget, fraction, eligible, expected, binding):
    s = EconomicScenario(total_budget=budget, max_contact_fraction=fraction)
    limits = dec.contact_limits(F.lit(20), None if eligible is None else F.lit(eligible), s)
    row = spark.range(1).select(*[c.alias(k) for k, c in limits.items()]).first()
    assert row["contact_capacity"] == expected and row["binding_constraint"] == binding


def test_free_contacts_are_limited_by_operations_only(spark):
    s = EconomicScenario(contact_cost=0.0, offer_cost_if_accepted=0.0, max_contact_fraction=0.5)
    row = spark.range(1).select(*[c.alias(k) for k, c in dec.contact_limits(F.lit(20), None, s).items()]).first()
    assert (row["budget_based_contact_capacity"], row["contact_capacity"]) == (20, 10)


def test_bounds_name_the_field():
    with pytest.raises(ValueError, match="max_contact_fraction"):
        EconomicScenario(max_contact_fraction=0.0).validate()
    with pytest.raises(ValueError, match="gross_margin_rate"):
        EconomicScenario(gross_margin_rate=1.5).validate()
    EconomicScenario(contact_cost=0.0, total_budget=0.0, max_contact_fraction=1.0).validate()


def test_policy_rank_ties_text_order_and_invariants(spark):
    df = spark.createDataFrame([("C10", 0.5, 1000.0, 1), ("C2", 0.5, 1000.0, 0), ("C3", 0.9, 10.0, 1)],
                               "customer_id string, churn_probability double, monetary_value double, churn int")
    ranked, summary = dec.apply_policy(df, EconomicScenario(max_contact_fraction=1.0), "churn_probability", 180)
    order = [r["customer_id"] for r in ranked.orderBy("policy_rank").collect()]
    assert order == ["C3", "C10", "C2"]
    s = summary.first()
    assert s["customers_contacted"] <= s["budget_based_contact_capacity"]
    assert s["expected_campaign_cost"] <= 12000.0


def test_sensitivity_grid_rows(spark):
    df = spark.createDataFrame([(f"C{i}", i / 20, 100.0 * i) for i in range(20)],
                               "customer_id string, churn_probability double, monetary_value double")
    out = dec.sensitivity_analysis(df, EconomicScenario(), 180)
    assert out.count() == 27


def test_random_benchmark_shape(spark):
    df = spark.createDataFrame([(f"C{i}", (i % 10) / 10, 100.0 + i, i % 2) for i in range(200)],
                               "customer_id string, churn_probability double, monetary_value double, churn int")
    r = dec.random_benchmark(df, EconomicScenario(), 180, repetitions=50).first()
    assert r["customers_contacted"] == 30 and r["benchmark_repetitions"] == 50
    assert 0.6 < r["lift_at_budget"] < 1.4


def test_hashed_queue_is_salted_prefix(spark):
    import hashlib
    df = spark.createDataFrame([("C1",)], "customer_id string")
    from keepwell.functions.columns import pseudonymize
    got = df.select(pseudonymize(F.col("customer_id"), "s:")).first()[0]
    assert got == hashlib.sha256(b"s:C1").hexdigest()[:16]


def test_random_benchmark_equals_a_full_sort(spark):
    df = spark.createDataFrame([(f"C{i}", (i % 10) / 10, 100.0 + i, i % 2) for i in range(120)],
                               "customer_id string, churn_probability double, monetary_value double, churn int")
    s = EconomicScenario()
    got = dec.random_benchmark(df, s, 180, repetitions=12).first()
    rows = df.select("customer_id", "churn", *[dec.uniform_from_hash(s.random_seed + k, F.col("customer_id")).alias(f"u{k}")
                                               for k in range(12)]).collect()
    hits = [sum(r["churn"] for r in sorted(rows, key=lambda r: (-r[f"u{k}"], r["customer_id"]))[:18]) for k in range(12)]
    assert got["customers_contacted"] == 18 and got["observed_churners_contacted"] == pytest.approx(sum(hits) / 12)


def test_value_policy_reasons_and_null_value(spark):
    df = spark.createDataFrame([("a", 0.9, 5000.0), ("b", 0.01, 10.0), ("c", 0.9, None)],
                               "customer_id string, churn_probability double, monetary_value double")
    ranked, summary = dec.apply_policy(df, EconomicScenario(max_contact_fraction=1.0), "expected_value", 180)
    r = {x["customer_id"]: x for x in ranked.collect()}
    assert r["a"]["recommended_action"] == "contact" and r["a"]["policy_rank"] == 1
    assert r["b"]["selection_reason"] == "Non-positive expected net value"
    # unknown value: not eligible, ranked last, and not called non-positive
    assert r["c"]["policy_rank"] == 3 and not r["c"]["economic_eligibility"]
    assert r["c"]["selection_reason"] == f"Below the rank allowed by {summary.first()['binding_constraint']}"


def test_sensitivity_grid_against_a_plain_loop(spark):
    """Ties, unknown money, the margin floor, and capacities that bind in turn."""
    import numpy as np
    from keepwell.config import EconomicScenario
    from keepwell.operators import decisioning as dec
    rng = np.random.default_rng(11)
    rows = [(f"c{i:03d}", float(np.round(rng.random(), 1)), None if i % 17 == 0 else float(rng.integers(0, 400) * (i % 5))) for i in range(150)]
    df = spark.createDataFrame(rows, "customer_id string, churn_probability double, monetary_value double").repartition(5)
    for scenario in (EconomicScenario(), EconomicScenario(total_budget=60.0, max_contact_fraction=.9),
                     EconomicScenario(total_budget=1e9, max_contact_fraction=1.0, minimum_customer_margin=30.0)):
        want = {}
        for effect, mult, s in dec.sensitivity_grid(scenario):
            unit, values = s.expected_contact_cost(), []
            for _, p, money in rows:
                if money is not None:
                    margin = max(money * s.gross_margin_rate * (s.economic_horizon_days / 180), s.minimum_customer_margin)
                    values.append(p * effect * margin - unit)
            worth = sum(v > 0 for v in values)
            k = int(min(worth, len(rows) if not unit else s.total_budget // unit, np.floor(len(rows) * s.max_contact_fraction), len(rows)))
            want[effect, s.offer_acceptance_probability, mult] = (k, sum(sorted(values, reverse=True)[:k]), k * unit)
        got = {(r[0], r[1], r[2]): (r[3], r[4], r[5]) for r in dec.sensitivity_analysis(df, scenario, 180).collect()}
        assert set(got) == set(want)
        for cell, (k, value, cost) in want.items():
            assert got[cell][0] == k and got[cell][1] == pytest.approx(value, abs=1e-6) and got[cell][2] == pytest.approx(cost)


def test_sensitivity_grid_orders_each_margin_once(spark):
    from keepwell.config import EconomicScenario
    from keepwell.operators import decisioning as dec
    df = spark.range(50).select(F.col("id").cast("string").alias("customer_id"), F.lit(.5).alias("churn_probability"),
                                F.col("id").cast("double").alias("monetary_value"))
    seen = []
    original = dec.ordered_prefix
    dec.ordered_prefix = lambda d, *a, **k: seen.append((d, k)) or original(d, *a, **k)
    try:
        dec.sensitivity_analysis(df, EconomicScenario(), 180)
    finally:
        dec.ordered_prefix = original
    (rows, kw), = seen
    assert kw["by"] == ["mult"] and rows.count() == 3 * 50


def test_unknown_scores_are_in_no_calibration_bin(spark):
    from keepwell.operators import evaluation as ev
    rows = [("2024-01-01", f"c{i}", i / 10 if i < 5 else None, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "cutoff_date string, customer_id string, churn_probability double, churn int")
    assert sum(r["customers"] for r in ev.calibration_table(df, 4).collect()) == 5
