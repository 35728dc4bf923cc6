import os

from keepwell.config import ORDERS_PARAMS, ORDERS_SCENARIO, ModelParams
from keepwell.plans.study import run_study
from keepwell.sources.tables import nation_region_map, orders_transactions

from conftest import SF001


def test_full_study_writes_every_output(spark, tmp_path):
    out = str(tmp_path / "study")
    rec = run_study(spark, orders_transactions(spark, SF001), out, ORDERS_PARAMS, ORDERS_SCENARIO,
                    ModelParams(logistic_c_values=(1.0,), gbt_max_iter=3),
                    segment_map=nation_region_map(spark, SF001), random_repetitions=10,
                    source_files=[f"{SF001}/lineitem.parquet", f"{SF001}/orders.parquet"])
    # threshold derived from training-period gaps: 0.9 quantile 440.6 days -> 441 (FIXTURES)
    assert rec["threshold"]["max_recency_days"] == 441
    for name in ("transactions", "data_validation", "snapshots", "eligibility_report", "model", "scored_test",
                 "policy_comparison", "sensitivity_analysis", "decision_queue", "monitoring_baseline",
                 "drift_alerts", "run_summary"):
        assert os.path.exists(os.path.join(out, name)), name
    # digests of the lines, of the source files and of every parameter set
    lineage = spark.read.json(os.path.join(out, "lineage", "snapshots")).first()
    assert lineage["inputs"].startswith("file:") and "lineitem.parquet=" in lineage["inputs"] and "transactions=" in lineage["inputs"]
    assert len(lineage["params_sha256"]) == len(lineage["scenario_sha256"]) == 64
    assert rec["inputs"] and set(rec["parameters"]) == {"params_sha256", "scenario_sha256", "model_sha256"}
    queue = spark.read.option("header", True).csv(os.path.join(out, "decision_queue"))
    assert queue.columns[0] == "customer_id" and queue.count() > 0
    assert spark.read.option("header", True).csv(os.path.join(out, "sensitivity_analysis")).count() == 27

