"""The full batch study as one driver program (no CLI): ingest → validate →
threshold → snapshots → leakage gate → train → score → decide → monitor.

Every stage writes its table under ``out_dir`` (Parquet, CSV for the public
queue and comparisons, JSON for one-row summaries) and later stages read it
back, so a lost executor never forces a recomputation from raw inputs. Beside each
table lies a lineage record: row count, content checksum, parameters, time.
"""

from __future__ import annotations

import json
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.config import EconomicScenario, ModelParams, SnapshotParams, validate_horizon_alignment
from keepwell.operators import decisioning as dec
from keepwell.operators import drift, evaluation as ev
from keepwell.operators.eligibility import check_configured_ceiling, derive_recency_threshold
from keepwell.operators.model import save_bundle, score, train_and_select
from keepwell.operators.normalize import normalize_transactions
from keepwell.operators.snapshots import build_snapshots, eligibility_rollup
from keepwell.operators.validation import validate_transactions, write_counted
from keepwell.scratch import scope
from keepwell.sources.files import read_csv, read_snapshots, write_csv, write_one_row, write_snapshots
from keepwell.sources.lineage import file_fingerprints, lineage_record, table_checksum


def _one_row(spark: SparkSession, record: dict) -> DataFrame:
    return spark.createDataFrame([(json.dumps(record, default=str),)], "record string")


def run_study(spark: SparkSession, transactions: DataFrame, out_dir: str, params: SnapshotParams,
              scenario: EconomicScenario, model_params: ModelParams = ModelParams(), full_data: bool = False,
              segment_map: dict | None = None, random_repetitions: int = 200, salt: str = "customer:",
              source_commit: str = "unknown", source_files: list[str] | None = None) -> dict:
    """Run the study. ``source_files``: the files that ``transactions`` came from, whose SHA-256
    the lineage records hold beside the checksum of the lines and the digests of all parameters.
    Intermediate tables are gone when it returns; what is left is in ``out_dir``."""
    with scope(spark):
        return _run_study(spark, transactions, out_dir, params, scenario, model_params, full_data, segment_map,
                          random_repetitions, salt, source_commit, source_files or [])


def _run_study(spark, transactions, out_dir, params, scenario, model_params, full_data, segment_map, random_repetitions,
               salt, source_commit, source_files) -> dict:
    out = out_dir.rstrip("/")
    validate_horizon_alignment(params.horizon_days, scenario)
    counted = write_counted(normalize_transactions(transactions), f"{out}/transactions")
    tx = spark.read.parquet(f"{out}/transactions")
    summary = validate_transactions(tx, counted=counted)
    write_one_row(_one_row(spark, summary), f"{out}/data_validation")

    threshold = derive_recency_threshold(tx, params)
    check_configured_ceiling(threshold, params, full_data)
    snaps, elig = build_snapshots(tx, params, segment_map=segment_map)
    write_snapshots(snaps, f"{out}/snapshots")
    elig.write.mode("overwrite").parquet(f"{out}/eligibility_summary")
    rollup = eligibility_rollup(spark.read.parquet(f"{out}/eligibility_summary")).first().asDict()
    write_one_row(_one_row(spark, {"threshold": threshold, "rollup": rollup}), f"{out}/eligibility_report")

    snapshots = read_snapshots(spark, f"{out}/snapshots")
    bundle, comparison, scored_test = train_and_select(snapshots, model_params)
    save_bundle(bundle, f"{out}/model")
    comparison.write.mode("overwrite").parquet(f"{out}/model_comparison")
    scored_test.write.mode("overwrite").parquet(f"{out}/scored_test")
    scored = spark.read.parquet(f"{out}/scored_test")

    facts = {}
    for name, table in (("policy_comparison", dec.compare_policies(scored, scenario, params.history_days, random_repetitions)),
                        ("sensitivity_analysis", dec.sensitivity_analysis(scored, scenario, params.history_days))):
        write_csv(table, f"{out}/{name}")
        facts[name] = read_csv(spark, f"{out}/{name}", table.schema)  # the report reads the files
    policies = {r["policy"]: r["expected_net_value"] for r in facts["policy_comparison"].collect()}  # three rows
    spread = facts["sensitivity_analysis"].agg(F.min("expected_net_value").alias("lowest"),
                                               F.max("expected_net_value").alias("highest")).first().asDict()
    ranked, _ = dec.apply_policy(scored, scenario, "expected_value", params.history_days)
    write_csv(dec.hashed_queue(ranked, salt), f"{out}/decision_queue")

    score(bundle, snapshots.filter(F.col("split") == "train")).write.mode("overwrite").parquet(f"{out}/scored_train")
    drift.save_baseline(spark.read.parquet(f"{out}/scored_train"), f"{out}/monitoring_baseline")
    baseline, batch = drift.load_baseline(spark, f"{out}/monitoring_baseline"), drift.count_batch(scored)
    drift.drift_alerts(baseline, batch).write.mode("overwrite").parquet(f"{out}/drift_alerts")
    write_one_row(drift.drift_record(baseline, batch, spark.read.parquet(f"{out}/drift_alerts")), f"{out}/drift_record")
    perf = ev.matured_performance(scored, model_params.budget_fraction)
    if perf is not None:
        perf.write.mode("overwrite").parquet(f"{out}/observed_performance")
    given = {"params": params, "scenario": scenario, "model": model_params}
    given |= {f"{name}_sha256": sha256(repr(value).encode()).hexdigest() for name, value in given.items()}
    sources = table_checksum(transactions).first().asDict()  # of the lines as they were given
    inputs = {"transactions": f"{sources['rows']}:{sources['xor_hash64']}"} | {
        name: digest for path in source_files for name, digest in
        ((r["path"], r["sha256"]) for r in file_fingerprints(spark, path).collect())}  # a row per input file
    for name in ("transactions", "snapshots", "model_comparison", "scored_test", "drift_alerts"):
        sums = table_checksum(spark.read.parquet(f"{out}/{name}")).first()
        write_one_row(lineage_record(spark, source_commit=source_commit, source_mode="full" if full_data else "partial",
                                     inputs=inputs, extra={"table": name, **sums.asDict(), **given}),
                      f"{out}/lineage/{name}")
    record = {"inputs": inputs, "parameters": {k: v for k, v in given.items() if k.endswith("_sha256")}, "validation": summary, "threshold": threshold, "model": bundle.model_name,
              "test_metrics": bundle.test_metrics, "policies": policies, "sensitivity": spread}
    write_one_row(_one_row(spark, record), f"{out}/run_summary")
    return record
