"""The study plan over the driver tables: every registered query as a function
``(spark, sf_dir) -> DataFrame``.

The orders preset (lineitem/orders/part/customer/nation mapped to transaction
lines) drives the batch study; the scored cohort is the eligible test-split
snapshot with the recency/trend heuristic probability, so every decision and
evaluation query is exact without a fitted model. Outputs are presented with
doubles rounded to 6 places and timestamps as text, the same as the oracle SQL.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.config import ORDERS_PARAMS, ORDERS_SCENARIO, EVENTS_PARAMS, ModelParams
from keepwell.functions.columns import beside
from keepwell.operators import decisioning as dec
from keepwell.operators import drift
from keepwell.operators import layout as lay
from keepwell.operators import model
from keepwell.operators import portfolio as pf
from keepwell.operators import evaluation as ev
from keepwell.operators.eligibility import recency_threshold
from keepwell.operators.normalize import normalize_transactions
from keepwell.operators.ordered import exact_quantiles
from keepwell.operators.scoring import heuristic_probability
from keepwell.operators.snapshots import (
    KEYS,
    eligibility_rollup,
    eligibility_summary,
    future_labels,
    leakage_violations,
    snapshot_candidates,
    split_bounds,
)
from keepwell.operators.validation import transaction_eda, validation_summary
from keepwell.plans.stages import stage, stage_path
from keepwell.schemas import NUMERIC_FEATURES
from keepwell.sources.files import read_raw_transactions, write_csv
from keepwell.streaming import jobs as streams
from keepwell.sources.tables import events_transactions, load_table, nation_region_map, orders_transactions

PARAMS = ORDERS_PARAMS
SCENARIO = ORDERS_SCENARIO
BUDGET_FRACTION = ModelParams().budget_fraction
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame) -> DataFrame:
    """Doubles/decimals rounded to 6 places, timestamps as text: stable across engines."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, TS_TEXT)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---- shared stages ----------------------------------------------------------------

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized transaction lines (written once: the ingest sink)."""
    return stage(spark, sf_dir, "transactions",
                 lambda: normalize_transactions(orders_transactions(spark, sf_dir)))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "event_transactions",
                 lambda: normalize_transactions(events_transactions(spark, sf_dir)))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshot candidates of every cutoff (written once: the snapshot sink)."""
    return stage(spark, sf_dir, "candidates",
                 lambda: snapshot_candidates(transactions(spark, sf_dir), PARAMS,
                                             segment_map=nation_region_map(spark, sf_dir)))


_LAYOUTS: dict[str, lay.Layout] = {}


def customer_layout(spark: SparkSession, sf_dir: str) -> lay.Layout:
    """Events of the transactions laid out by customer (written once)."""
    path = stage_path(spark, sf_dir, "layout")
    if path not in _LAYOUTS:
        name = f"customer_events_{hashlib.sha1(path.encode()).hexdigest()[:12]}"
        _LAYOUTS[path] = lay.write_layout(transactions(spark, sf_dir), path, name)
    return _LAYOUTS[path]


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).filter(F.col("is_eligible"))


def cohort(spark: SparkSession, sf_dir: str, split: str = "test") -> DataFrame:
    """Eligible snapshots of one split, scored by the heuristic (written once)."""
    return stage(spark, sf_dir, f"cohort_{split}",
                 lambda: heuristic_probability(snapshots(spark, sf_dir).filter(F.col("split") == split)))


def ranked_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.apply_policy(cohort(spark, sf_dir), SCENARIO, "expected_value", PARAMS.history_days)[0]


# ---- queries ------------------------------------------------------------------------

def q_normalize_transactions(spark, sf_dir):
    return present(normalize_transactions(orders_transactions(spark, sf_dir)))


def q_validation_summary(spark, sf_dir):
    return present(validation_summary(transactions(spark, sf_dir)).drop("_null_dates", "_null_numbers"))


def q_duplicate_event_rate(spark, sf_dir):
    return present(validation_summary(transactions(spark, sf_dir)).select("rows", "duplicate_event_rate"))


def q_transaction_eda(spark, sf_dir):
    return present(transaction_eda(transactions(spark, sf_dir)))


def q_event_transactions(spark, sf_dir):
    return present(normalize_transactions(events_transactions(spark, sf_dir)))


def q_recency_threshold(spark, sf_dir):
    return present(recency_threshold(transactions(spark, sf_dir), PARAMS))


def q_event_recency_threshold(spark, sf_dir):
    """Recency ceiling on the events preset (microsecond timestamps, same-day gaps)."""
    return present(recency_threshold(event_transactions(spark, sf_dir), EVENTS_PARAMS))


FEATURE_COLUMNS = [
    "recency_days", "purchase_frequency", "monetary_value", "average_order_value", "customer_tenure_days",
    "number_of_invoices", "number_of_unique_products", "recent_purchasing_trend", "cancellation_rate",
    "quantity_purchased", "recent_spend", "historical_spend", "spend_change_ratio", "recent_invoice_count",
    "historical_invoice_count", "frequency_change_ratio", "first_purchase_date", "last_purchase_date",
    "feature_event_count",
]


def q_customer_features(spark, sf_dir):
    return present(candidates(spark, sf_dir).select(*KEYS, *FEATURE_COLUMNS))


def q_purchase_regularity(spark, sf_dir):
    return present(candidates(spark, sf_dir).select(*KEYS, "purchase_regularity_days"))


def q_latest_segment(spark, sf_dir):
    return present(candidates(spark, sf_dir).select(*KEYS, "geographic_segment"))


def q_future_label(spark, sf_dir):
    return present(future_labels(transactions(spark, sf_dir), PARAMS))


def _snapshot_rows(eligible: DataFrame) -> DataFrame:
    return present(eligible.select(
        *KEYS, *FEATURE_COLUMNS, "purchase_regularity_days", "geographic_segment", "label_min_event_date",
        "label_max_event_date", "label_event_count", "churn", "feature_window_start", "label_window_start",
        "label_window_end"))


def q_snapshots(spark, sf_dir):
    return _snapshot_rows(snapshots(spark, sf_dir))


def q_bucketed_snapshots(spark, sf_dir):
    """The snapshots from events laid out by customer: no exchange behind the layout."""
    rows = lay.layout_candidates(spark, customer_layout(spark, sf_dir), PARAMS, segment_map=nation_region_map(spark, sf_dir))
    return _snapshot_rows(rows.filter(F.col("is_eligible")))


def q_event_snapshots(spark, sf_dir):
    snap = snapshot_candidates(event_transactions(spark, sf_dir), EVENTS_PARAMS)
    return present(snap.select(*KEYS, "recency_days", "number_of_invoices", "monetary_value",
                               "purchase_regularity_days", "geographic_segment", "label_event_count", "churn",
                               "is_eligible", "eligibility_reason"))


def q_eligibility_reasons(spark, sf_dir):
    return present(candidates(spark, sf_dir).select(
        *KEYS, "observation_history_complete", "is_eligible", "eligibility_reason", "primary_exclusion_reason"))


def q_eligibility_summary(spark, sf_dir):
    return present(eligibility_summary(candidates(spark, sf_dir)))


def q_eligibility_rollup(spark, sf_dir):
    return present(eligibility_rollup(eligibility_summary(candidates(spark, sf_dir))))


def q_leakage_violations(spark, sf_dir):
    """Integrity gate over the written snapshot output and all transaction lines."""
    return present(leakage_violations(snapshots(spark, sf_dir), transactions(spark, sf_dir), PARAMS))


def q_split_bounds(spark, sf_dir):
    return present(split_bounds(snapshots(spark, sf_dir)))


def q_snapshot_eda(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    by = ["split", "cutoff_date"]
    base = snap.groupBy(*by).agg(F.count(F.lit(1)).alias("customers"),
                                 F.avg(F.col("churn").cast("double")).alias("churn_rate"))
    med_r = exact_quantiles(snap, "recency_days", [0.5], by=by) \
        .select(*by, F.col("quantile").alias("median_recency_days"))
    med_v = exact_quantiles(snap, "monetary_value", [0.5], by=by) \
        .select(*by, F.col("quantile").alias("median_monetary_value"))
    return present(base.join(med_r, by).join(med_v, by))


def q_pct_rank_heuristic(spark, sf_dir):
    return present(cohort(spark, sf_dir).select(*KEYS, "recency_days", "recent_purchasing_trend",
                                                "churn_probability"))


def q_budget_topk(spark, sf_dir):
    sel = ev.budget_selection(cohort(spark, sf_dir), BUDGET_FRACTION)
    return present(sel.filter("selected").select(*KEYS, "churn_probability", "budget_rank", "churn"))


def q_budget_metrics(spark, sf_dir):
    m = ev.evaluate_predictions(cohort(spark, sf_dir), BUDGET_FRACTION)
    return present(m.select("customers", "contacted", "observed_churners", "precision", "recall", "f1",
                            "recall_at_budget", "precision_at_budget", "lift_at_budget", "budget_fraction"))


def q_confusion_matrix(spark, sf_dir):
    m = ev.evaluate_predictions(cohort(spark, sf_dir), BUDGET_FRACTION)
    return present(m.select("tn", "fp", "fn", "tp"))


def q_roc_auc(spark, sf_dir):
    return present(ev.roc_auc(cohort(spark, sf_dir)))


def q_average_precision(spark, sf_dir):
    return present(ev.average_precision(cohort(spark, sf_dir)))


def q_brier(spark, sf_dir):
    return present(ev.brier(cohort(spark, sf_dir)))


def q_calibration_table(spark, sf_dir):
    return present(ev.calibration_table(cohort(spark, sf_dir)))


def q_pr_curve(spark, sf_dir):
    return present(ev.pr_curve(cohort(spark, sf_dir)))


def q_gains_table(spark, sf_dir):
    return present(ev.gains_table(cohort(spark, sf_dir)))


def q_margin_and_value(spark, sf_dir):
    df = dec.with_economics(cohort(spark, sf_dir), SCENARIO, PARAMS.history_days)
    return present(df.select("customer_id", "churn_probability", "monetary_value", "estimated_margin_at_risk",
                             "value_at_risk", "expected_net_value", "economic_eligibility"))


def q_campaign_capacity(spark, sf_dir):
    _, summary = dec.apply_policy(cohort(spark, sf_dir), SCENARIO, "expected_value", PARAMS.history_days)
    return present(summary.select("customers", "budget_based_contact_capacity", "operations_based_contact_capacity",
                                  "economically_eligible_customers", "contact_capacity", "binding_constraint"))


def _policy_rows(ranked):
    return present(ranked.select("customer_id", "churn_probability", "expected_net_value", "policy_rank",
                                 "recommended_action", "selection_reason"))


def q_policy_value(spark, sf_dir):
    return _policy_rows(ranked_value(spark, sf_dir))


def q_policy_churn(spark, sf_dir):
    return _policy_rows(dec.apply_policy(cohort(spark, sf_dir), SCENARIO, "churn_probability",
                                         PARAMS.history_days)[0])


SUMMARY_COLUMNS = [
    "policy", "customers", "contact_capacity", "budget_based_contact_capacity",
    "operations_based_contact_capacity", "economically_eligible_customers", "binding_constraint",
    "customers_contacted", "contact_rate", "expected_net_value", "expected_net_value_per_contact",
    "estimated_value_at_risk", "average_churn_probability", "average_estimated_margin_at_risk",
    "expected_campaign_cost", "remaining_budget", "budget_utilization_percentage", "observed_churners_contacted",
    "observed_churners", "recall_at_budget", "precision_at_budget", "lift_at_budget", "scenario_realized_net_value",
]


def q_policy_summary(spark, sf_dir):
    c = cohort(spark, sf_dir)
    rows = [dec.apply_policy(c, SCENARIO, p, PARAMS.history_days)[1].select(*SUMMARY_COLUMNS)
            for p in ("churn_probability", "expected_value")]
    return present(rows[0].unionByName(rows[1]))


def q_policy_random(spark, sf_dir):
    return present(dec.random_benchmark(cohort(spark, sf_dir), SCENARIO, PARAMS.history_days, 200))


def q_sensitivity_grid(spark, sf_dir):
    return present(dec.sensitivity_analysis(cohort(spark, sf_dir), SCENARIO, PARAMS.history_days))


def q_value_by_budget(spark, sf_dir):
    return present(dec.value_by_budget(ranked_value(spark, sf_dir)))


def q_hashed_queue(spark, sf_dir):
    return present(dec.hashed_queue(ranked_value(spark, sf_dir)))


def q_policy_decomposition(spark, sf_dir):
    c = cohort(spark, sf_dir)
    rows = [dec.apply_policy(c, SCENARIO, p, PARAMS.history_days)[1] for p in ("churn_probability",
                                                                            "expected_value")]
    return present(dec.policy_decomposition(rows[0].unionByName(rows[1])))


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test-cutoff candidate (eligible or not), scored by the heuristic."""
    return stage(spark, sf_dir, "portfolio_test",
                 lambda: heuristic_probability(candidates(spark, sf_dir).filter(F.col("split") == "test")))


def known_segments(spark, sf_dir) -> list[str]:
    return sorted(set(nation_region_map(spark, sf_dir).values()) | {"Rest of world"})


def strained_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portfolio with every kind of contract violation: by customer number modulo
    ``STRAIN``, one field is too high, null, too low, empty or too long."""
    df = portfolio(spark, sf_dir)
    m = F.col("customer_id").cast("long") % STRAIN
    changed = {}
    for i, (name, lo, hi, _) in enumerate(pf.CONTRACT_RANGES):
        kind = df.schema[name].dataType
        changed[name] = (F.when(m == i, F.lit(hi + 1).cast(kind)).when(m == 20 + i, F.lit(None).cast(kind))
                         .when(m == 40 + i, F.lit(lo - 1).cast(kind)).otherwise(F.col(name)))
    changed["geographic_segment"] = (F.when(m == 57, F.lit("")).when(m == 58, F.lit(None).cast("string"))
                                     .when(m == 59, F.lit("x" * 65)).otherwise(F.col("geographic_segment")))
    return df.withColumns(changed)


STRAIN = 300


def q_contract_violations(spark, sf_dir):
    return present(pf.contract_violations(strained_portfolio(spark, sf_dir)).select("customer_id", "violations", "is_valid"))


def q_quarantined_rows(spark, sf_dir):
    return present(pf.split_by_contract(strained_portfolio(spark, sf_dir))[1].select("customer_id", "violations"))


def q_row_warnings(spark, sf_dir):
    out = pf.row_warnings(strained_portfolio(spark, sf_dir), known_segments(spark, sf_dir))
    return present(out.select("customer_id", "warning_count", "warnings"))


def q_decision_reasons(spark, sf_dir):
    return present(pf.decision_reasons(portfolio(spark, sf_dir), SCENARIO, PARAMS))


def q_batch_decisions(spark, sf_dir):
    fields = sorted({*pf.CONTRACT_FIELDS, "customer_id", "churn_probability", "observation_history_complete"})
    return present(pf.batch_decisions(strained_portfolio(spark, sf_dir).select(*fields), SCENARIO, PARAMS)[0])


_MODELS: dict = {}


def trained(spark, sf_dir):
    """Train/select/calibrate once per application and data folder; the scored
    test cohort is written as a stage."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        bundle, comparison, scored = model.train_and_select(snapshots(spark, sf_dir), ModelParams())
        comp = stage(spark, sf_dir, "model_comparison", lambda: comparison)
        sc = stage(spark, sf_dir, "scored_cohort", lambda: scored)
        _MODELS[key] = (bundle, comp, sc)
    return _MODELS[key]


def q_model_comparison(spark, sf_dir):
    return present(trained(spark, sf_dir)[1])


def q_scored_cohort(spark, sf_dir):
    return present(trained(spark, sf_dir)[2].select(*KEYS, "churn", "churn_probability", "model_version"))


def q_permutation_importance(spark, sf_dir):
    return present(importances(spark, sf_dir))


def importances(spark, sf_dir):
    """Permutation importances of the fitted model on the test split (written once)."""
    bundle = trained(spark, sf_dir)[0]
    test = snapshots(spark, sf_dir).filter(F.col("split") == "test")
    return stage(spark, sf_dir, "importances", lambda: model.permutation_importance(bundle, test, repeats=ModelParams().permutation_repeats))


def q_matured_performance(spark, sf_dir):
    """Performance of the heuristic on the test cohort once labels matured."""
    perf = ev.matured_performance(cohort(spark, sf_dir), BUDGET_FRACTION)
    return present(perf.select("roc_auc", "average_precision", "brier_score", "recall_at_budget",
                               "precision_at_budget", "lift_at_budget"))


def q_fitted_performance(spark, sf_dir):
    """The same of the fitted model."""
    perf = ev.matured_performance(trained(spark, sf_dir)[2], BUDGET_FRACTION)
    return present(perf.select("roc_auc", "average_precision", "brier_score", "recall_at_budget",
                               "precision_at_budget", "lift_at_budget"))


def _train(spark, sf_dir):
    return snapshots(spark, sf_dir).filter(F.col("split") == "train")


def q_train_medians(spark, sf_dir):
    long = drift.numeric_long(_train(spark, sf_dir), NUMERIC_FEATURES)
    return present(exact_quantiles(long, "value", [0.5], by=["column_name"])
                   .select("column_name", F.col("quantile").alias("median")))


def q_segment_mode(spark, sf_dir):
    return present(_train(spark, sf_dir).agg(F.mode(F.col(model.SEGMENT), deterministic=True).alias("segment")))


def q_class_weights(spark, sf_dir):
    train = _train(spark, sf_dir)
    return present(train.withColumn("weight", model.class_weights(train)).groupBy("churn").agg(
        F.max("weight").alias("weight"), F.count(F.lit(1)).alias("rows")))


#: Calibration with given scalars, so that the formula has an exact answer.
PLATT = (0.8, -0.25)


def q_platt_apply(spark, sf_dir):
    return present(cohort(spark, sf_dir).select(*KEYS, model.calibrated(F.col("churn_probability"), *PLATT).alias("calibrated")))


def q_stream_transactions(spark, sf_dir):
    """The events table replayed as a stream, normalized and deduplicated."""
    # a glob path: the file source treats a plain file path as its own base directory
    src = spark.readStream.schema(streams.EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    root = _stream_root(spark, sf_dir, "transactions")
    streams.run_transactions(src, f"{root}/out", f"{root}/ckpt")
    return present(spark.read.parquet(f"{root}/out/lines"))


def q_stream_accounting(spark, sf_dir):
    """What the stream made of every line of an input in which events recur: copies of
    every 7th event come with the rest, those of every 11th as a second file that is read
    when the watermark has passed them."""
    ev = load_table(spark, sf_dir, "events").select(*[c.split()[0] for c in streams.EVENTS_SCHEMA.split(", ")])
    again = lambda k: ev.where(F.col("event_id") % k == 0)
    root = _stream_root(spark, sf_dir, "accounting")
    for part, events in (("first", ev.unionByName(again(7))), ("second", again(11).unionByName(stale(again(13))))):
        events.write.mode("append").parquet(f"{root}/in/{part}")
        src = spark.readStream.schema(streams.EVENTS_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/in")
        streams.run_transactions(src, f"{root}/out", f"{root}/ckpt")
    read = spark.read.schema(streams.EVENTS_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/in")
    repeats, late = streams.account(read, f"{root}/out")
    kept = spark.read.parquet(f"{root}/out/lines")
    fate = lambda df, name, n: df.groupBy("customer_id").agg(n.cast("long").alias("lines")).select(
        "customer_id", F.lit(name).alias("fate"), "lines")
    owner = kept.select("event_id", "customer_id")
    return present(fate(kept, "kept", F.count(F.lit(1))).unionByName(fate(late, "late", F.count(F.lit(1)))).unionByName(
        fate(repeats.join(owner, "event_id"), "repeated", F.sum("repeats"))))


def stale(events: DataFrame) -> DataFrame:
    """New events (ids of their own) from ten years before."""
    return events.withColumns({"event_id": -F.col("event_id") - 1, "ts": F.col("ts") - F.expr("INTERVAL 10 YEARS")})


def _stream_root(spark, sf_dir, name):
    """Stage tables belong to an application, so streams over them do too."""
    return stage_path(spark, sf_dir, f"stream_{name}")


def _scored_stream(spark, sf_dir):
    cand = candidates(spark, sf_dir)
    return spark.readStream.schema(cand.schema).parquet(stage_path(spark, sf_dir, "candidates")) \
        .filter(F.col("split") == "test")


def q_stream_scoring(spark, sf_dir):
    """Test-cutoff candidates streamed through the fitted model, contract and economics."""
    bundle = trained(spark, sf_dir)[0]
    root = _stream_root(spark, sf_dir, "scoring")
    out = streams.scoring_stream(_scored_stream(spark, sf_dir), bundle, SCENARIO, PARAMS, known_segments(spark, sf_dir))
    streams.run_available(out, f"{root}/out", f"{root}/ckpt")
    return present(spark.read.parquet(f"{root}/out"))


#: A given scorecard, so that streamed scores have an exact answer: feature -> (mean, standard
#: deviation, coefficient), and coefficients of segments (the last one occurs nowhere).
SCORECARD = {"recency_days": (90.0, 60.0, 0.9), "purchase_frequency": (4.0, 3.0, -0.4), "monetary_value": (500_000.0, 400_000.0, -0.3),
             "purchase_regularity_days": (40.0, 25.0, 0.25), "recent_purchasing_trend": (0.0, 2.0, -0.15)}
SCORECARD_SEGMENTS = {"ASIA": 0.2, "EUROPE": -0.3, "AFRICA": 0.1, "ATLANTIS": 9.0}
SCORECARD_MEDIANS, SCORECARD_INTERCEPT = {"purchase_regularity_days": 35.0}, -0.2


def q_stream_scoring_given(spark, sf_dir):
    """The same stream scored with the given scorecard."""
    train = _train(spark, sf_dir)
    bundle = model.given_bundle(train, SCORECARD, SCORECARD_INTERCEPT, PLATT, SCORECARD_SEGMENTS, SCORECARD_MEDIANS)
    root = _stream_root(spark, sf_dir, "scoring_given")
    out = streams.scoring_stream(_scored_stream(spark, sf_dir), bundle, SCENARIO, PARAMS, known_segments(spark, sf_dir))
    streams.run_available(out, f"{root}/out", f"{root}/ckpt")
    return present(spark.read.parquet(f"{root}/out"))


def q_stream_drift(spark, sf_dir):
    """The shifted test cohort as a stream, drift alerts per micro-batch against a saved baseline."""
    cur = cohort(spark, sf_dir, "test")
    src = spark.readStream.schema(cur.schema).parquet(stage_path(spark, sf_dir, "cohort_test"))
    root = _stream_root(spark, sf_dir, "drift")
    streams.drift_per_batch(shifted(src), baseline(spark, sf_dir), f"{root}/out", f"{root}/ckpt")
    return present(spark.read.schema(drift.ALERT_SCHEMA + ", batch_id long").parquet(f"{root}/out"))


def q_sensitivity_range(spark, sf_dir):
    """Report fact: range of scenario value over the sensitivity grid."""
    grid = dec.sensitivity_analysis(cohort(spark, sf_dir), SCENARIO, PARAMS.history_days)
    return present(grid.agg(F.min("expected_net_value").alias("minimum_value"),
                            F.max("expected_net_value").alias("maximum_value"),
                            F.count(F.lit(1)).alias("configurations")))


def q_snapshot_facts(spark, sf_dir):
    """Report facts over eligible snapshots: rows, customers, cutoff range, churn rate."""
    snap = snapshots(spark, sf_dir)
    return present(snap.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("customer_id").alias("customers"),
                            F.min("cutoff_date").alias("first_cutoff"), F.max("cutoff_date").alias("last_cutoff"),
                            F.avg(F.col("churn").cast("double")).alias("churn_rate")))


def q_policy_lift_comparison(spark, sf_dir):
    """Report input: value policy vs churn policy lift and value, side by side."""
    c = cohort(spark, sf_dir)
    churn, value = (dec.apply_policy(c, SCENARIO, p, PARAMS.history_days)[1].select(
        F.col("lift_at_budget").alias(f"{name}_policy_lift"), F.col("expected_net_value").alias(f"{name}_policy_value"))
        for p, name in (("churn_probability", "churn"), ("expected_value", "value")))
    return present(beside(churn, value))


def comparison(spark, sf_dir):
    """Summaries of the random, churn and value policies (written once)."""
    return stage(spark, sf_dir, "policy_comparison", lambda: dec.compare_policies(cohort(spark, sf_dir), SCENARIO, PARAMS.history_days, 200))


def q_policy_table(spark, sf_dir):
    """Report table (R1) of the random, churn and value policies."""
    return present(dec.policy_table(comparison(spark, sf_dir)))


_BASELINES: dict = {}


def baseline(spark, sf_dir) -> drift.Baseline:
    """The train cohort's baseline, saved once and loaded by every query that compares with it."""
    path = stage_path(spark, sf_dir, "drift_baseline")
    if path not in _BASELINES:
        drift.save_baseline(cohort(spark, sf_dir, "train"), path)
        _BASELINES[path] = drift.load_baseline(spark, path)
    return _BASELINES[path]


def shifted(df: DataFrame) -> DataFrame:
    """A cohort with every kind of drift: higher money, missing regularity, text among
    quantities, a segment the reference does not have, and a column that is gone."""
    last = F.substring("customer_id", -1, 1)
    return df.withColumns({
        "monetary_value": F.col("monetary_value") * 3,
        "purchase_regularity_days": F.when(last.isin("1", "3", "5", "7", "9"), F.col("purchase_regularity_days")),
        "quantity_purchased": F.when(last == "7", F.lit("n/a")).otherwise(F.col("quantity_purchased").cast("string")),
        "geographic_segment": F.when(F.col("geographic_segment") == "ASIA", F.lit("OCEANIA")).otherwise(F.col("geographic_segment")),
    }).drop("spend_change_ratio")


_BATCHES: dict = {}


def _current(spark, sf_dir) -> drift.Batch:
    key = stage_path(spark, sf_dir, "shifted")
    if key not in _BATCHES:
        _BATCHES[key] = drift.count_batch(shifted(cohort(spark, sf_dir, "test")))
    return _BATCHES[key]


def q_baseline_stats(spark, sf_dir):
    return present(drift.baseline_stats(baseline(spark, sf_dir)))


def q_baseline_quantiles(spark, sf_dir):
    return present(drift.baseline_quantiles(baseline(spark, sf_dir)))


def q_baseline_categories(spark, sf_dir):
    return present(baseline(spark, sf_dir).categories)


def q_psi(spark, sf_dir):
    return present(drift.psi(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_ks(spark, sf_dir):
    return present(drift.ks_statistic(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_range_and_missing(spark, sf_dir):
    return present(drift.range_and_missing(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_new_categories(spark, sf_dir):
    return present(drift.new_categories(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_drift_alerts(spark, sf_dir):
    return present(drift.drift_alerts(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_drift_record(spark, sf_dir):
    return present(drift.drift_record(baseline(spark, sf_dir), _current(spark, sf_dir)))


def q_compare_policies(spark, sf_dir):
    """Random, churn and value policies side by side."""
    return present(comparison(spark, sf_dir).select(*SUMMARY_COLUMNS))


#: Scenarios in which the budget, the value of a contact, and all limits at once bind.
BRANCHES = (
    SCENARIO.with_(scenario_name="tight_budget", total_budget=150.0),
    SCENARIO.with_(scenario_name="costly_contact", contact_cost=900.0, max_contact_fraction=1.0, total_budget=1e9),
    SCENARIO.with_(scenario_name="free_contact", contact_cost=0.0, offer_cost_if_accepted=0.0, max_contact_fraction=1.0),
)


def _branches(spark, sf_dir):
    c = cohort(spark, sf_dir)
    return [(s.scenario_name, *dec.apply_policy(c, s, "expected_value", PARAMS.history_days)) for s in BRANCHES]


def _stacked(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_policy_branches(spark, sf_dir):
    return present(_stacked([r.select("economic_scenario", "customer_id", "policy_rank", "recommended_action", "selection_reason")
                             for _, r, _ in _branches(spark, sf_dir)]))


def q_capacity_branches(spark, sf_dir):
    return present(_stacked([s.select(F.lit(name).alias("economic_scenario"), *SUMMARY_COLUMNS)
                             for name, _, s in _branches(spark, sf_dir)]))


def q_top_importances(spark, sf_dir):
    return present(model.top_importances(importances(spark, sf_dir)))


def q_csv_round_trip(spark, sf_dir):
    """Raw lines (with quotes, commas and line ends in the description) written as CSV,
    read back and normalized."""
    awkward = F.concat(F.lit('SET "'), F.col("description"), F.lit('", LARGE\nsecond line, "'), F.col("country"), F.lit('"'))
    raw = orders_transactions(spark, sf_dir).withColumn("description", awkward)
    path = f"{stage_path(spark, sf_dir, 'raw_lines')}.csv"
    write_csv(raw, path)
    return present(normalize_transactions(read_raw_transactions(spark, path)))


QUERIES = {
    "normalize_transactions": q_normalize_transactions,
    "event_transactions": q_event_transactions,
    "validation_summary": q_validation_summary,
    "duplicate_event_rate": q_duplicate_event_rate,
    "transaction_eda": q_transaction_eda,
    "recency_threshold": q_recency_threshold,
    "event_recency_threshold": q_event_recency_threshold,
    "customer_features": q_customer_features,
    "purchase_regularity": q_purchase_regularity,
    "latest_segment": q_latest_segment,
    "future_label": q_future_label,
    "snapshots": q_snapshots,
    "bucketed_snapshots": q_bucketed_snapshots,
    "event_snapshots": q_event_snapshots,
    "eligibility_reasons": q_eligibility_reasons,
    "eligibility_summary": q_eligibility_summary,
    "eligibility_rollup": q_eligibility_rollup,
    "leakage_violations": q_leakage_violations,
    "split_bounds": q_split_bounds,
    "snapshot_eda": q_snapshot_eda,
    "pct_rank_heuristic": q_pct_rank_heuristic,
    "budget_topk": q_budget_topk,
    "budget_metrics": q_budget_metrics,
    "confusion_matrix": q_confusion_matrix,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "brier": q_brier,
    "calibration_table": q_calibration_table,
    "pr_curve": q_pr_curve,
    "gains_table": q_gains_table,
    "margin_and_value": q_margin_and_value,
    "campaign_capacity": q_campaign_capacity,
    "policy_value": q_policy_value,
    "policy_churn": q_policy_churn,
    "policy_summary": q_policy_summary,
    "policy_random": q_policy_random,
    "sensitivity_grid": q_sensitivity_grid,
    "value_by_budget": q_value_by_budget,
    "hashed_queue": q_hashed_queue,
    "policy_decomposition": q_policy_decomposition,
    "baseline_stats": q_baseline_stats,
    "baseline_quantiles": q_baseline_quantiles,
    "baseline_categories": q_baseline_categories,
    "psi": q_psi,
    "ks": q_ks,
    "range_and_missing": q_range_and_missing,
    "new_categories": q_new_categories,
    "drift_alerts": q_drift_alerts,
    "drift_record": q_drift_record,
    "contract_violations": q_contract_violations,
    "quarantined_rows": q_quarantined_rows,
    "row_warnings": q_row_warnings,
    "decision_reasons": q_decision_reasons,
    "batch_decisions": q_batch_decisions,
    "model_comparison": q_model_comparison,
    "scored_cohort": q_scored_cohort,
    "permutation_importance": q_permutation_importance,
    "top_importances": q_top_importances,
    "fitted_performance": q_fitted_performance,
    "matured_performance": q_matured_performance,
    "train_medians": q_train_medians,
    "segment_mode": q_segment_mode,
    "class_weights": q_class_weights,
    "platt_apply": q_platt_apply,
    "compare_policies": q_compare_policies,
    "policy_branches": q_policy_branches,
    "capacity_branches": q_capacity_branches,
    "csv_round_trip": q_csv_round_trip,
    "sensitivity_range": q_sensitivity_range,
    "policy_table": q_policy_table,
    "snapshot_facts": q_snapshot_facts,
    "policy_lift_comparison": q_policy_lift_comparison,
    "stream_transactions": q_stream_transactions,
    "stream_accounting": q_stream_accounting,
    "stream_scoring": q_stream_scoring,
    "stream_scoring_given": q_stream_scoring_given,
    "stream_drift": q_stream_drift,
}
