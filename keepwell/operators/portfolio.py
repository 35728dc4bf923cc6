"""Feature-row contract, row warnings and portfolio decisions.

The online request/response contract is re-aimed at tables: every row is
checked, explained and decided by column expressions, and a portfolio of any
size is ranked by the same value policy as the batch study.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.config import EconomicScenario, SnapshotParams
from keepwell.functions.columns import KNOWN_SEGMENTS
from keepwell.operators import decisioning as dec

# ---- fixed values: feature-row contract (field, minimum, maximum, nullable) --------
CONTRACT_RANGES = (
    ("recency_days", 0, 10_000, False),
    ("purchase_frequency", 0, 10_000, False),
    ("monetary_value", 0, 1_000_000_000, False),
    ("average_order_value", 0, 100_000_000, False),
    ("customer_tenure_days", 0, 100_000, False),
    ("number_of_invoices", 0, 10_000_000, False),
    ("number_of_unique_products", 0, 10_000_000, False),
    ("purchase_regularity_days", 0, 100_000, True),
    ("recent_purchasing_trend", -1_000_000, 1_000_000, False),
    ("cancellation_rate", 0, 1, False),
    ("quantity_purchased", 0, 1_000_000_000, False),
    ("recent_spend", 0, 1_000_000_000, False),
    ("historical_spend", 0, 1_000_000_000, False),
    ("spend_change_ratio", 0, 1_000_000, False),
    ("recent_invoice_count", 0, 10_000_000, False),
    ("historical_invoice_count", 0, 10_000_000, False),
    ("frequency_change_ratio", 0, 1_000_000, False),
)
CONTRACT_TEXT = (("customer_id", 1, 128), ("geographic_segment", 1, 64))
WARN_REGULARITY = "purchase_regularity_days is missing and will be imputed by the model"
WARN_RECENCY = "recency_days exceeds observed tenure; verify feature construction"
WARN_SEGMENT = "unseen geographic segment will be handled as an unknown category"
REASON_OPERATIONAL = "Operational eligibility failed: "
REASON_SINGLE_NONPOSITIVE = "Expected net value is not positive under the configured scenario"
REASON_SINGLE_POSITIVE = "Positive expected net value; portfolio ranking is still required"
# ---------------------------------------------------------------------------------


class PortfolioError(ValueError):
    """The portfolio cannot be decided (duplicate ids, nobody eligible)."""


def _history_flag(df: DataFrame) -> Column:
    if "observation_history_complete" in df.columns:
        return F.coalesce(F.col("observation_history_complete"), F.lit(True))
    return F.lit(True)


def contract_violations(df: DataFrame) -> DataFrame:
    """Adds ``violations`` (comma-joined, empty when valid) and ``is_valid``."""
    checks = []
    for name, lo, hi, nullable in CONTRACT_RANGES:
        if name not in df.columns:
            checks.append(F.lit(f"{name} is missing"))
            continue
        c = F.col(name).cast("double")
        bad_range = (c < F.lit(float(lo))) | (c > F.lit(float(hi))) | F.isnan(c)
        if nullable:
            checks.append(F.when(c.isNotNull() & bad_range, F.lit(f"{name} outside [{lo}, {hi}]")))
        else:
            checks.append(F.when(c.isNull(), F.lit(f"{name} is required"))
                          .when(bad_range, F.lit(f"{name} outside [{lo}, {hi}]")))
    for name, lo, hi in CONTRACT_TEXT:
        if name not in df.columns:
            checks.append(F.lit(f"{name} is missing"))
            continue
        c = F.col(name)
        checks.append(F.when(c.isNull() | (F.length(c) < lo) | (F.length(c) > hi),
                             F.lit(f"{name} length outside [{lo}, {hi}]")))
    arr = F.array_compact(F.array(*checks))
    return df.withColumns({"violations": F.array_join(arr, ","), "is_valid": F.size(arr) == 0})


CONTRACT_FIELDS = frozenset([name for name, *_ in CONTRACT_RANGES] + [name for name, *_ in CONTRACT_TEXT])


def split_by_contract(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the feature contract, quarantined rows with their ``violations``)."""
    checked = contract_violations(df)
    return checked.where("is_valid").drop("violations", "is_valid"), checked.where("not is_valid").drop("is_valid")


def unknown_fields(df: DataFrame, allowed=()) -> list[str]:
    """Columns that neither the contract nor ``allowed`` names."""
    return sorted(set(df.columns) - CONTRACT_FIELDS - set(allowed))


def row_warnings(df: DataFrame, known_segments=KNOWN_SEGMENTS) -> DataFrame:
    """Non-blocking warnings per row, ' | '-joined, with their count; a segment is
    unseen when it is not among the model's known segments."""
    arr = F.array_compact(F.array(
        F.when(F.col("purchase_regularity_days").isNull(), F.lit(WARN_REGULARITY)),
        F.when(F.col("recency_days") > F.col("customer_tenure_days"), F.lit(WARN_RECENCY)),
        F.when(~F.coalesce(F.col("geographic_segment").isin(*known_segments), F.lit(False)), F.lit(WARN_SEGMENT)),
    ))
    return df.withColumns({"warning_count": F.size(arr).cast("long"), "warnings": F.array_join(arr, " | ")})


def operational_reasons(df: DataFrame, params: SnapshotParams) -> Column:
    return F.array_compact(F.array(
        F.when(~_history_flag(df), F.lit("incomplete_observation_history")),
        F.when(F.col("recency_days") > F.lit(params.max_recency_days), F.lit("recency_above_maximum")),
        F.when(F.col("number_of_invoices") < F.lit(params.minimum_invoices), F.lit("insufficient_invoices")),
    ))


def decision_reasons(df: DataFrame, scenario: EconomicScenario, params: SnapshotParams) -> DataFrame:
    """Single-row economics with reason precedence (operational failure, non-positive
    value, positive) for any number of rows; no contact decision is made here."""
    ec = dec.with_economics(df, scenario, params.history_days).withColumn("_ops", operational_reasons(df, params))
    ok = F.size("_ops") == 0
    reason = (F.when(~ok, F.concat(F.lit(REASON_OPERATIONAL), F.array_join("_ops", ", ")))
              .when(F.coalesce(F.col("expected_net_value") <= 0, F.lit(False)), F.lit(REASON_SINGLE_NONPOSITIVE))
              .otherwise(F.lit(REASON_SINGLE_POSITIVE)))
    return ec.select(
        "customer_id", "churn_probability", F.col("estimated_margin_at_risk").alias("margin_at_risk"),
        "expected_net_value", (ok & F.col("economic_eligibility")).alias("economic_eligibility"),
        reason.alias("reason"))


#: Columns of a portfolio that the feature contract does not name: what identifies and describes a
#: snapshot row, its label and eligibility, and scores.
SNAPSHOT_FIELDS = ("customer_id", "split", "cutoff_date", "churn", "churn_probability", "model_version", "observation_history_complete")


def reject_unknown_fields(df: DataFrame, allowed=()) -> None:
    """A portfolio may not have columns beyond the contract, a snapshot's own and ``allowed``."""
    if unknown := unknown_fields(df, [*SNAPSHOT_FIELDS, *allowed]):
        raise PortfolioError(f"unknown fields: {', '.join(unknown)}")


def batch_decisions(df: DataFrame, scenario: EconomicScenario, params: SnapshotParams,
                    check_unique: bool = True, allowed=()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rank the operationally eligible rows with the value policy; ineligible rows
    follow, numbered after the ranked ones in customer-id order. Rows that break the
    feature contract are not decided; columns that neither it nor ``allowed`` names are
    refused. Returns (decisions, one-row campaign summary, quarantined rows).

    One ordered pass gives the number of eligible rows and both numberings."""
    reject_unknown_fields(df, allowed)
    checked = contract_violations(df).withColumn("_ops", operational_reasons(df, params))
    ready = F.col("is_valid") & (F.size("_ops") == 0)
    seen = checked.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(ready).alias("ready")) \
        .agg(F.max("n").alias("most"), F.sum("ready").alias("ready")).first()
    if check_unique and (seen["most"] or 0) > 1:
        raise PortfolioError("customer_id values must be unique")
    if not seen["ready"]:
        raise PortfolioError("no valid row of the portfolio is operationally eligible")
    tagged = checked.where("is_valid").withColumn("_eligible", ready).drop("violations", "is_valid")
    quarantine = checked.where("not is_valid").drop("is_valid", "_ops")
    ranked = dec.ranked_rows(tagged, scenario, "expected_value", params.history_days, candidate="_eligible")
    decided = ranked.select(
        "customer_id", "churn_probability", F.col("estimated_margin_at_risk").alias("margin_at_risk"),
        "expected_net_value", (F.col("_eligible") & F.col("economic_eligibility")).alias("economic_eligibility"),
        "recommended_action", "policy_rank",
        F.when(F.col("_eligible"), F.col("selection_reason"))
        .otherwise(F.concat(F.lit(REASON_OPERATIONAL), F.array_join("_ops", ","))).alias("reason"))
    summary = dec.policy_summary(ranked.where("_eligible"), scenario, "expected_value", "churn" in df.columns)
    return decided, summary, quarantine
