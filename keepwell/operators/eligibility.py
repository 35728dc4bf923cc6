"""Recency ceiling from training-period repeat-purchase gaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.config import SnapshotParams, _ts
from keepwell.operators.ordered import exact_quantiles
from keepwell.functions.columns import beside
from keepwell.operators.snapshots import _gap_rows, deduplicated_events, positive_events, within
from keepwell.scratch import written


def repeat_gaps(tx: DataFrame, training_cutoff: dt.datetime, bucket_days: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(invoices, gaps): invoice start per (customer, invoice) from positive lines at or
    before the cutoff (filter, then dedup), and the day gaps between a customer's
    consecutive invoices ordered by (date, invoice). Invoices are written once."""
    pos = positive_events(deduplicated_events(within(tx, None, training_cutoff)))
    invoices = pos.groupBy("customer_id", "invoice_no").agg(F.min("invoice_date").alias("d"))
    return invoices, _gap_rows(invoices, ["customer_id"], ["d", "invoice_no"], bucket_days)


def recency_threshold(tx: DataFrame, params: SnapshotParams) -> DataFrame:
    """One row: cutoff, quantile, observed gap quantile (days), integer ceiling,
    number of gaps, training customers and repeat customers."""
    q = params.recency_quantile
    params.validate()
    cutoff = _ts(params.threshold_cutoff)
    invoices, gaps = repeat_gaps(tx, cutoff)
    quant = exact_quantiles(gaps, "gap_days", [q]).agg(F.max("quantile").alias("observed_interval_days"))
    per_customer = invoices.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    counts = per_customer.agg(F.count(F.lit(1)).alias("training_customers"),
                              F.count_if(F.col("_n") >= 2).alias("repeat_customers"),
                              F.sum(F.col("_n") - 1).alias("repeat_intervals"))
    return beside(quant, counts).select(
        F.lit(cutoff.date().isoformat()).alias("training_cutoff"),
        F.lit(q).alias("quantile"),
        "observed_interval_days",
        F.ceil("observed_interval_days").cast("long").alias("max_recency_days"),
        F.col("repeat_intervals").cast("long").alias("repeat_intervals"),
        "training_customers",
        "repeat_customers",
    )


def derive_recency_threshold(tx: DataFrame, params: SnapshotParams) -> dict:
    row = recency_threshold(tx, params).first()
    if row is None or row["repeat_intervals"] in (None, 0):
        raise ValueError("Training period contains no repeat-purchase intervals")
    return row.asDict()


def check_configured_ceiling(derived: dict, params: SnapshotParams, full_data: bool) -> None:
    """On full-data runs the configured ceiling must equal the derived one."""
    if full_data and int(derived["max_recency_days"]) != int(params.max_recency_days):
        raise ValueError(
            f"Configured max_recency_days {params.max_recency_days} differs from the "
            f"training-derived ceiling {derived['max_recency_days']}")
