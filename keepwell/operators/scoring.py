"""Percentile ranks and the recency/trend heuristic score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.operators.ordered import ordered_prefix
from keepwell.scratch import written


def pct_rank(df: DataFrame, col: str, out: str, ascending: bool = True) -> DataFrame:
    """Average-tie percentile rank ``(below + (ties + 1) / 2) / n`` (nulls stay null).

    Ties are collapsed before ordering (one row per distinct value). The ranks are
    written before they join the rows on the value, so a value that a third of the
    rows share is split by the planner's skew handling (or the ranks are broadcast).
    """
    val = F.col(col) if ascending else -F.col(col)
    keyed = df.withColumn("_pv", val)
    counts = keyed.filter(F.col("_pv").isNotNull()).groupBy("_pv").agg(F.count(F.lit(1)).alias("_ties"))
    ranked = ordered_prefix(counts, [("_pv", True)], sums={"_upto": F.col("_ties")}, rank_col="_vr", totals=True)
    pct = written(ranked.select(
        "_pv",
        (((F.col("_upto") - F.col("_ties")).cast("double") + (F.col("_ties") + 1).cast("double") / F.lit(2.0))
         / F.col("_upto_total").cast("double")).alias(out)), "percentiles")
    return keyed.join(pct, on="_pv", how="left").drop("_pv")


def heuristic_probability(df: DataFrame, out: str = "churn_probability") -> DataFrame:
    """clip(0.7 · pct(recency) + 0.3 · pct(−trend), 0.001, 0.999): recent, growing
    customers score low. A benchmark score that needs no fitted model."""
    r = pct_rank(df, "recency_days", "_r_recency", ascending=True)
    r = pct_rank(r, "recent_purchasing_trend", "_r_trend", ascending=False)
    p = F.lit(0.7) * F.col("_r_recency") + F.lit(0.3) * F.col("_r_trend")
    return r.withColumn(out, F.least(F.greatest(p, F.lit(0.001)), F.lit(0.999))).drop("_r_recency", "_r_trend")
