"""Ranking, calibration and budget metrics as distributed aggregates (E1–E11, T-3, W6, W7).

Score-level metrics (ROC-AUC, AP, PR curve) first collapse rows to one row per
distinct score with positive/negative counts; the ordered prefix then runs over
distinct scores only. Row-level outputs (budget selection, gains) use the
ordered prefix on (score desc, tie-break columns).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.ordered import exact_quantiles, ordered_prefix

DEFAULT_TIEBREAK = ("cutoff_date", "customer_id")


def _check_fraction(fraction: float) -> None:
    if not 0 < fraction <= 1:
        raise ValueError("budget fraction must be in (0, 1]")


def budget_count(n: int, fraction: float) -> int:
    """max(1, floor(n · fraction)) – at least one customer is always contacted."""
    _check_fraction(fraction)
    return max(1, int(math.floor(n * fraction)))


def _within_budget(rank: str, fraction: float) -> Column:
    """Whether a rank lies in the budget of its group, whose size is ``<rank>_total``."""
    _check_fraction(fraction)
    return F.col(rank) <= F.greatest(F.lit(1).cast("long"), F.floor(F.col(f"{rank}_total") * F.lit(float(fraction))))


def budget_selection(scored: DataFrame, fraction: float, score: str = "churn_probability",
                     tiebreak=DEFAULT_TIEBREAK) -> DataFrame:
    """Rank by score desc (ties in tie-break order) and flag the top ``budget_count``."""
    ranked = ordered_prefix(scored, [(score, False), *[(c, True) for c in tiebreak]], rank_col="budget_rank", totals=True)
    return ranked.withColumn("selected", _within_budget("budget_rank", fraction)).drop("budget_rank_total")


def score_table(scored: DataFrame, label: str = "churn", score: str = "churn_probability", by=()) -> DataFrame:
    """One row per distinct score (and ``by`` group): positives, negatives, inclusive
    running counts in descending score order (the threshold sweep) and their totals."""
    per = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return sweep(per, score, by)


def sweep(per_score: DataFrame, score: str = "churn_probability", by=()) -> DataFrame:
    """Running and total counts over a table of (``by``, ``score``, pos, neg)."""
    return ordered_prefix(per_score, [(score, False)], sums={"tp": F.col("pos"), "fp": F.col("neg")}, by=by,
                          rank_col="threshold_rank", totals=True)


def _auc() -> Column:
    """Ties counted half: Σ neg·(2·pos_above + pos) / (2·P·N), accumulated exactly in decimal."""
    above = (F.lit(2) * (F.col("tp") - F.col("pos")) + F.col("pos")).cast("decimal(38,0)")
    num = F.sum(F.col("neg").cast("decimal(38,0)") * above).cast("double")
    p, n = F.max("tp_total").cast("double"), F.max("fp_total").cast("double")
    return F.when((p > 0) & (n > 0), num / (F.lit(2.0) * p * n))


def step_precision() -> Column:
    """Σ pos · precision / positives. Terms are added as decimals, so equal tables give equal
    sums in whatever order."""
    term = (F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).cast("decimal(38,18)")
    return F.when(F.max("tp_total") > 0, F.sum(term).cast("double") / F.max("tp_total"))


def roc_auc(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    """Area under ROC, ties counted half."""
    return score_table(scored, label, score).agg(_auc().alias("roc_auc"))


def average_precision(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    """Step-wise AP: Σ over thresholds of (recall gained) × precision at that threshold."""
    return score_table(scored, label, score).agg(step_precision().alias("average_precision"))


def brier(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier_score"))


METRIC_NAMES = ["customers", "contacted", "observed_churners", "tn", "fp", "fn", "tp", "brier_score", "precision", "recall", "f1",
                "recall_at_budget", "precision_at_budget", "lift_at_budget", "budget_fraction", "roc_auc", "average_precision"]


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def evaluate_groups(scored: DataFrame, fraction: float, group: str, label: str = "churn",
                    score: str = "churn_probability", tiebreak=DEFAULT_TIEBREAK) -> DataFrame:
    """Metrics for every value of ``group`` (e.g. several candidate models), a row each. One
    order by (score desc, tie-break) per group serves the budget and the thresholds: the last
    row of a score carries the counts down to that threshold."""
    rows = scored.select(F.col(group).cast("string").alias(group), F.col(label).cast("int").alias("_y"),
                         F.col(score).cast("double").alias("_s"), *tiebreak)
    known = F.col("_s").isNotNull()
    ranked = ordered_prefix(rows, [("_s", False), *[(c, True) for c in tiebreak]], by=[group], rank_col="_rank", totals=True, sums={
        "tp": (known & F.coalesce(F.col("_y") == 1, F.lit(False))).cast("long"),
        "fp": (known & F.coalesce(F.col("_y") == 0, F.lit(False))).cast("long")})
    y, sel = F.col("_y") == 1, _within_budget("_rank", fraction)
    per_score = ranked.groupBy(group, "_s").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(sel).alias("contacted"), F.count_if(y).alias("observed_churners"),
        F.count_if(~y & ~sel).alias("n_tn"), F.count_if(~y & sel).alias("n_fp"), F.count_if(y & ~sel).alias("n_fn"), F.count_if(y & sel).alias("n_tp"),
        F.sum(F.pow(F.col("_s") - F.col("_y"), 2)).alias("squares"), F.count(F.col("_s") - F.col("_y")).alias("n_squares"),
        F.count_if(known & (F.col("_y") == 1)).alias("pos"), F.count_if(known & (F.col("_y") == 0)).alias("neg"),
        *[F.max(c).alias(c) for c in ("tp", "fp", "tp_total", "fp_total")])
    m = per_score.groupBy(group).agg(
        *[F.sum(c).alias(c) for c in ("customers", "contacted", "observed_churners")],
        *[F.sum(f"n_{c}").alias(c) for c in ("tn", "fp", "fn", "tp")],
        (F.sum("squares") / F.sum("n_squares")).alias("brier_score"), _auc().alias("roc_auc"), step_precision().alias("average_precision"))
    tp, contacts = F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")
    actual = (F.col("tp") + F.col("fn")).cast("double")
    base = _share(F.col("observed_churners").cast("double"), F.col("customers").cast("double"))
    m = m.withColumns({"precision": _share(tp, contacts), "recall": _share(tp, actual), "f1": _share(2 * tp, contacts + actual),
                       "budget_fraction": F.lit(float(fraction))})
    return m.withColumns({"recall_at_budget": F.col("recall"), "precision_at_budget": F.col("precision"),
                          "lift_at_budget": _share(F.col("precision"), base)}).select(group, *METRIC_NAMES)


def evaluate_predictions(scored: DataFrame, fraction: float, label: str = "churn",
                         score: str = "churn_probability", tiebreak=DEFAULT_TIEBREAK) -> DataFrame:
    """One row of budget, ranking and calibration metrics (zero-division → 0)."""
    out = evaluate_groups(scored.withColumn("_all", F.lit("all")), fraction, "_all", label, score, tiebreak)
    return out.drop("_all")


def calibration_table(scored: DataFrame, n_bins: int = 8, label: str = "churn",
                      score: str = "churn_probability") -> DataFrame:
    """Quantile bins: edges are exact quantiles of the scores, a score falls in the
    bin counted by inner edges strictly below it; empty bins and unknown scores do not appear."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    scored = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))
    edges = [r["quantile"] for r in exact_quantiles(scored, score, probs).orderBy("q_index").collect()]
    inner = edges[1:-1]
    b = F.lit(0)
    for e in inner:
        b = b + F.when(F.lit(float(e)) < F.col(score), 1).otherwise(0)
    return scored.withColumn("bin", b).groupBy("bin").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def pr_curve(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    return score_table(scored, label, score).select(
        F.col(score).alias("threshold"), "tp", "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("tp_total") > 0, F.col("tp") / F.col("tp_total")).alias("recall"))


def gains_table(scored: DataFrame, label: str = "churn", score: str = "churn_probability",
                tiebreak=DEFAULT_TIEBREAK) -> DataFrame:
    """Cumulative share of churners captured vs share of customers contacted."""
    ranked = ordered_prefix(scored, [(score, False), *[(c, True) for c in tiebreak]],
                            sums={"captured": F.col(label).cast("long")}, rank_col="position", totals=True)
    return ranked.select(
        "position", "captured",
        (F.col("position") / F.col("position_total").cast("double")).alias("population_fraction"),
        (F.col("captured") / F.greatest(F.coalesce("captured_total", F.lit(0)), F.lit(1)).cast("double")).alias("gain"))


def matured_performance(current: DataFrame, fraction: float, label: str = "churn",
                        score: str = "churn_probability") -> DataFrame | None:
    """Metrics on matured labels: needs both columns, ≥ 2 classes after dropping nulls."""
    if label not in current.columns or score not in current.columns:
        return None
    labeled = current.dropna(subset=[label, score])
    classes = labeled.agg(F.count_distinct(label).alias("k")).first()["k"]
    if not classes or classes < 2:
        return None
    return evaluate_predictions(labeled, fraction, label, score)
