import numpy as np
import pandas as pd
import pytest

from keepwell.operators import evaluation as ev
from keepwell.operators.scoring import heuristic_probability, pct_rank


def test_pct_rank_matches_pandas_average_ties(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 5.0, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    got = {r["i"]: r["r"] for r in pct_rank(df, "x", "r").collect()}
    want = pd.Series(vals, dtype="float64").rank(pct=True)
    for i, w in enumerate(want):
        if np.isnan(w):
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(w)
    desc = {r["i"]: r["r"] for r in pct_rank(df, "x", "r", ascending=False).collect()}
    want_desc = (-pd.Series(vals, dtype="float64")).rank(pct=True)
    assert all(desc[i] == pytest.approx(w) for i, w in enumerate(want_desc) if not np.isnan(w))


def test_heuristic_formula(spark):
    rows = [(f"C{i}", float(r), float(t)) for i, (r, t) in enumerate([(10, 0), (20, -1), (30, 5), (10, 2)])]
    df = spark.createDataFrame(rows, "customer_id string, recency_days double, recent_purchasing_trend double")
    got = {r["customer_id"]: r["churn_probability"] for r in heuristic_probability(df).collect()}
    pdf = pd.DataFrame(rows, columns=["customer_id", "recency_days", "recent_purchasing_trend"])
    want = np.clip(0.7 * pdf["recency_days"].rank(pct=True) + 0.3 * (-pdf["recent_purchasing_trend"]).rank(pct=True),
                   0.001, 0.999)
    for cid, w in zip(pdf["customer_id"], want):
        assert got[cid] == pytest.approx(w)


def test_calibration_bins_follow_quantile_edges(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(200), 3)
    y = (rng.random(200) < p).astype(int)
    df = spark.createDataFrame([("2024-01-01", f"C{i}", float(pi), int(yi)) for i, (pi, yi) in enumerate(zip(p, y))],
                               "cutoff_date string, customer_id string, churn_probability double, churn int")
    got = {r["bin"]: r for r in ev.calibration_table(df).collect()}
    edges = np.percentile(p, np.linspace(0, 1, 9) * 100)
    ids = np.searchsorted(edges[1:-1], p)          # inner edges strictly below the score
    for b in np.unique(ids):
        mask = ids == b
        assert got[int(b)]["customers"] == int(mask.sum())
        assert got[int(b)]["mean_predicted"] == pytest.approx(p[mask].mean())
        assert got[int(b)]["observed_rate"] == pytest.approx(y[mask].mean())


def test_pr_curve_points(spark):
    df = spark.createDataFrame([("d", f"C{i}", p, y) for i, (p, y) in
                                enumerate([(.9, 1), (.8, 0), (.8, 1), (.1, 0)])],
                               "cutoff_date string, customer_id string, churn_probability double, churn int")
    pts = sorted((r["threshold"], r["precision"], r["recall"]) for r in ev.pr_curve(df).collect())
    assert pts == [(0.1, 0.5, 1.0), (0.8, pytest.approx(2 / 3), 1.0), (0.9, 1.0, 0.5)]
