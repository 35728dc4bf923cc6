import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from keepwell.config import EVENTS_PARAMS, ORDERS_PARAMS, SnapshotParams
from keepwell.operators.eligibility import recency_threshold
from keepwell.operators.normalize import normalize_transactions
from keepwell.operators.snapshots import (
    PointInTimeError,
    build_snapshots,
    customer_features,
    eligibility_summary,
    snapshot_candidates,
)
from keepwell.sources.tables import events_transactions, orders_transactions

from conftest import SF001

CANON = "invoice_no string, stock_code string, description string, quantity double, invoice_date timestamp_ntz, " \
        "unit_price double, customer_id string, country string"
D = dt.datetime


def tx(spark, rows):
    return normalize_transactions(spark.createDataFrame(rows, CANON))


P = SnapshotParams(history_days=10, horizon_days=5, recent_window_days=3, max_recency_days=100,
                   minimum_invoices=2, threshold_cutoff="2024-01-20",
                   split_cutoffs={"train": ["2024-01-20"]})

ROWS = [
    # customer A: boundary events
    ("a1", "S", "x", 1.0, D(2024, 1, 10), 1.0, "A", "France"),   # cutoff - history: outside
    ("a2", "S", "x", 1.0, D(2024, 1, 12), 1.0, "A", "France"),
    ("a3", "S", "x", 1.0, D(2024, 1, 20), 1.0, "A", "France"),   # exactly at cutoff: feature
    ("a4", "S", "x", 1.0, D(2024, 1, 25), 1.0, "A", "France"),   # cutoff + horizon: label
    # customer B: duplicate event with different quantities -> smallest kept
    ("b1", "S", "x", 5.0, D(2024, 1, 15), 1.0, "B", "United Kingdom"),
    ("b1", "S", "x", 2.0, D(2024, 1, 15), 1.0, "B", "United Kingdom"),
    ("b2", "S", "x", 1.0, D(2024, 1, 16), 1.0, "B", "United Kingdom"),
    # customer D: duplicate whose first line is not positive
    ("d1", "S", "x", 0.0, D(2024, 1, 14), 1.0, "D", "Peru"),
    ("d1", "S", "x", 5.0, D(2024, 1, 14), 1.0, "D", "Peru"),
    ("d2", "S", "x", 1.0, D(2024, 1, 15), 1.0, "D", "Peru"),
    # customer F: three equally spaced invoices
    ("f1", "S", "x", 1.0, D(2024, 1, 12), 2.0, "F", "Spain"),
    ("f2", "S", "x", 1.0, D(2024, 1, 14), 2.0, "F", "Spain"),
    ("f3", "S", "x", 1.0, D(2024, 1, 16), 2.0, "F", "Spain"),
    # customer G: two distinct timestamps and a cancellation
    ("g1", "S", "x", 1.0, D(2024, 1, 13), 3.0, "G", "Spain"),
    ("g2", "S", "x", 1.0, D(2024, 1, 17), 3.0, "G", "Spain"),
    ("Cg3", "S", "x", -1.0, D(2024, 1, 18), 3.0, "G", "Spain"),
    # null customer still defines the data bounds
    ("z1", "S", "x", 1.0, D(2024, 1, 1), 1.0, None, "Spain"),
]


@pytest.fixture(scope="module")
def cand(spark):
    return {r["customer_id"]: r for r in snapshot_candidates(tx(spark, ROWS), P).collect()}


def test_boundaries(cand):
    a = cand["A"]
    assert a["number_of_invoices"] == 2
    assert a["first_purchase_date"] == D(2024, 1, 12) and a["last_purchase_date"] == D(2024, 1, 20)
    assert a["recency_days"] == 0.0 and a["customer_tenure_days"] == 8.0
    assert a["label_event_count"] == 1 and a["churn"] == 0
    assert a["label_window_start"] == D(2024, 1, 20, 0, 0, 0, 1)


def test_dedup_keeps_smallest_line(cand):
    assert cand["B"]["quantity_purchased"] == 3.0
    assert cand["B"]["geographic_segment"] == "United Kingdom"


def test_dedup_before_positive_filter(cand, spark):
    # features: d1's first line (qty 0) wins, so d1 is dropped entirely
    assert cand["D"]["number_of_invoices"] == 1
    assert cand["D"]["geographic_segment"] == "Rest of world"
    # threshold: filter first, so d1 keeps its qty-5 line -> two invoices, one gap
    row = recency_threshold(tx(spark, ROWS).filter(F.col("customer_id") == "D"), P).first()
    assert row["repeat_intervals"] == 1 and row["observed_interval_days"] == 1.0


def test_regularity(cand):
    assert cand["F"]["purchase_regularity_days"] == 0.0
    assert cand["G"]["purchase_regularity_days"] is None
    assert cand["G"]["cancellation_rate"] == pytest.approx(1 / 3)
    assert cand["G"]["churn"] == 1


def test_eligibility_reasons(cand):
    assert cand["D"]["eligibility_reason"] == "insufficient_invoices"
    assert cand["A"]["eligibility_reason"] == "eligible" and cand["A"]["is_eligible"]


def test_incomplete_horizon_raises(spark):
    late = P.with_(split_cutoffs={"train": ["2024-01-24"]})
    with pytest.raises(PointInTimeError, match="incomplete"):
        snapshot_candidates(tx(spark, ROWS), late)


def test_gates_pass_and_no_leakage(spark):
    snaps, summary = build_snapshots(tx(spark, ROWS), P)
    assert snaps.filter(~F.col("is_eligible")).count() == 0


def _summary(spark, adapter, params, sf):
    t = normalize_transactions(adapter(spark, sf))
    out = eligibility_summary(snapshot_candidates(t, params)).orderBy("cutoff_date").collect()
    return [(r["total_customers_before_eligibility"], r["eligible_customers"], r["fails_recency_above_maximum"],
             r["fails_insufficient_invoices"], r["primary_insufficient_invoices"],
             round(r["eligible_churn_prevalence"], 6)) for r in out]


def test_orders_preset_matches_published_counts(spark):
    assert _summary(spark, orders_transactions, ORDERS_PARAMS, SF001) == [
        (138, 107, 15, 26, 16, 0.392523), (139, 110, 14, 23, 15, 0.6), (142, 108, 16, 24, 18, 0.481481),
        (141, 113, 14, 22, 14, 0.469027)]


def test_events_preset_matches_published_counts(spark):
    assert _summary(spark, events_transactions, EVENTS_PARAMS, SF001) == [
        (15, 13, 2, 0, 0, 0.307692), (15, 13, 2, 0, 0, 0.230769), (15, 15, 0, 0, 0, 0.133333)]


def test_events_history_incomplete(spark):
    t = normalize_transactions(events_transactions(spark, SF001))
    assert t.count() == 403
    early = EVENTS_PARAMS.with_(split_cutoffs={"train": ["2024-01-13"]})
    reasons = {r["primary_exclusion_reason"] for r in snapshot_candidates(t, early).collect()}
    assert reasons == {"incomplete_observation_history"}


def test_tampered_snapshot_is_rejected(spark):
    from keepwell.operators.snapshots import assert_point_in_time
    t = tx(spark, ROWS)
    snaps = snapshot_candidates(t, P).filter("is_eligible")
    tampered = snaps.withColumn("feature_max_event_date", F.timestamp_add("DAY", F.lit(1), F.col("cutoff_date")))
    with pytest.raises(PointInTimeError, match="feature_after_cutoff"):
        assert_point_in_time(tampered, t, P)
    overlapping = P.with_(split_cutoffs={"train": ["2024-01-18"], "validation": ["2024-01-20"]})
    snaps2 = snapshot_candidates(t, overlapping, strict=False).filter("is_eligible")
    with pytest.raises(PointInTimeError, match="split_order_violations"):
        assert_point_in_time(snaps2, t, overlapping)


def test_small_and_huge_prices(spark):
    """Products are doubles: four lines at 4e-5 add up, and a price of 1e15 ends nothing."""
    rows = [(f"i{i}", f"S{i}", "x", 1.0, D(2024, 1, 12 + i), 0.00004, "T", "Spain") for i in range(4)]
    rows += [("h1", "S", "x", 3.0, D(2024, 1, 13), 1e15, "H", "Spain"), ("h2", "S", "x", 1.0, D(2024, 1, 14), 1e30, "H", "Spain")]
    rows += [("z1", "S", "x", 1.0, D(2024, 1, 1), 1.0, None, "Spain"), ("z2", "S", "x", 1.0, D(2024, 1, 30), 1.0, None, "Spain")]
    out = {r["customer_id"]: r for r in snapshot_candidates(tx(spark, rows), P).collect()}
    assert out["T"]["monetary_value"] == pytest.approx(0.00016)
    assert out["H"]["monetary_value"] == pytest.approx(3e15)


def test_date_windows_reach_the_scan(spark, tmp_path):
    from keepwell.operators.snapshots import cutoff_plan, deduplicated_events, used_lines
    tx(spark, ROWS).write.parquet(str(tmp_path / "tx"))
    plan = deduplicated_events(used_lines(spark.read.parquet(str(tmp_path / "tx")), cutoff_plan(P)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThan(invoice_date" in pushed and "LessThanOrEqual(invoice_date" in pushed


def test_missing_lineage_columns_are_named(spark, cand):
    from keepwell.operators.snapshots import assert_eligibility
    from keepwell.schemas import SchemaError
    with pytest.raises(SchemaError, match="label_window_end"):
        assert_eligibility(spark.createDataFrame([("train",)], "split string"), P)


def _generates_over(node, found):
    """For every Generate of a logical plan, whether an aggregate lies below it."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    under = any([_generates_over(c, found) for c in children])
    if node.nodeName() == "Generate":
        found.append(under)
    return under or node.nodeName() == "Aggregate"


def test_raw_lines_are_not_multiplied_by_cutoffs(spark):
    from keepwell.operators.snapshots import customer_features, cutoff_plan, deduplicated_events, future_labels, used_lines
    params = P.with_(split_cutoffs={"train": ["2024-01-20", "2024-01-22", "2024-01-24"]})
    plan = cutoff_plan(params)
    events = deduplicated_events(used_lines(tx(spark, ROWS), plan))
    for df in (customer_features(None, params, plan, events), future_labels(None, params, plan, events)):
        found = []
        _generates_over(df._jdf.queryExecution().optimizedPlan(), found)
        assert found and all(found)


def test_panes_equal_a_run_per_cutoff(spark):
    """Overlapping windows of 13 cutoffs in one plan against 13 plans of one window."""
    import random
    random.seed(4)
    rows = [(f"{'C' if random.random() < .1 else ''}i{i // 3}", f"s{i % 5}", None, float(random.randint(-1, 4)),
             D(2024, 1, 1) + dt.timedelta(hours=random.randint(0, 24 * 60)), float(random.randint(0, 9)), f"c{i % 7}", random.choice(["Peru", "Spain"]))
            for i in range(400)]
    rows += rows[:40]
    lines = tx(spark, rows)
    days = [f"2024-01-{d}" for d in range(14, 27)]
    params = P.with_(split_cutoffs={"train": days})
    together = snapshot_candidates(lines, params, strict=False)
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    alone = [r for day in days[::4] for r in order(snapshot_candidates(lines, P.with_(split_cutoffs={"train": [day]}), strict=False))]
    assert [r for r in order(together) if r[1].strftime("%Y-%m-%d") in days[::4]] == sorted(alone, key=str) and len(alone) > 20


def test_single_lines_stay_where_they_are(spark):
    """Lines of events that occur once meet no exchange; only repeated ids reach the sorted minimum."""
    from keepwell.operators.snapshots import deduplicated_events
    events = deduplicated_events(tx(spark, ROWS))
    assert {r["invoice_no"]: r["first"]["quantity"] for r in events.collect()}["b1"] == 2.0
    assert events.where("invoice_no = 'd1'").first()["first_positive"]["quantity"] == 5.0
    text = events._jdf.queryExecution().executedPlan().toString()
    alone, _, met = text[text.index("Union"):].partition("SortAggregate")
    assert "LeftAnti" in alone and "Exchange hashpartitioning" not in alone and "Sort [" not in alone and "LeftSemi" in met


def test_refresh_replaces_only_what_new_lines_concern(spark, tmp_path):
    from keepwell.operators.snapshots import refresh_candidates, transaction_bounds
    from keepwell.sources.publish import publish, read_published
    params = P.with_(split_cutoffs={"train": ["2024-01-20", "2024-01-22"], "validation": ["2024-02-10"], "test": ["2024-03-10"]})
    more = [(f"m{i}", "S", "x", 1.0, D(2024, 1, 2) + dt.timedelta(days=i), 2.0, f"M{i % 3}", "Spain") for i in range(75)]
    old = tx(spark, ROWS + more)
    path = str(tmp_path / "candidates")
    assert len(refresh_candidates(old, old, params, path)) == 4
    before = read_published(spark, path)
    was = sorted((tuple(r) for r in before.collect()), key=str)
    added = tx(spark, [("n1", "S", "x", 1.0, D(2024, 3, 4), 7.0, "M1", "Spain"), ("n2", "S", "x", 1.0, D(2024, 3, 5), 7.0, "new", "Spain")])
    now = old.unionByName(added)
    assert refresh_candidates(now, added, params, path, before=transaction_bounds(old)) == [("test", "2024-03-10")]
    after = read_published(spark, path)
    fresh = snapshot_candidates(now, params).withColumn("cutoff_day", F.date_format("cutoff_date", "yyyy-MM-dd"))
    order = lambda df: sorted((tuple(r) for r in df.select(*fresh.columns).collect()), key=str)
    assert order(after) == order(fresh) and order(after) != was
    assert sorted((tuple(r) for r in before.collect()), key=str) == was  # a reader of the old table still has it
    assert len([p for p in (tmp_path / "candidates").iterdir() if p.name.startswith("version-")]) == 2
    # nothing new, nothing written
    assert refresh_candidates(now, added.limit(0), params, path, before=transaction_bounds(now)) == []
    # a refresh that dies midway leaves the table as it was; the table may be read by what replaces it
    boom = F.udf(lambda _: 1 / 0, "string")
    with pytest.raises(Exception, match="division by zero"):
        publish(after.withColumn("eligibility_reason", boom("eligibility_reason")), path, ["split", "cutoff_day"])
    assert order(read_published(spark, path)) == order(fresh)
    with pytest.raises(ValueError, match="not replaced"):
        publish(after, path, ["split", "cutoff_day"], [("test", "2024-03-10")])
    publish(after.where("split = 'test' and is_eligible"), path, ["split", "cutoff_day"], [("test", "2024-03-10")])
    assert order(read_published(spark, path).where("split = 'test'")) == order(fresh.where("split = 'test' and is_eligible"))
    pruned = read_published(spark, path).where("split = 'train'")
    assert "PartitionFilters: [" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def _planned(spark, build):
    """The physical plan of ``build()`` where nothing is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_do_not_move_for_their_customer(spark):
    """Customers meet orders, and the order is the last join, so lines of an invoice lie together."""
    plan = orders_transactions(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    first, *_, last = [line for line in plan.splitlines() if "Join " in line]
    assert "l_orderkey" in first and "l_partkey" not in first
    assert "c_nationkey" in last
    assert not any("LeftOuter" in line and "l_" in line for line in plan.splitlines() if "Join " in line)


def test_rows_are_not_moved_again_once_per_cutoff(spark):
    lines = normalize_transactions(orders_transactions(spark, SF001))
    plan = _planned(spark, lambda: customer_features(lines, ORDERS_PARAMS))
    moved = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert any("split#" in keys for keys in moved)
    assert not [keys for keys in moved if "split#" in keys and ("invoice_no#" in keys or "stock_code#" in keys)]
    # invoices are added up once, for customer totals and gaps
    assert not [keys for keys in moved if "invoice_no#" in keys and "country#" in keys]


def test_an_invoice_of_two_countries_and_panes_counts_once(spark):
    rows = [("a", "S", "x", 1.0, D(2024, 1, 12), 1.0, "A", "France"), ("a", "T", "x", 1.0, D(2024, 1, 19), 2.0, "A", "Japan"),
            ("b", "S", "x", 1.0, D(2024, 1, 16), 4.0, "A", "France"), (None, "S", "x", 1.0, D(2024, 1, 18), 8.0, "A", None),
            ("a", None, "x", 1.0, D(2024, 1, 19), 16.0, "B", "Japan")]
    got = {r["customer_id"]: r for r in customer_features(tx(spark, rows), P).collect()}
    assert (got["A"]["number_of_invoices"], got["A"]["number_of_unique_products"], got["A"]["monetary_value"]) == (3, 2, 15.0)
    assert (got["A"]["recent_invoice_count"], got["A"]["feature_event_count"], got["A"]["recent_spend"]) == (2, 4, 10.0)
    assert (got["B"]["number_of_invoices"], got["B"]["number_of_unique_products"], got["B"]["monetary_value"]) == (1, 1, 16.0)
