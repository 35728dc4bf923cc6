"""Events laid out by customer give the same candidates, without an exchange."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.config import ORDERS_PARAMS
from keepwell.operators import layout as lay
from keepwell.operators.normalize import normalize_transactions
from keepwell.operators.snapshots import snapshot_candidates
from keepwell.sources.tables import orders_transactions

from conftest import SF001

HOT = "C-hot"


def rows_of(df):
    """Doubles to nine digits: the order of gaps in a deviation may differ."""
    return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def tx(spark):
    """Lines in which one customer holds a third, with copies, and some have none."""
    rows = normalize_transactions(orders_transactions(spark, SF001))
    hot = rows.where(F.xxhash64("event_id") % 2 == 0).withColumn("customer_id", F.lit(HOT))
    hot = hot.withColumn("event_id", F.concat(F.lit("h"), "event_id"))
    return rows.unionByName(hot).unionByName(hot.limit(50)).unionByName(rows.limit(20).withColumn("customer_id", F.lit(None).cast("string"))).cache()


@pytest.fixture(scope="module")
def layout(spark, tx, tmp_path_factory):
    return lay.write_layout(tx, str(tmp_path_factory.mktemp("layout") / "l"), "layout_test", buckets=8)


def test_same_candidates_with_a_hot_customer(spark, tx, layout):
    assert [r[0] for r in layout.hot(spark).select("customer_id").distinct().collect()] == [HOT]
    assert layout.regular(spark).where(F.col("customer_id") == HOT).count() == 0
    got = rows_of(lay.layout_candidates(spark, layout, ORDERS_PARAMS))
    assert got == rows_of(snapshot_candidates(tx, ORDERS_PARAMS)) and any(HOT in r for r in got)


def test_no_exchange_and_windows_reach_the_scan(spark, layout):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a large layout broadcasts nothing
    try:
        with lay.joins_by_customer(spark):
            plan = lay.regular_candidates(spark, layout, ORDERS_PARAMS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "SortMergeJoin" in plan and "LessThanOrEqual(invoice_date" in plan
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_attached_by_another_name(spark, layout):
    other = lay.attach_layout(spark, lay.Layout(layout.path, "layout_again", layout.buckets, layout.bounds))
    assert rows_of(other.regular(spark)) == rows_of(layout.regular(spark))
    assert rows_of(lay.layout_candidates(spark, other, ORDERS_PARAMS)) == rows_of(lay.layout_candidates(spark, layout, ORDERS_PARAMS))


def test_one_bucket_and_no_lines(spark, tx, tmp_path):
    one = lay.write_layout(tx, str(tmp_path / "one"), "layout_one", buckets=1)
    assert one.hot(spark).count() == 0
    assert rows_of(lay.layout_candidates(spark, one, ORDERS_PARAMS)) == rows_of(snapshot_candidates(tx, ORDERS_PARAMS))
    none = lay.write_layout(tx.where("false"), str(tmp_path / "none"), "layout_none", buckets=4)
    assert none.regular(spark).count() == none.hot(spark).count() == 0 and none.bounds == (None, None)
    none = lay.Layout(none.path, none.table, none.buckets, (dt.datetime(1990, 1, 1), dt.datetime(2010, 1, 1)))
    assert lay.layout_candidates(spark, none, ORDERS_PARAMS).count() == 0
