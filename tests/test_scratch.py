"""Intermediate tables go with their scope or application, and nothing else does."""

import os

import pytest
from pyspark.sql import functions as F

from keepwell import scratch
from keepwell.operators import drift
from keepwell.streaming import jobs


def _folder(df):
    return os.path.dirname(os.path.dirname(df.inputFiles()[0].removeprefix("file://")))


def test_a_scope_deletes_what_was_made_inside(spark):
    kept = scratch.written(spark.range(5), "kept")
    with scratch.scope(spark):
        outer = scratch.written(spark.range(6), "outer")
        with scratch.scope(spark):
            inner = _folder(scratch.written(spark.range(7), "inner"))
            assert os.path.isdir(inner)
        assert not os.path.exists(inner) and outer.count() == 6
        outer = _folder(outer)
    assert not os.path.exists(outer) and kept.count() == 5
    with pytest.raises(ZeroDivisionError), scratch.scope(spark):
        failed = _folder(scratch.written(spark.range(8), "failed"))
        1 / 0
    assert not os.path.exists(failed)


def test_tables_of_an_application(spark, monkeypatch):
    own = _folder(scratch.written(spark.range(5), "own"))
    other = scratch._tables(spark, "app-of-yesterday")
    spark.range(3).write.parquet(f"{other}/x/left")
    assert scratch.delete_tables(spark, "app-of-yesterday") and not os.path.exists(other)
    assert not scratch.delete_tables(spark, "app-of-yesterday") and os.path.isdir(own)
    for name in ("..", "a/b", ""):
        with pytest.raises(ValueError):
            scratch.delete_tables(spark, name or " ")


def test_a_drift_stream_leaves_only_its_alerts(spark, tmp_path):
    ref = spark.range(400).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 50).cast("double").alias("recency_days"),
                                  F.lit("ASIA").alias("geographic_segment"))
    drift.save_baseline(ref, str(tmp_path / "base"))
    for k in range(3):
        ref.withColumn("recency_days", F.col("recency_days") + 100 * k).write.parquet(str(tmp_path / f"in/{k}"))
    stream = (spark.readStream.schema(ref.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    root = scratch._tables(spark, spark.sparkContext.applicationId)
    before = set(os.listdir(root))
    jobs.drift_per_batch(stream, drift.load_baseline(spark, str(tmp_path / "base")), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    alerts = spark.read.schema(drift.ALERT_SCHEMA + ", batch_id long").parquet(str(tmp_path / "out"))
    assert set(os.listdir(root)) == before and alerts.where("issue like '%range%'").count() > 0


def test_intermediate_tables_are_well_compressed(spark, tmp_path):
    from keepwell.plans.stages import stage

    ids = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("event_id"))
    for table in (scratch.written(ids, "ids"), stage(spark, str(tmp_path), "ids", lambda: ids)):
        assert table.count() == 1000 and all(".zstd." in f for f in table.inputFiles())
