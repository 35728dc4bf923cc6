import datetime as dt

from pyspark.sql import functions as F

from keepwell.sources.files import read_snapshots, write_snapshots
from keepwell.sources.lineage import file_fingerprints, lineage_record, table_checksum
from keepwell.streaming import jobs


def test_snapshot_sink_partition_pruning(spark, tmp_path):
    df = spark.createDataFrame(
        [("train", dt.datetime(2024, 1, 1), "a"), ("test", dt.datetime(2024, 2, 1), "b")],
        "split string, cutoff_date timestamp_ntz, customer_id string")
    path = str(tmp_path / "snap")
    write_snapshots(df, path)
    test = read_snapshots(spark, path, "test")
    assert [r["customer_id"] for r in test.collect()] == ["b"]
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan


def test_checksum_is_order_independent(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string").repartition(3)
    assert table_checksum(a).first() == table_checksum(b).first()
    c = spark.createDataFrame([(1, "x"), (2, "")], "k int, v string")
    assert table_checksum(a).first()["xor_hash64"] != table_checksum(c).first()["xor_hash64"]


def test_file_fingerprint_and_lineage(spark, tmp_path):
    import hashlib
    p = tmp_path / "f.txt"
    p.write_bytes(b"hello")
    row = file_fingerprints(spark, str(p)).first()
    assert row["sha256"] == hashlib.sha256(b"hello").hexdigest()
    rec = lineage_record(spark, source_commit="abc", source_mode="fixture", inputs={"tx": row["sha256"]}).first()
    assert rec["source_commit"] == "abc" and rec["inputs"].startswith("tx=")


def test_stream_dedup_within_watermark(spark, tmp_path):
    src = tmp_path / "events"
    rows = [(1, dt.datetime(2024, 1, 1, 10), 7, "purchase", 2.5, '{"k": 3}'),
            (1, dt.datetime(2024, 1, 1, 10), 7, "purchase", 2.5, '{"k": 3}'),
            (2, dt.datetime(2024, 1, 1, 11), 7, "error", 1.0, '{"k": 4}'),
            (3, dt.datetime(2024, 1, 1, 12), 8, "view", 1.0, '{"k": 5}')]
    spark.createDataFrame(rows, jobs.EVENTS_SCHEMA).write.parquet(str(src))
    stream = spark.readStream.schema(jobs.EVENTS_SCHEMA).parquet(str(src))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    jobs.run_available(jobs.transaction_stream(stream), out, ckpt)
    got = spark.read.parquet(out)
    assert got.count() == 2
    assert got.filter(F.col("is_cancellation")).count() == 1


def test_no_line_is_lost_over_several_batches(spark, tmp_path):
    """Files newest first, one per batch, more of them after a restart: every line is kept, a
    repeat or late, and Spark's own state decides which."""
    src = tmp_path / "events"
    src.mkdir()
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [(i, day(20 - 4 * (i % 5), i % 12), i % 3, "purchase", 1.0 + i, '{"k": 3}') for i in range(40)]
    rows += [rows[3], rows[3], rows[8]]
    rows.sort(key=lambda r: r[1], reverse=True)
    schema = jobs.EVENTS_SCHEMA
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))

    def put(name, some):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(src / name))

    def told():
        read = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
        lines, (repeats, late) = spark.read.parquet(f"{out}/lines"), jobs.account(read, out)
        n = lines.count(), repeats.agg(F.sum("repeats")).first()[0] or 0, late.count()
        assert sum(n) == read.count()
        assert lines.groupBy("event_id").count().where("count > 1").count() == 0
        assert late.join(lines, "event_id").count() == 0
        return n

    for i in range(4):
        put(f"f{i}", rows[i * 11:(i + 1) * 11])
    jobs.run_transactions(stream, out, ckpt)
    first = told()
    assert first[2] > 0
    jobs.run_transactions(stream, out, ckpt)  # a restart finds nothing new
    assert told() == first
    put("f4", [*rows[:3], (90, day(21), 1, "purchase", 2.0, '{"k": 1}'), (91, day(2), 1, "purchase", 2.0, '{"k": 1}')])
    jobs.run_transactions(stream, out, ckpt)  # a restart with old state: repeats are known, new is new, old is late
    assert told() == (first[0] + 1, first[1] + 3, first[2] + 1)


def test_stream_keeps_no_state_of_its_own(spark, tmp_path):
    """What has been seen is in the state store of Spark's checkpoint; the sink holds lines only."""
    src = tmp_path / "events"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 7, "purchase", 2.5, '{"k": 3}')], jobs.EVENTS_SCHEMA).write.parquet(str(src))
    out = tmp_path / "out"
    jobs.run_transactions(spark.readStream.schema(jobs.EVENTS_SCHEMA).parquet(str(src)), str(out), str(tmp_path / "ckpt"))
    assert (tmp_path / "ckpt" / "state").is_dir()
    assert sorted(p.name for p in out.iterdir()) == ["lines"]


def test_checkpoint_folder_is_required_off_a_local_master(spark):
    import pytest
    from types import SimpleNamespace
    from keepwell import session
    nothing = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda k, d=None: d),
                              _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: nothing)))
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)
