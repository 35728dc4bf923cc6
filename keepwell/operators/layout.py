"""Transaction events laid out by customer (S3, J1–J7, W1, T-1).

Customer features, labels and gaps group and join by customer, and a study builds them again
for every change of its parameters. Laid out once as a bucketed table, events of a customer lie
in one bucket in order of time: aggregates, windows and joins by customer then need no
exchange, and a date window reads only the row groups that hold it.

A bucket is one task, so a customer with more events than a bucket holds on average would make
that task the longest one whatever the cluster. Such customers, fewer than there are buckets, lie
in a table of their own, which goes the usual way over shuffles. Both ways give the same rows,
and every customer is in one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.snapshots import deduplicated_events, snapshot_candidates, transaction_bounds
from keepwell.scratch import written

KEY, ORDER = "customer_id", "invoice_date"


@dataclass(frozen=True)
class Layout:
    """A layout in the folder ``path``; ``table`` is its name in the session's catalog and
    ``bounds`` are the first and last timestamp of all lines, those without a customer too."""

    path: str
    table: str
    buckets: int
    bounds: tuple

    def regular(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def hot(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.regular(spark).schema).parquet(f"{self.path}/hot")


def write_layout(tx: DataFrame, path: str, table: str, buckets: int | None = None) -> Layout:
    """The events of ``tx`` (one row per event id, as ``deduplicated_events`` gives them) as a
    layout of ``buckets`` (as many as a shuffle has partitions, if not given). Lines without a
    customer only count for the bounds. An empty table gives an empty layout; an existing table
    of that name, or files in the folder, are an error."""
    spark = tx.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = transaction_bounds(tx)
    events = written(deduplicated_events(tx), "layout_events")
    counts = written(events.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")), "layout_counts")
    # more than the average of a bucket: fewer customers than buckets, so the broadcast is bounded
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.broadcast(written(counts.where(F.col("n") * buckets > total).select(KEY), "layout_hot")) if buckets > 1 \
        else counts.where("false").select(KEY)
    events.join(heavy, KEY, "left_semi").select(*events.columns).write.parquet(f"{path}/hot")
    (events.join(heavy, KEY, "left_anti").select(*events.columns).repartition(buckets, KEY)
     .write.bucketBy(buckets, KEY).sortBy(ORDER).option("path", f"{path}/regular").format("parquet").saveAsTable(table))
    return Layout(path, table, buckets, bounds)


def attach_layout(spark: SparkSession, layout: Layout) -> Layout:
    """Name an existing layout in the catalog of another session or application: files carry
    no bucket numbers that a plain read would trust."""
    schema = spark.read.parquet(f"{layout.path}/regular").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {layout.table} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({ORDER}) "
              f"INTO {layout.buckets} BUCKETS LOCATION '{layout.path}/regular'")
    return layout


@contextmanager
def joins_by_customer(spark: SparkSession) -> Iterator[None]:
    """Plans made and run inside may join on (split, cutoff, customer) rows that lie by customer
    alone. Spark's default moves them, for fear of few distinct values; a layout has none that
    outweighs a bucket."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def regular_candidates(spark: SparkSession, layout: Layout, params, **options) -> DataFrame:
    """Candidates of the customers in buckets; no exchange if planned in ``joins_by_customer``."""
    return snapshot_candidates(None, params, layout.bounds, bucket_days=None, events=layout.regular(spark), **options)


def layout_candidates(spark: SparkSession, layout: Layout, params, **options) -> DataFrame:
    """``snapshot_candidates`` from a layout, written in one table; ``options`` are its own."""
    hot = written(snapshot_candidates(None, params, layout.bounds, events=layout.hot(spark), **options), "hot_candidates")
    with joins_by_customer(spark):
        regular = written(regular_candidates(spark, layout, params, **options), "regular_candidates")
    return regular.unionByName(hot)
