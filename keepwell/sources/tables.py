"""Adapters from the driver's star-schema tables to canonical transaction lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation → 8 canonical columns.

    A returned line ('R') becomes a cancellation: invoice prefixed with C and a
    negative quantity. Only the needed columns are read (pruned scans).
    nation is a fixed 25-row dimension, so broadcasting it is size-safe; the
    other joins are left to the planner / AQE, which sees real sizes. Customers meet
    the orders, so lines move once for their part and once for their order; the order comes
    last, so that lines of an invoice lie together in what is written.
    """
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust_country = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey) \
        .select("c_custkey", "n_name")
    placed = orders.join(cust_country, F.col("o_custkey") == F.col("c_custkey"), "left") \
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    returned = F.col("l_returnflag") == F.lit("R")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(placed, F.col("l_orderkey") == placed.o_orderkey)
        .select(
            F.concat(F.when(returned, F.lit("C")).otherwise(F.lit("")),
                     F.col("o_orderkey").cast("string")).alias("invoice_no"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            F.col("p_name").alias("description"),
            F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"),
            F.col("o_orderdate").alias("invoice_date"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )


#: Countries of the events preset, by user: one of each segment of the retail rule and more.
EVENT_COUNTRIES = ("United Kingdom", "France", "Germany", "Japan", "EIRE", "Australia", "unlisted")


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and errors from the event stream as transaction lines.

    An error is a cancellation (invoice prefixed with C, quantity -1).
    """
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return events_to_transactions(ev)


def events_to_transactions(ev: DataFrame) -> DataFrame:
    is_error = F.col("event_type") == F.lit("error")
    return (
        ev.filter(F.col("event_type").isin("purchase", "error"))
        .select(
            F.concat(F.when(is_error, F.lit("C")).otherwise(F.lit("")),
                     F.col("event_id").cast("string")).alias("invoice_no"),
            F.get_json_object("props", "$.k").alias("stock_code"),
            F.lit(None).cast("string").alias("description"),
            F.when(is_error, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("quantity"),
            F.col("ts").alias("invoice_date"),
            F.col("value").alias("unit_price"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.element_at(F.array(*[F.lit(c) for c in EVENT_COUNTRIES]),
                         (F.col("user_id") % len(EVENT_COUNTRIES) + 1).cast("int")).alias("country"),
        )
    )


def nation_region_map(spark: SparkSession, sf_dir: str) -> dict:
    """Country (nation name) → segment (region name); the nation dimension has a
    fixed 25 rows, so collecting it is size-safe."""
    nation = load_table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    region = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")
    return {r["n_name"]: r["r_name"] for r in rows.collect()}
