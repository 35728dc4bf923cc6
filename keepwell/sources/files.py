"""Transaction files in and out (CSV / Parquet), snapshot and artifact sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SUPPORTED_SUFFIXES = (".csv", ".parquet")
#: A quote inside a quoted field is doubled, as spreadsheets write it.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def _suffix(path: str) -> str:
    base = path.rstrip("/")
    return os.path.splitext(base)[1].lower()


def read_raw_transactions(spark: SparkSession, source: str, multi_line: bool = True) -> DataFrame:
    """Dispatch on suffix: CSV (read as text, parsed leniently later) or Parquet.

    Quoted fields may hold commas, doubled quotes and, with ``multi_line``, line ends. A
    file read so is not split among tasks; give many files, or Parquet, or turn it off
    where no field holds a line end.

    Unknown suffix → ValueError; missing path → FileNotFoundError (checked via the
    Hadoop filesystem, so it works for any cluster storage).
    """
    suffix = _suffix(source)
    if suffix not in SUPPORTED_SUFFIXES:
        raise ValueError(f"Unsupported transaction format: {suffix}")
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(source)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        raise FileNotFoundError(f"Transaction source does not exist: {source}")
    if suffix == ".csv":
        # every column as text; the lenient numeric/date parse happens in normalize
        return spark.read.options(**CSV_OPTIONS, multiLine=multi_line).csv(source)
    return spark.read.parquet(source)


def ingest_transactions(spark: SparkSession, source: str, destination: str | None = None) -> DataFrame:
    """Read, normalize and (optionally) persist canonical transactions as Parquet."""
    from keepwell.operators.normalize import normalize_transactions

    normalized = normalize_transactions(read_raw_transactions(spark, source))
    if destination:
        normalized.write.mode("overwrite").parquet(destination)
        return spark.read.parquet(destination)
    return normalized


def write_snapshots(snapshots: DataFrame, path: str) -> None:
    """Snapshots partitioned by split and cutoff so readers prune partitions; the customers
    of a cutoff are spread over as many tasks as a shuffle has."""
    tasks = int(snapshots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (snapshots.withColumn("cutoff_day", F.date_format("cutoff_date", "yyyy-MM-dd"))
     .repartition("split", "cutoff_day", F.pmod(F.xxhash64("customer_id"), F.lit(tasks)))
     .sortWithinPartitions("customer_id")
     .write.mode("overwrite").partitionBy("split", "cutoff_day").parquet(path))


def read_snapshots(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df.drop("cutoff_day")


def write_one_row(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Summary records (validation, eligibility, metrics, lineage) as one file."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A CSV written by ``write_csv``, with the types of ``schema``."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
