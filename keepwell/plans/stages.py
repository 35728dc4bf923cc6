"""Materialized intermediate tables shared by the queries of one application.

A stage is written once as Parquet under the shared ``spark.checkpoint.dir``
(never a machine-local folder on a cluster) and read back, which cuts lineage:
later jobs and retries after an executor loss restart from the written table,
not from the raw joins. Keys include the application id, so a new application
never reads a table written by older code.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

from keepwell.scratch import CODEC
from keepwell.session import ensure_checkpoint_dir

_LOCK = threading.RLock()
_DONE: dict[str, str] = {}


def stage_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    return f"{root}/keepwell_stages/{app}/{tag}/{name}"


def stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Return the stage ``name`` for ``sf_dir``, building and writing it on first use."""
    path = stage_path(spark, sf_dir, name)
    with _LOCK:
        if path not in _DONE:
            build().write.mode("overwrite").option("compression", CODEC).parquet(path)
            _DONE[path] = path
    return spark.read.parquet(path)
