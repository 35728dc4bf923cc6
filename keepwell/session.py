"""Session helpers: sensible defaults and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "keepwell") -> SparkSession:
    """Build (or reuse) a session; on a cluster the launcher's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``. Only a local session without one (tests, local
    runs) gets a scratch folder; on a cluster a folder of one machine would lose
    what executors write, so the setting is required there."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir(configured)
        return configured
    current = context._jsc.sc().getCheckpointDir()  # set via setCheckpointDir
    if current.isDefined():
        # the context stores its own sub-folder; its parent is the shared folder
        folder = current.get().rstrip("/").rsplit("/", 1)[0]
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="keepwell-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    context.setCheckpointDir(local)
    return local
