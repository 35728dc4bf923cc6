"""Python code for tasks that run it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that the
    functions of a task can be imported on every executor."""
    context = spark.sparkContext
    if getattr(context, "_keepwell_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="keepwell-"), "keepwell.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._keepwell_shipped = True
