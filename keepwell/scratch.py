"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from keepwell.session import ensure_checkpoint_dir


#: Codec of intermediate tables: event ids are hex text, which it halves and Spark's default does not.
CODEC = "zstd"
#: Folders made inside the innermost open scope.
_OPEN: ContextVar[list[str] | None] = ContextVar("keepwell_scope", default=None)


def _tables(spark: SparkSession, application: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/keepwell_tables/{application}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    folder = f"{_tables(spark, spark.sparkContext.applicationId)}/{uuid.uuid4().hex}"
    if (made := _OPEN.get()) is not None:
        made.append(folder)
    return f"{folder}/{name}"


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread makes inside are deleted at the end, also after an
    error. What is still needed then must have been written to a place of its own: a result that
    is evaluated later reads them. Scopes nest, and each deletes only what it saw made; tables
    made outside, such as stages and saved baselines, stay."""
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for folder in made:
            _delete(spark, folder)


def delete_tables(spark: SparkSession, application: str | None = None) -> bool:
    """Delete the intermediate tables of an application that has ended (its id), or at the end of a
    session those of this one. False if it has none."""
    application = application or spark.sparkContext.applicationId
    if not re.fullmatch(r"[A-Za-z0-9_-]+", application):
        raise ValueError(f"not an application id: {application}")
    return _delete(spark, _tables(spark, application))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is evaluated once, lineage ends there, a
    lost executor costs one re-read, and the planner knows its size before it plans a join."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Plan nodes that only pick rows and columns of what they read.
_PLAIN = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "RelationV2", "DataSourceV2ScanRelation"}


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself where reading it again costs a scan and no more, else ``written``: for
    operators that look at their input several times."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in _PLAIN or not node.deterministic():
            return written(df, name)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return df
