"""Tables that are replaced part by part while they are read.

A published table is a folder of versions and manifests. A version holds the partitions that
one refresh wrote; a manifest, one small JSON file, names the folder of every partition.
A refresh writes its partitions to a new version first and then puts the next manifest in
place by one rename. Readers follow the newest manifest, so they see the old table or the new
one, never half of either, and a query that began on the old one finds its files. A refresh
that dies leaves a version that no manifest names.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"manifest-(\d{8})\.json$")


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _newest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """(number, content) of the newest manifest; 0 and an empty one before the first."""
    jvm, system, folder = _files(spark, path)
    if not system.exists(folder):
        return 0, {"keys": [], "partitions": {}}
    numbers = [int(m[1]) for s in system.listStatus(folder) if (m := _NAME.search(s.getPath().getName()))]
    if not numbers:
        return 0, {"keys": [], "partitions": {}}
    lines = spark.read.text(f"{path}/manifest-{max(numbers):08d}.json", wholetext=True).first()[0]
    return max(numbers), json.loads(lines)


def _put(spark: SparkSession, path: str, number: int, content: dict) -> None:
    jvm, system, _ = _files(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(f"{path}/_{uuid.uuid4().hex}")
    out = system.create(hidden)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-{number:08d}.json")
    if system.exists(place) or not system.rename(hidden, place):
        raise RuntimeError(f"another refresh has published {place.getName()}; this one changed nothing")


def publish(rows: DataFrame, path: str, keys: list[str], replaces: list[tuple[str, ...]] | None = None) -> list[tuple[str, ...]]:
    """Replace the partitions ``replaces`` (values of ``keys`` as text; all if not given) of the
    table at ``path`` by ``rows``, in one step for readers. A replaced partition of no rows is
    gone. Rows of other partitions are an error. Returns the partitions written."""
    spark = rows.sparkSession
    path = path.rstrip("/")
    number, old = _newest(spark, path)
    if old["keys"] not in ([], list(keys)):
        raise ValueError(f"the table is partitioned by {old['keys']}")
    version = f"version-{uuid.uuid4().hex}"
    rows.write.partitionBy(*keys).parquet(f"{path}/{version}")
    made = sorted(tuple(r) for r in spark.read.schema(rows.schema).parquet(f"{path}/{version}")
                  .select(*[F.col(k).cast("string") for k in keys]).distinct().collect())  # a row per partition
    if replaces is not None and not set(made) <= {tuple(r) for r in replaces}:
        raise ValueError(f"rows for partitions that are not replaced: {sorted(set(made) - set(map(tuple, replaces)))}")
    gone = None if replaces is None else {json.dumps(r) for r in map(list, replaces)}
    kept = {k: v for k, v in old["partitions"].items() if gone is not None and k not in gone}
    now = kept | {json.dumps(list(m)): version for m in made}
    _put(spark, path, number + 1, {"keys": list(keys), "partitions": now, "schema": rows.schema.json()})
    return made


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the newest manifest. A path that nothing was published to is an error."""
    from functools import reduce

    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    number, manifest = _newest(spark, path)
    if not number:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema, keys = StructType.fromJson(json.loads(manifest["schema"])), manifest["keys"]
    versions: dict[str, list] = {}
    for values, version in sorted(manifest["partitions"].items()):
        versions.setdefault(version, []).append(json.loads(values))
    parts = []
    for version, held in versions.items():
        wanted = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(F.lit(v)) for k, v in
                                                                         zip(keys, values, strict=True)]) for values in held])
        parts.append(spark.read.schema(schema).parquet(f"{path}/{version}").where(wanted).select(*schema.names))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
