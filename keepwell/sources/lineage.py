"""Input fingerprints and run-lineage records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.workers import ship


#: Bytes of a file that are hashed at once.
CHUNK_BYTES = 64 << 20


def _digests(batches):
    """(path, length) rows to (path, length, sha256), a file read in chunks."""
    import hashlib

    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            local = path.startswith("file:")
            system, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if local else fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with system.open_input_stream(name, compression=None) as stream:
                while data := stream.read(CHUNK_BYTES):
                    digest.update(data)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=["path", "length", "sha256"])


def file_fingerprints(spark: SparkSession, path_glob: str) -> DataFrame:
    """SHA-256 of every file matched; executors read each file in chunks, so its size does
    not matter."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path_glob).select("path", "length")
    return files.mapInArrow(_digests, "path string, length long, sha256 string")


def table_checksum(df: DataFrame) -> DataFrame:
    """Order-independent content checksum of a table: row count plus the XOR of a
    64-bit hash of every row (a decomposable aggregate, no sort)."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns],
                          *[F.col(f"`{c}`").isNull() for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(row_hash).alias("xor_hash64"))


def lineage_record(spark: SparkSession, *, source_commit: str, source_mode: str, inputs: dict[str, str],
                   extra: dict | None = None) -> DataFrame:
    """One-row lineage record stored beside each output; values are passed in."""
    row = {
        "execution_timestamp_utc": dt.datetime.now(dt.timezone.utc).isoformat(),
        "source_commit": source_commit,
        "source_mode": source_mode,
        "spark_version": spark.version,
        "inputs": ";".join(f"{k}={v}" for k, v in sorted(inputs.items())),
    }
    row.update({k: str(v) for k, v in (extra or {}).items()})
    return spark.createDataFrame([row])
