"""Token counts of flat, unindexed token files by a separator scan.

A token file is ids of fixed width, one after another, an end-of-document id behind each
document and nothing else. Files are read in blocks that start anywhere; each block
finds its separators with one vector comparison. A prefix scan over the blocks of a file
then tells every block how many documents ended before it and where the last separator
was, which stitches documents that lie across blocks. The scan has two levels (blocks in
runs of ``RUN``, then runs), so one very large file is not one long window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keepwell.llm.bpe import loaded
from keepwell.llm.common import scratch, ship, text_of, written
from keepwell.llm.store import new_file, random_reader
from keepwell.llm.tokens import public

#: The vocabulary's free id, which no text yields.
END = 50256
BLOCK_TOKENS = 1 << 20
RUN = 1024


def _write(batches: Iterable[pa.RecordBatch], folder: str, vocab: str, dtype: str) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to one token file a task; a row per document, and one with the size."""
    out, uri, nth, total, kind = None, "", 0, 0, None
    for batch in batches:
        if out is None:
            uri, out = new_file(folder, ".tokens")
        bpe, kind = loaded(vocab), batch.schema.field(0).type
        for text in batch.column(1):
            ids = np.append(bpe.encode(text.as_py()), np.uint32(END)).astype(dtype)
            out.write(ids.tobytes())
            total += len(ids)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([uri] * n, pa.string()), pa.array(range(nth, nth + n), pa.int64()),
                                          batch.column(0), pa.nulls(n, pa.int64())], names=["path", "nth", "id", "tokens"])
        nth += n
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([uri], pa.string()), pa.array([None], pa.int64()), pa.nulls(1, kind),
                                          pa.array([total], pa.int64())], names=["path", "nth", "id", "tokens"])


def write_token_files(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                      vocab: str | None = None, dtype: str = "<u2") -> tuple[DataFrame, DataFrame]:
    """Tokenize ``docs`` into flat files under ``folder`` (a new one under the shared folder if
    none is given): (files: path, tokens) and (documents: path, nth, id), the ids in the order
    in which the documents lie in their file. Null and empty texts are a separator alone."""
    spark = docs.sparkSession
    ship(spark)
    vocab = vocab or public("byte_bpe_50k.tiktoken")
    highest = loaded(vocab).highest
    if highest >= END:
        raise ValueError(f"the vocabulary uses id {highest}; {END} and beyond must be free, as {END} ends a document")
    if END > np.iinfo(np.dtype(dtype)).max:
        raise ValueError(f"ids up to {END} do not fit into {dtype}")
    schema = StructType([StructField("path", StringType()), StructField("nth", LongType()),
                         StructField("id", docs.schema[id_col].dataType), StructField("tokens", LongType())])
    rows = written(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
                   .mapInArrow(partial(_write, folder=folder or scratch(spark, "tokens"), vocab=vocab, dtype=dtype), schema), "token_files")
    return rows.where("nth is null").select("path", "tokens"), rows.where("nth is not null").select("path", "nth", "id")


def _scan(batches: Iterable[pa.RecordBatch], end: int, block_tokens: int, dtype: str) -> Iterator[pa.RecordBatch]:
    width = np.dtype(dtype).itemsize
    for batch in batches:
        for path, block, tokens in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            start = block * block_tokens
            with random_reader(path) as file:
                file.seek(start * width)
                data = file.read(min(block_tokens, tokens - start) * width)
            if len(data) != min(block_tokens, tokens - start) * width:
                raise ValueError(f"{path} has fewer than {tokens} tokens")
            ends = np.flatnonzero(np.frombuffer(data, dtype=dtype) == end) + start
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block], pa.int64()),
                                              pa.array([ends], pa.list_(pa.int64()))], names=["path", "block", "ends"])


def scan(files: DataFrame, end: int = END, block_tokens: int = BLOCK_TOKENS, dtype: str = "<u2") -> DataFrame:
    """The documents of token ``files`` (path, tokens): path, ``nth`` in the file, ``start`` (ids
    before it), ``n_tokens`` (without the separator) and ``ended``, false for ids behind the
    last separator. Two separators in a row hold a document of no tokens; a file without
    tokens has no documents. Paths must be distinct; no files, no rows."""
    spark = files.sparkSession
    ship(spark)
    files = files.select("path", "tokens")
    each = files.where("tokens > 0").select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {block_tokens}"))).alias("block"), "tokens")
    n = each.count()
    tasks = max(1, -(-n // 64), min(n, 4 * spark.sparkContext.defaultParallelism))
    found = written(each.repartition(tasks, "path", "block")
                    .mapInArrow(partial(_scan, end=end, block_tokens=block_tokens, dtype=dtype),
                                "path string, block long, ends array<long>"), "separators")
    # level 1: totals of runs of blocks, scanned over the runs of a file; level 2: within a run
    sums = found.select("path", "block", F.expr(f"block div {RUN}").alias("run"), F.size("ends").cast("long").alias("n"),
                        F.try_element_at("ends", F.lit(-1)).alias("last"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    runs = sums.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    runs = written(runs.select("path", "run", F.coalesce(F.sum("n").over(before("path").orderBy("run")), F.lit(0)).alias("run_n"),
                               F.coalesce(F.max("last").over(before("path").orderBy("run")), F.lit(-1)).alias("run_last")), "runs")
    inner = before("path", "run").orderBy("block")
    carried = written(sums.join(runs, ["path", "run"]).select(
        "path", "block", (F.col("run_n") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("n_before"),
        F.greatest("run_last", F.max("last").over(inner)).alias("last_before")), "carried")
    ends = F.col("ends")
    starts = F.concat(F.array(F.col("last_before") + 1), F.transform(F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))),
                                                                   lambda e: e + 1))
    whole = (found.where(F.size("ends") > 0).join(carried, ["path", "block"])
             .select("path", "n_before", F.posexplode(F.arrays_zip(starts.alias("start"), ends.alias("stop"))).alias("k", "d"))
             .select("path", (F.col("n_before") + F.col("k")).alias("nth"), F.col("d.start").alias("start"),
                     (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("ended")))
    tail = (files.where("tokens > 0").join(sums.groupBy("path").agg(F.sum("n").alias("nth"), F.max("last").alias("last")), "path")
            .withColumn("start", F.coalesce(F.col("last") + 1, F.lit(0))).where("start < tokens")
            .select("path", "nth", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")))
    return whole.unionByName(tail)


def count_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per row of ``docs``: ``id_col`` and ``n_tokens`` as found by scanning token files written
    from them. Null and empty texts have 0; null ids are kept."""
    files, order = write_token_files(docs, id_col=id_col, text_col=text_col, vocab=vocab)
    # a row per document in four bytes of a file and some hundred of memory: by the size of its file it would be broadcast
    return scan(files, block_tokens=block_tokens).join(order.hint("merge"), ["path", "nth"]).select(F.col("id").alias(id_col), "n_tokens")
