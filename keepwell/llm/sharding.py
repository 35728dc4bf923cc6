"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows partition p sends to block b is drawn first: the matrix has the law it
would have under a uniform permutation of all rows, with fixed row sums (the partitions)
and column sums (the blocks, cut from the shards). Then every partition permutes its
rows and deals them out by its row of the matrix, and every block permutes what it gets.
The result is a uniform permutation, shards differ by one row at most, and no task holds
more than the numbers of a partition or of a block; rows, with texts of any length, stream by.

The matrix is never whole in one place. It is drawn down a binary tree over partitions:
a node splits its columns' counts between its halves by a multivariate hypergeometric
draw seeded by the node, so any task gets the row of a partition from log2(partitions)
draws, and two tasks always agree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from keepwell.llm.common import fresh, ship, written

#: numpy draws from populations below this.
_NUMPY_LIMIT = 10 ** 9
#: Rows of a block at most. A task holds that many numbers, whatever the size of the rows; the
#: plan has a few numbers per block.
BLOCK_ROWS = 1 << 18


def hypergeometric(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of ``n`` drawn without replacement are good. Large populations: inversion over
    all values within 14 standard deviations of the mode, whose ratios are exact."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    sd = (n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) ** 0.5
    reach = int(14 * sd) + 60
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    step = np.log((good - k[:-1]) * (n - k[:-1]) / ((k[:-1] + 1) * (bad - n + k[:-1] + 1)))
    logs = np.r_[0.0, np.cumsum(step)]
    mass = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(mass, rng.random() * mass[-1], side="right")])


def split_counts(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw: how many of ``n`` come from each column."""
    total = int(counts.sum())
    if total < _NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    out = np.zeros_like(counts)
    for j, c in enumerate(counts.tolist()):
        total -= c
        out[j] = hypergeometric(c, total, n, rng)
        n -= int(out[j])
    return out


def matrix_row(p: int, rows: np.ndarray, columns: np.ndarray, seed: int) -> np.ndarray:
    """Row ``p`` of the communication matrix with row sums ``rows`` and column sums ``columns``."""
    upto = np.r_[0, np.cumsum(rows)]
    low, high, left = 0, len(rows), columns
    while high - low > 1:
        mid = (low + high) // 2
        first = split_counts(left, int(upto[mid] - upto[low]), np.random.default_rng([seed, 1, low, high]))
        if p < mid:
            high, left = mid, first
        else:
            low, left = mid, left - first
    return left


def blocks(total: int, shards: int, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, shard, first slot) of every block: shards differ by one row, the blocks of a
    shard too, and none exceeds ``block_rows``."""
    size, shard, first = [], [], []
    for s in range(shards):
        n = total // shards + (s < total % shards)
        parts = -(-n // block_rows)
        at = 0
        for b in range(parts):
            m = n // parts + (b < n % parts)
            size.append(m), shard.append(s), first.append(at)
            at += m
    return np.array(size, dtype=np.int64), np.array(shard, dtype=np.int64), np.array(first, dtype=np.int64)


def _deal(batches: Iterable[pa.RecordBatch], at: int, plan, seed: int, name: str) -> Iterator[pa.RecordBatch]:
    """Adds the block of each row as column ``name``; columns ``at`` and ``at + 1`` are the
    partition and the row in it."""
    parts, rows, columns = plan.value[:3]
    place = {int(p): i for i, p in enumerate(parts)}
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        part, nth = (batch.column(at + i).to_numpy(zero_copy_only=False) for i in (0, 1))
        block = np.empty(batch.num_rows, dtype=np.int32)
        for p in np.unique(part).tolist():
            if p not in known:
                while len(known) >= 2:
                    known.pop(next(iter(known)))
                i = place[p]
                dealt = np.repeat(np.arange(len(columns), dtype=np.int32), matrix_row(i, rows, columns, seed))
                known[p] = np.random.default_rng([seed, 2, i]).permutation(dealt)
            mine = part == p
            block[mine] = known[p][nth[mine]]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=[*batch.schema.names, name])


def _place(batches: Iterable[pa.RecordBatch], at: int, plan, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole blocks in order of (block, rank) to their shard and slot; columns ``at`` and
    ``at + 1`` are block and rank. A block's permutation of numbers is held, its rows are not."""
    sizes, shard_of, first_of = plan.value[2:]
    now, seen, order = None, 0, None

    def whole() -> None:
        if now is not None and seen != sizes[now]:
            raise ValueError(f"block {now} got {seen} rows, the matrix says {sizes[now]}")

    for batch in batches:
        if not batch.num_rows:
            continue
        block, rank = (batch.column(at + i).to_numpy(zero_copy_only=False) for i in (0, 1))
        slots = np.empty(len(block), dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]).tolist()
        for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
            if now is None or block[a] != now:
                whole()
                now, seen = int(block[a]), 0
                order = first_of[now] + np.random.default_rng([seed, 3, now]).permutation(int(sizes[now]))
            seen += b - a
            if seen > sizes[now]:
                whole()
            slots[a:b] = order[rank[a:b] - 1]
        yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(shard_of[block], pa.int32()), pa.array(slots)],
                                         names=[*batch.schema.names[:at], "shard", "slot"])
    whole()


def shuffle(rows: DataFrame, shards: int = 24, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (all columns) with ``shard`` (0 to shards - 1) and ``slot``, the place in the
    shard, gapless from 0. A uniform permutation by ``seed``; shard sizes differ by one at
    most. Columns of ``rows`` of these names are replaced. Repeated rows are shuffled each;
    an empty table gives no rows."""
    spark = rows.sparkSession
    ship(spark)
    own = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")])
    part, nth, block, rank = fresh(own, "part", "nth", "block", "rank")
    # numbers are fixed by writing them: a task that runs again sees the same partition
    numbered = written(own.withColumn(part, F.spark_partition_id()).withColumn(
        nth, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    counts = sorted((r[0], r[1]) for r in numbered.groupBy(part).count().collect())  # one row a partition
    size, shard, first = blocks(sum(n for _, n in counts), shards, block_rows)
    # numbers per partition and per block only; the matrix itself is drawn in the tasks
    plan = spark.sparkContext.broadcast((np.array([p for p, _ in counts]), np.array([n for _, n in counts], dtype=np.int64),
                                         size, shard, first))
    at = len(own.columns)
    dealt = numbered.mapInArrow(partial(_deal, at=at, plan=plan, seed=seed, name=block),
                                StructType([*numbered.schema.fields, StructField(block, IntegerType())]))
    schema = StructType([*own.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())])
    # rows of a block are ranked by Spark's own sort, which spills, and never held together
    ranked = dealt.withColumn(rank, F.row_number().over(Window.partitionBy(block).orderBy(part, nth)))
    return ranked.select(*[F.col(f"`{c}`") for c in own.columns], block, rank).mapInArrow(
        partial(_place, at=at, plan=plan, seed=seed), schema)


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``size`` (bytes of the text in UTF-8 plus 8, null has
    none), ``text_crc32``, ``shard``, ``slot``. Texts are not moved."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    slim = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    return shuffle(slim, shards, seed, block_rows).withColumnRenamed("id", id_col)


def write_shards(docs: DataFrame, folder: str, shards: int = 24, seed: int = 7, block_rows: int = BLOCK_ROWS) -> None:
    """Write whole rows as Parquet under ``folder``/shard=N, with their ``slot``."""
    shuffle(docs, shards, seed, block_rows).write.partitionBy("shard").parquet(folder)
