"""Packing documents into sequences by vector best-fit.

Every sequence has three capacities: tokens, documents and attention cost (the sum of
squared lengths, as attention is masked to the document). Pieces are placed in order
of decreasing length. A sequence can take a piece only if every residual capacity
covers its demand; of those, ``norm`` picks the one whose weighted residual would be
smallest, ``dot`` the one whose residual is best aligned with the demand (largest
weighted dot product of the two, each as parts of the capacity).

Documents are tokenized where they are read and only (id, place, length, checksum)
goes on. Pieces are dealt by hash into groups of about ``group_pieces``, or of as many as
fill ``GROUP_SEQUENCES`` where that is more, each packed alone in one task. The pieces
of sequences that a group leaves unfilled are dealt again, among those of the other
groups, as long as that saves sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from keepwell.llm.common import fresh, ship, text_of, written
from keepwell.llm.tokens import word_bpe

EOS = 1
#: A group is not made for fewer full sequences than this. With ``Capacity.documents`` it
#: bounds the pieces of a group, however short they are.
GROUP_SEQUENCES = 16


@dataclass(frozen=True)
class Capacity:
    """Capacities of a sequence and the weights of their residuals. The default limits of
    documents and attention cost are those that any 4096 tokens meet."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {self.rule!r}")
        if self.documents < 1 or self.attention < self.tokens ** 2:
            raise ValueError("a full piece must fit an empty sequence")


def _pieces(batches: Iterable[pa.RecordBatch], tokens: int, vocab: str | None) -> Iterator[pa.RecordBatch]:
    names = ["id", "piece", "start", "length", "ids_crc32"]
    last, ids = None, np.zeros(0, "<u4")
    for batch in batches:
        bpe = word_bpe(vocab)
        rows, piece, start, length, crc = [], [], [], [], []
        for i, cell in enumerate(batch.column(1)):
            text = cell.as_py()
            if text != last:  # a mix repeats a document in rows that follow one another
                last, ids = text, np.append(bpe.encode(text), np.uint32(EOS)).astype("<u4", copy=False)
            for k, at in enumerate(range(0, len(ids), tokens)):
                part = ids[at:at + tokens]
                rows.append(i), piece.append(k), start.append(at), length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=names)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = 4096,
           vocab: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and a closing id 1, cut
    only where longer than ``tokens``. Null and empty texts are the closing id alone."""
    ship(docs.sparkSession)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("piece", IntegerType()),
                         *[StructField(c, LongType()) for c in ("start", "length", "ids_crc32")]])
    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
            .mapInArrow(partial(_pieces, tokens=tokens, vocab=vocab), schema))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ``lengths`` in any order, ties in the order given."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.float64)
    weights = np.array(capacity.weights, dtype=np.float64)[:, None]
    residual = np.empty((3, max(len(lengths), 1)))  # rows: capacities; columns: open sequences
    names = np.empty(max(len(lengths), 1), dtype=np.int64)
    used = np.zeros(max(len(lengths), 1), dtype=np.int64)
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    smallest, opened, n = lengths.min(initial=capacity.tokens), 0, 0
    for i in order:
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        left = residual[:, :n] - need[:, None]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            if capacity.rule == "norm":
                score = (weights * (left / full[:, None]) ** 2).sum(axis=0)
            else:
                score = -(weights * (need / full)[:, None] * (residual[:, :n] / full[:, None])).sum(axis=0)
            at = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            at = n
            residual[:, n], names[n], used[n] = full, opened, 0
            opened, n = opened + 1, n + 1
        bins[i], offsets[i] = names[at], used[at]
        residual[:, at] -= need
        used[at] += lengths[i]
        if residual[0, at] < smallest or residual[1, at] < 1 or residual[2, at] < float(smallest) ** 2:  # closed
            n -= 1
            residual[:, at], names[at], used[at] = residual[:, n], names[n], used[n]
    return bins, offsets


def _pack_group(group: pa.Table, capacity: Capacity, row: str, dealt: str, left: str) -> pa.Table:
    """A group with its sequences; ``row``, ``dealt`` and ``left`` name the columns of the row number, the
    group and the flag of unfilled sequences."""
    group = group.sort_by(row)  # the same result whatever order the rows came in
    lengths = group["length"].to_numpy()
    bins, offsets = best_fit(lengths, capacity)
    demand = lengths.astype(np.float64)
    tokens, documents, attention = np.bincount(bins, demand), np.bincount(bins), np.bincount(bins, demand ** 2)
    least = lengths.min(initial=capacity.tokens)
    unfilled = ((tokens + least <= capacity.tokens) & (documents < capacity.documents)
                & (attention + float(least) ** 2 <= capacity.attention))
    first = group[dealt][0].as_py() << 32
    return (group.drop_columns([dealt]).append_column("sequence_id", pa.array(bins + first, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64())).append_column(left, pa.array(unfilled[bins])))


def _least(n: int, tokens: int, attention: float, capacity: Capacity) -> int:
    """The sequences that pieces of these totals need at least."""
    return max(-(-n // capacity.documents), -(-tokens // capacity.tokens), math.ceil(attention / capacity.attention))


def pack(cut: DataFrame, capacity: Capacity = Capacity(), group_pieces: int = 4096) -> DataFrame:
    """``cut`` (``length`` from 1 to the token capacity and any other columns, but none named like
    the results) with ``sequence_id`` and ``offset``. Pieces of a sequence lie one after another from 0. An empty table gives
    no rows; repeated rows are pieces of their own.

    Rounds end when one group holds what is left, when the unfilled sequences are as few as
    their pieces allow, or when a round saves less than 1 % of the sequences it dealt again."""
    if taken := {"sequence_id", "offset"} & {c.lower() for c in cut.columns}:
        raise ValueError(f"columns may not be named like results: {sorted(taken)}")
    ship(cut.sparkSession)
    row, group_of, left_over = fresh(cut, "row", "bin_group", "unfilled")
    rows = written(cut.withColumn(row, F.monotonically_increasing_id()), "pieces")
    schema = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType()),
                         StructField(left_over, BooleanType())])

    def packed(group: pa.Table) -> pa.Table:
        return _pack_group(group, capacity, row, group_of, left_over)

    totals = (F.count("length"), F.sum("length"), F.sum(F.col("length").cast("double") ** 2))
    total = [x or 0 for x in rows.agg(*totals).first()]
    base, before, parts = 0, None, []
    while True:
        groups = max(1, min(-(-total[0] // group_pieces), _least(*total, capacity) // GROUP_SEQUENCES))
        dealt = rows.withColumn(group_of, (F.pmod(F.xxhash64(row, F.lit(base)), F.lit(groups)) + base).cast("int"))
        done = written(dealt.groupBy(group_of).applyInArrow(packed, schema), "packed")
        begins, unfilled = F.col("offset") == 0, F.col(left_over)
        length = F.when(unfilled, F.col("length"))
        made, left, *total = (x or 0 for x in done.agg(
            F.count_if(begins), F.count_if(begins & unfilled), F.count(length), F.sum(length),
            F.sum(length.cast("double") ** 2)).first())
        if before is not None and made >= before[0]:  # nothing saved: they stay as they were
            parts.append(before[1])
            break
        slow = before is not None and 100 * (before[0] - made) < before[0]
        if groups == 1 or slow or left <= _least(*total, capacity):
            parts.append(done)
            break
        parts.append(done.where(~F.col(left_over)))
        before = (left, done.where(F.col(left_over)))
        rows, base = before[1].select(*[F.col(f"`{c}`") for c in rows.columns]), base + groups
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop(row, left_over)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: Capacity = Capacity(),
                   group_pieces: int = 4096, vocab: str | None = None) -> DataFrame:
    """One row per piece of every document: ``id_col``, piece, start, length, ids_crc32,
    sequence_id, offset. Null ids are kept as they are."""
    cut = pieces(docs, id_col, text_col, capacity.tokens, vocab)
    return pack(cut, capacity, group_pieces).withColumnRenamed("id", id_col)


def _token_rows(batches: Iterable[pa.RecordBatch], tokens: int, vocab: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bpe = word_bpe(vocab)
        ids = [np.append(bpe.encode(t.as_py()), np.uint32(EOS)) for t in batch.column(1)]
        cut = [(i, k, x[at:at + tokens]) for i, x in enumerate(ids) for k, at in enumerate(range(0, len(x), tokens))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array([c[0] for c in cut], pa.int64())), pa.array([c[1] for c in cut], pa.int32()),
             pa.array([c[2].astype("i4") for c in cut], pa.list_(pa.int32()))], names=["id", "piece", "ids"])


def sequences(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              tokens: int = 4096, vocab: str | None = None) -> DataFrame:
    """The packed sequences: (sequence_id, ids, lengths), ``ids`` the pieces in order of
    offset and ``lengths`` theirs. Ids of documents must be unique and not null. A group is
    one sequence, so it never exceeds the token capacity."""
    ship(docs.sparkSession)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("piece", IntegerType()),
                         StructField("ids", docs.sparkSession.range(0).select(F.array().cast("array<int>").alias("x"))
                                     .schema["x"].dataType)])
    texts = (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
             .mapInArrow(partial(_token_rows, tokens=tokens, vocab=vocab), schema))
    places = packed.select(F.col(id_col).alias("id"), "piece", "sequence_id", "offset")
    parts = texts.join(places, ["id", "piece"]).groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"),
                        F.transform("parts.ids", lambda x: F.size(x)).alias("lengths"))
