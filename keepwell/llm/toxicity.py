"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text's features are the hashes of its words, word pairs and pairs with one or two
words left out, each counted once. FTRL-proximal keeps a rate per coordinate and an L1
penalty, so most coordinates are exactly 0 and the weights are few enough to broadcast.

Training sees a bounded sample of labelled rows: at most ``sample_docs`` documents and
``sample_bytes`` of text, the first that fit in order of a hash of the id. Features are made where
the texts are; one task runs the sequential updates over them. Scoring reads every whole
text, distributed.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from keepwell.llm.common import ship, text_of, written

_WORD = re.compile(r"[^\W_]+")
#: Odd multipliers that keep the kinds of features apart (splitmix64's and two of its products).
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
_CHUNK = 1 << 17


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and FTRL's rates and penalties."""

    sample_docs: int = 20_000
    sample_bytes: int = 96 << 20
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0
    epochs: int = 8
    least_docs: int = 8


def _hashed(text: str) -> Iterator[np.ndarray]:
    """32-bit feature hashes, a stretch of words at a time, repeats included."""
    words = _WORD.findall(text.lower())
    for start in range(0, len(words), _CHUNK):
        part = words[start:start + _CHUNK + 3]  # pairs may reach over the end of the stretch
        own = min(_CHUNK, len(words) - start)
        h = np.fromiter((zlib.crc32(w.encode()) for w in part), dtype=np.uint64, count=len(part))
        h = (h + np.uint64(1)) * _MIX[0]
        kinds = [h[:own]] + [(h[:-gap] * _MIX[gap] + h[gap:])[:own] for gap in (1, 2, 3) if len(h) > gap]
        x = np.concatenate(kinds)
        x = (x ^ (x >> np.uint64(29))) * _MIX[1]
        yield (x >> np.uint64(32)).astype(np.uint32)


def text_features(text: str) -> np.ndarray:
    """The distinct feature hashes of a text, in order."""
    parts = [np.unique(x) for x in _hashed(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def train(examples: list[np.ndarray], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, bias): coordinates whose weight is not 0. Features of fewer
    than ``least_docs`` examples are left out. With no example the bias is that of 1 in 20."""
    y = labels.astype(np.float64)
    share = (y.sum() + 0.5) / (len(y) + 10.0)
    prior = float(np.log(share / (1 - share)))
    # most features are of one example: a table of 2**24 counts, never below a feature's own
    # count, drops them before they are sorted
    seen = np.zeros(1 << 24, dtype=np.uint32)
    low = np.uint32(len(seen) - 1)
    for x in examples:
        seen[x & low] += 1
    examples = [x[seen[x & low] >= s.least_docs] for x in examples]
    every = np.concatenate([*examples, np.zeros(0, np.uint32)])
    names, counts = np.unique(every, return_counts=True)
    names = names[counts >= s.least_docs]
    del every, counts, seen
    places = []
    for x in examples:
        at = np.searchsorted(names, x)
        at[at == len(names)] = 0
        places.append(at[names[at] == x].astype(np.int32) if len(names) else at[:0].astype(np.int32))
    z, n = np.zeros(len(names)), np.zeros(len(names))
    bias_z, bias_n = 0.0, 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def bias() -> float:
        return prior - bias_z / ((s.beta + bias_n ** 0.5) / s.alpha)

    order = np.random.default_rng(0)
    for _ in range(s.epochs):
        for i in order.permutation(len(examples)):
            at = places[i]
            zi, ni = z[at], n[at]
            w, b = weights(zi, ni), bias()
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - y[i]
            grown = np.sqrt(ni + g * g)
            z[at] = zi + g - (grown - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n ** 0.5) / s.alpha * (b - prior)
            bias_n += g * g
    w = weights(z, n)
    return names[w != 0], w[w != 0], bias()


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_features(t.as_py()).view(np.int32) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                                         names=["nth", "label", "features"])


def _train(batches: Iterable[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    rows = [(nth, label, np.asarray(x.values, dtype=np.int32).view(np.uint32)) for b in batches
            for nth, label, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True)]
    rows.sort(key=lambda r: r[0])
    names, w, bias = train([r[2] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), settings)
    yield pa.RecordBatch.from_pydict({"feature": [-1, *names.tolist()], "weight": [bias, *w.tolist()]})


def _fitting(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, h, label, size) in order to (id, nth, label) of those that fit into ``most`` together."""
    left, nth = most, 0
    for batch in batches:
        rows, places = [], []
        for i, size in enumerate(batch.column(3).to_pylist()):
            if size <= left:
                left, nth = left - size, nth + 1
                rows.append(i), places.append(nth)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(places, pa.int32()), batch.column(2).take(at)],
                                         names=["id", "nth", "label"])


def _warn_if_few(sizes: DataFrame, used: DataFrame, least: int) -> None:
    """Warn of a label that has fewer than ``least`` examples because of the byte bound."""
    drawn, kept = ({r["label"]: r["count"] for r in x.groupBy("label").count().collect()} for x in (sizes, used))
    for label, n in sorted(drawn.items()):
        if kept.get(label, 0) < min(n, least):
            warnings.warn(f"{kept.get(label, 0)} of {n} examples of label {label} fit into the training sample", stacklevel=3)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        settings: Settings = Settings()) -> DataFrame:
    """The model (feature long, weight double); feature -1 is the bias.

    ``labels`` holds ``id_col`` and ``label_col``; null ids and labels are left out, several
    labels of an id count as their largest, and of rows that repeat an id one text is used.
    """
    ship(docs.sparkSession)
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg((F.max(label_col) > 0).cast("int").alias("label")))
    first = written(marks.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(settings.sample_docs), "drawn")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    # at most sample_docs rows: a bounded broadcast and, below, a bounded window
    drawn = texts.join(F.broadcast(first), "id").groupBy("id", "h", "label").agg(F.min("t").alias("t"))
    # a text that the bytes left cannot hold is left out, later ones that fit are used
    sizes = written(drawn.select("id", "h", "label", F.octet_length("t").cast("long").alias("size")), "sizes")
    schema = StructType([sizes.schema["id"], StructField("nth", IntegerType()), sizes.schema["label"]])
    used = written(sizes.repartition(1).sortWithinPartitions("h", "id").mapInArrow(partial(_fitting, most=settings.sample_bytes), schema), "used")
    _warn_if_few(sizes, used, settings.least_docs)
    used = used.select("id", "nth")
    chosen = drawn.join(F.broadcast(used), "id").select("nth", "label", "t")
    made = written(chosen.mapInArrow(_examples, "nth int, label int, features array<int>"), "examples")
    return written(made.coalesce(1).mapInArrow(partial(_train, settings=settings), "feature long, weight double"), "model")


def _scores(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    names, weights, bias = model.value
    low = np.uint32((1 << 20) - 1)
    maybe = np.zeros(int(low) + 1, dtype=bool)
    maybe[names & low] = True
    for batch in batches:
        out = np.empty(batch.num_rows)
        for i, text in enumerate(batch.column(1)):
            hits = [x[maybe[x & low]] for x in _hashed(text.as_py())]
            hits = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.uint32)
            at = np.searchsorted(names, hits)
            found = at[(at < len(names)) & (names[np.minimum(at, max(len(names) - 1, 0))] == hits)] if len(names) else at[:0]
            out[i] = 1 / (1 + np.exp(-np.clip(weights[found].sum() + bias, -35, 35)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out), pa.array((out >= 0.5).astype(np.int32))],
                                         names=["id", "held_out", "score", "predicted"])


def held_out(id_col: str):
    """Whether the id's row is never learned from: CRC-32 of the id as text is divisible by
    5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def score(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted``.
    Null and empty texts score the bias alone. The driver holds the model only: the L1
    penalty and the bounded sample keep it to some thousand pairs."""
    spark = docs.sparkSession
    ship(spark)
    rows = model.orderBy("feature").collect()
    names = np.array([r.feature for r in rows if r.feature >= 0], dtype=np.uint32)
    weights = np.array([r.weight for r in rows if r.feature >= 0])
    shared = spark.sparkContext.broadcast((names, weights, next((r.weight for r in rows if r.feature < 0), 0.0)))
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
                         StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"), held_out(id_col).alias("held"))
            .mapInArrow(partial(_scores, model=shared), schema).withColumnRenamed("id", id_col))
