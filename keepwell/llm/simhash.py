"""SimHash near-duplicates with BK-trees.

Fingerprints that differ in at most r bits agree in at least one of r + 1 blocks of
bits (pigeonhole), so each distinct fingerprint goes to r + 1 shards, one per block and
value. In a shard a BK-tree (children keyed by the integer Hamming distance to their
parent) finds every member within the radius, following only edges whose key is within
the radius of the distance to the node. A shard with more than ``shard_cap`` members is
split again by the same argument over its free bits, until it is small or 15 bits are
left, which bounds every shard; nothing is dropped and no pairs of a group are listed:
a shard hands on one edge per member to the smallest member it is connected with.

Shard trees are not sent from the driver: that would need all fingerprints there. The
shuffle brings each bounded shard to the task that builds and searches its tree.

Equal fingerprints collapse first, so copies cost one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keepwell.llm.common import Members, fresh, ship, text_of, written
from keepwell.llm.components import components

BITS, SEED = 64, 42
#: Members of a shard above which it is split again.
SHARD_CAP = 1024
#: A shard is not split when it has this many free bits or fewer: it has 2**15 members at most.
LEAST_FREE = 15
_CHUNK = 1 << 16


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of the ``size``-word shingles of UTF-8 ``text`` (A-Z lowered, words between
    ASCII white space, repeats counted); with fewer words the whole sequence is the one
    shingle, with none the result is 0. Memory is bounded by the words of one text."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    total, ones = len(words) - size + 1, np.zeros(BITS, dtype=np.int64)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    for start in range(0, total, _CHUNK):
        n = min(_CHUNK, total - start)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, (next(shingles) for _ in range(n)), repeat(SEED))
                             if total > _CHUNK else map(xxhash.xxh64_intdigest, shingles, repeat(SEED)),
                             dtype="<u8", count=n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), size) for t in batch.column(1)),
                            dtype="u8", count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("i8"))], names=["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp as signed long) of every row; null text counts as empty."""
    ship(docs.sparkSession)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("fp", LongType())])
    return (docs.select(F.col(id_col).alias("id"), F.encode(text_of(text_col), "utf-8").alias("t"))
            .mapInArrow(partial(_fingerprints, size=size), schema))


class BkTree:
    """BK-tree of 64-bit integers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != at:
            edges = self.children[node]
            node = edges.setdefault((value ^ self.values[node]).bit_count(), at)

    def within(self, value: int, radius: int) -> list[int]:
        """Places (in order of addition) of all members within ``radius``."""
        found, todo, values, children = [], [0] if self.values else [], self.values, self.children
        while todo:
            node = todo.pop()
            far = (value ^ values[node]).bit_count()
            if far <= radius:
                found.append(node)
            if edges := children[node]:
                # by the triangle inequality no other child can hold a member within the radius
                todo += [child for key, child in edges.items() if -radius <= key - far <= radius]
        return found


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges (member, smallest member connected with it) among distinct ``members``."""
    tree, parent = BkTree(), list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(members):
        for j in tree.within(value, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(value)
    return [(members[i], members[r]) for i in range(len(members)) if (r := root(i)) != i]


def _tree_links(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, value, fp) sorted by all three; a shard may go on in the next batch."""
    rest = np.zeros((3, 0), dtype="i8")

    def links(rows: np.ndarray) -> list[tuple[int, int]]:
        edges = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
        starts, ends = np.r_[0, edges], np.r_[edges, rows.shape[1]]
        out: list[tuple[int, int]] = []
        for k in np.flatnonzero(ends - starts > 1):
            out += shard_links(np.unique(rows[2, starts[k]:ends[k]].view("u8")).tolist(), radius)
        return out

    def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(out, dtype="u8").reshape(-1, 2).view("i8")
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for b in batches:
        rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns])], axis=1)
        if not rows.shape[1]:
            continue
        last = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(axis=0))
        cut = last[-1] + 1 if len(last) else 0  # the last shard may be incomplete
        if cut:
            yield batch(links(np.ascontiguousarray(rows[:, :cut])))
        rest = rows[:, cut:]
    if rest.shape[1]:
        yield batch(links(np.ascontiguousarray(rest)))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _split(mask: int, radius: int) -> list[int]:
    """``mask`` with one more of the radius + 1 blocks of its free bits, each in turn."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in block) for block in np.array_split(free, radius + 1)]


def links(nodes: DataFrame, radius: int = 3, shard_cap: int = SHARD_CAP) -> DataFrame:
    """Edges (a, b) among the distinct ``fp`` of ``nodes`` whose connected components are
    those of all pairs within ``radius`` bits."""
    ship(nodes.sparkSession)
    masks, parts = _split(0, radius), []
    rows = nodes.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        free = BITS - max(m.bit_count() for m in masks)
        hot = None
        if free > LEAST_FREE:
            hot = written(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
                          .where(F.col("n") > shard_cap).select("mask", "value"), "hot_shards")
            hot = None if hot.isEmpty() else hot
        cold = rows if hot is None else rows.join(hot, ["mask", "value"], "left_anti")
        parts.append(cold.select("mask", "value", "fp").repartition("mask", "value")
                     .sortWithinPartitions("mask", "value", "fp")
                     .mapInArrow(partial(_tree_links, radius=radius), "a long, b long"))
        if hot is None:
            break
        split = {m: _split(m, radius) for m in masks}
        finer = F.create_map(*[x for m, kids in split.items()
                               for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in kids]))])
        rows = written(rows.join(hot, ["mask", "value"], "left_semi")
                       .select("fp", F.explode(F.element_at(finer, F.col("mask"))).alias("mask")), "finer")
        masks = sorted({k for kids in split.values() for k in kids})
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 3,
          shard_cap: int = SHARD_CAP) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most ``radius`` bits,
    its own included (null if no row of the component has an id). Null and blank texts
    have fingerprint zero and are linked like any other. An empty table gives no rows."""
    prints = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    roots = components(written(links(classes.select("fp"), radius, shard_cap), "links"))
    rooted = written(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                     .withColumn("root", F.coalesce("root", "fp")), "rooted")
    first = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "first_ids")
    member = written(rooted.join(first, "root").select("fp", "component_id"), "members")
    return prints.join(member, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each component those with the smallest
    id, null last, and of several texts under that id one. A row goes by its id and text (a
    64-bit hash of it), so rows that repeat an id with other texts are judged apart; rows
    equal in id and text share their fate."""
    late, own, text = F.col(id_col).isNull(), F.col(id_col), F.xxhash64(text_of(text_col))
    keyed = docs.select(F.struct(late.alias("late"), own.alias("own"), text.alias("text")).alias("key"),
                        text_of(text_col).alias("text"))
    verdict = group(keyed, "key", "text", size, radius)
    named = fresh(docs, "gone_id", "gone_text")
    gone = written(verdict.where(F.col("key") > F.col("component_id")).select(
        F.col("key.own").alias(named[0]), F.col("key.text").alias(named[1])).distinct(), "dropped")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # only rows that may be dropped meet the join
    named_as = [F.col(c) for c in named]
    met, others = Members(gone, *named_as).split(docs, own, text)
    stay = met.join(gone, own.eqNullSafe(named_as[0]) & (text == named_as[1]), "left_anti")
    return others.select(*columns).union(stay.select(*columns))
