"""Merkle manifest of a dataset: a tree per group of rows, and one over the groups' roots.

Every row is a leaf. In a tree, each run of ``FANOUT`` neighbouring nodes becomes one node
above (the last run may be shorter) until one is left. A tree is stored as aligned
subtrees, blocks of ``levels`` levels, each in van Emde Boas order: a block is split at half
height into a top subtree and the subtrees that hang from it, one after another, each split
the same way, so a path from a leaf up touches few stretches whatever the size of a page.
``addresses`` gives the place of a node by arithmetic alone; building a block and finding the
siblings of a node both go through it. The roots of blocks are the leaves of the blocks of the
next round, and the roots of groups those of a last tree.

Rows are hashed where they are read, and only id and digest go on. Their places come from
one range partitioning with a row number behind the key, so a group or an id that holds a
third of all rows is many ranges. A block has ``FANOUT ** (levels - 1)`` leaves, so a group
is as many tasks as its size asks for.

Proofs are made from the top down: a block gets the siblings above its root and hands those
above each of its leaves to the block below. A leaf is folded upwards with its siblings,
place by place, as a reader of the manifest would.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from keepwell.llm.common import ship, written

FANOUT = 16
#: Levels of a block; its leaves are the lowest. A power of two splits evenly all the way down.
LEVELS = 4
_SIZE = 32  # bytes of a digest


def hexed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest (lowercase hex) of a row: each field as its count of UTF-8 bytes, a colon and its
    value as text, or ``-`` if null, one after another."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]).cast("binary"), 256)


@functools.lru_cache(maxsize=32)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth of a full subtree of ``levels`` levels, the addresses of its nodes from
    left to right in van Emde Boas order."""
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    upper, lower = addresses(levels // 2), addresses(levels - levels // 2)
    size = sum(map(len, lower))
    begins = sum(map(len, upper)) + size * np.arange(FANOUT ** (levels // 2))
    return upper + tuple((begins[:, None] + a[None, :]).ravel() for a in lower)


@functools.lru_cache(maxsize=256)
def places(leaves: int, height: int) -> tuple[np.ndarray, ...]:
    """For each level of a block from its leaves up, where its nodes are stored. A block of
    fewer leaves than it could have keeps the order and has no gaps."""
    full, count, found = addresses(height + 1), leaves, []
    for level in range(height + 1):
        found.append(full[height - level][:count])
        count = -(-count // FANOUT)
    order = np.empty(sum(map(len, found)), dtype=np.int64)
    order[np.argsort(np.concatenate(found))] = np.arange(len(order))
    return tuple(np.split(order, np.cumsum([len(f) for f in found])[:-1]))


def build(leaves: list[str], height: int) -> bytes:
    """A block in van Emde Boas order, ``height`` levels above its ``leaves`` (hex digests)."""
    at = places(len(leaves), height)
    stored, level = np.empty((sum(map(len, at)), _SIZE), dtype=np.uint8), leaves
    for k in range(height + 1):
        if k:
            level = [hexed("".join(level[i:i + FANOUT])) for i in range(0, len(level), FANOUT)]
        stored[at[k]] = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, _SIZE)
    return stored.tobytes()


#: A step of a path up the tree: the digests left and right of the node in its run.
Step = tuple[str, str]


class Block:
    """A stored block and the path above its root."""

    def __init__(self, nodes: bytes, leaves: int, height: int, above: list[Step]):
        self._hex, self._at, self.leaves, self._above = nodes.hex(), places(leaves, height), leaves, above
        self._height = height

    def digest(self, level: int, index: int) -> str:
        at = 2 * _SIZE * int(self._at[level][index])
        return self._hex[at:at + 2 * _SIZE]

    def run(self, level: int, index: int) -> list[str]:
        """The nodes that have the same parent as this one, itself included."""
        first = index // FANOUT * FANOUT
        return [self.digest(level, i) for i in range(first, min(first + FANOUT, len(self._at[level])))]

    def step(self, level: int, index: int) -> Step:
        run, place = self.run(level, index), index % FANOUT
        return "".join(run[:place]), "".join(run[place + 1:])

    def beyond(self, index: int) -> list[Step]:
        """The path of a leaf but for its first step; the same for all of its run."""
        steps = []
        for level in range(1, self._height):
            index //= FANOUT
            steps.append(self.step(level, index))
        return steps + self._above

    def path(self, index: int) -> list[Step]:
        return ([self.step(0, index)] if self._height else []) + self.beyond(index)


def fold(digest: str, path: Iterable[Step]) -> str:
    """The root that ``digest`` leads to."""
    for left, right in path:
        digest = hexed(left + digest + right)
    return digest


def _packed(path: list[Step]) -> bytes:
    """Per step a byte for the digests on the left, one for those on the right, and all of them."""
    return b"".join(bytes([len(a) // (2 * _SIZE), len(b) // (2 * _SIZE)]) + bytes.fromhex(a + b) for a, b in path)


def _unpacked(data: bytes) -> list[Step]:
    path, at = [], 0
    while at < len(data):
        left, right = data[at] * _SIZE, data[at + 1] * _SIZE
        middle, at = at + 2 + left, at + 2 + left + right
        path.append((data[middle - left:middle].hex(), data[middle:at].hex()))
    return path


def _build_group(group: pa.Table, levels: int) -> pa.Table:
    """The rows of one block (tree, height of the tree, round, block, at, digest and what rides
    along) as one row: tree, height, round, block, leaves, up, nodes, root, lists of the rest."""
    group = group.sort_by("at").combine_chunks()
    n, tall, nth = group.num_rows, group["height"][0].as_py(), group["round"][0].as_py()
    up = min(levels - 1, tall - (levels - 1) * nth)
    digests = group["digest"].to_pylist()
    nodes = build([d.hex() for d in digests], up)
    rest = [c for c in group.column_names if c not in ("tree", "height", "round", "block", "at", "digest")]
    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), group[c].combine_chunks()) for c in rest]
    return pa.Table.from_arrays(
        [*[group[c].slice(0, 1) for c in ("tree", "height", "round", "block")], pa.array([n], pa.int32()), pa.array([up], pa.int32()),
         pa.array([nodes], pa.binary()), pa.array([nodes[:_SIZE]], pa.binary()), *lists],
        names=["tree", "height", "round", "block", "leaves", "up", "nodes", "root", *rest])


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, digest, ...) with their place ``at`` in their tree by ``order`` and the
    ``height`` of the tree: the levels above its leaves."""
    keys = ["tree", *order, "digest", "row"]
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    # the high bits of a row's number are its range, the others its place there
    ordered = written(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row")
                      .withColumn("seq", F.monotonically_increasing_id()).withColumn("range", F.shiftright("seq", 33)), "ordered")
    ranges = ordered.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    one = Window.partitionBy("tree")
    before = F.sum("n").over(one.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    powers = F.array(*[F.lit(FANOUT ** k).cast("long") for k in range(16)])
    shifts = written(ranges.withColumn("size", F.sum("n").over(one)).select(
        "tree", "range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.size(F.filter(powers, lambda p: p < F.col("size"))).alias("height")), "ranges")
    return (ordered.join(shifts, ["tree", "range"]).withColumn("at", F.col("seq") + F.col("shift"))
            .drop("seq", "range", "shift"))


def _forest(rows: DataFrame, order: list[str], levels: int) -> list[DataFrame]:
    """The blocks of every tree of ``rows`` (tree, digest, ``order``, what rides along), a table a round."""
    rounds, now = [], _placed(rows, order).withColumn("round", F.lit(0))
    wide = FANOUT ** (levels - 1)
    fixed = [StructField("tree", StringType()), StructField("height", IntegerType()), StructField("round", IntegerType()),
             StructField("block", LongType()), StructField("leaves", IntegerType()), StructField("up", IntegerType()),
             StructField("nodes", BinaryType()), StructField("root", BinaryType())]
    while True:
        now = now.withColumn("block", F.expr(f"at div {wide}"))
        rest = [f for f in now.schema.fields if f.name not in ("tree", "height", "round", "block", "at", "digest")]
        schema = StructType([*fixed, *[StructField(f.name, ArrayType(f.dataType)) for f in rest]])
        done = written(now.groupBy("tree", "block").applyInArrow(lambda group: _build_group(group, levels), schema), "blocks")
        rounds.append(done)
        more = done.where(F.col("height") > (levels - 1) * len(rounds))
        if not more.agg(F.count(F.lit(1))).first()[0]:
            return rounds
        now = more.select("tree", "height", F.lit(len(rounds)).alias("round"), F.col("block").alias("at"), F.col("root").alias("digest"))


def _roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """(tree, root): the last block of every tree."""
    parts = [r.where(F.col("height") <= (levels - 1) * (k + 1)).select("tree", "root") for k, r in enumerate(rounds)]
    return functools.reduce(DataFrame.unionByName, parts)


def _paths_below(batches: Iterable[pa.RecordBatch], wide: int) -> Iterator[pa.RecordBatch]:
    """Rows (nodes, leaves, up, above, block, what is handed on) to a row per leaf: block, path, the same."""
    for batch in batches:
        nodes, leaves, up, above, block = (c.to_pylist() for c in batch.columns[:5])
        for i in range(batch.num_rows):
            b = Block(nodes[i], leaves[i], up[i], _unpacked(above[i]))
            own = pa.array([i] * leaves[i], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(block[i] * wide, block[i] * wide + leaves[i]), pa.int64()),
                 pa.array([_packed(b.path(k)) for k in range(leaves[i])], pa.binary()), *[c.take(own) for c in batch.columns[5:]]],
                names=["block", "above", *batch.schema.names[5:]])


def _above(rounds: list[DataFrame], tops: DataFrame, levels: int) -> list[DataFrame]:
    """For the blocks of each round (tree, block): ``above``, the packed path over the block's
    root, and the columns of ``tops`` (tree, ``above`` over the tree's root, others)."""
    handed = [f for f in tops.schema.fields if f.name != "above"]
    schema = StructType([StructField("block", LongType()), StructField("above", BinaryType()), *handed])
    found: list[DataFrame] = []
    for k in reversed(range(len(rounds))):
        own = rounds[k].where(F.col("height") <= (levels - 1) * (k + 1)).select("tree", "block").join(tops, "tree")
        if found:
            upper = rounds[k + 1].join(found[0], ["tree", "block"]).select(
                "nodes", "leaves", "up", "above", "block", *[f.name for f in handed])
            below = upper.mapInArrow(partial(_paths_below, wide=FANOUT ** (levels - 1)), schema)
            own = own.unionByName(below)
        found.insert(0, written(own, "paths"))
    return found


@dataclass(frozen=True)
class Manifest:
    """The stored trees: ``blocks`` of the groups' trees and ``top`` blocks of the tree over
    their roots, a table a round. ``blocks[0]`` also lists the ids and claimed leaves of its rows."""

    blocks: list[DataFrame]
    top: list[DataFrame]
    levels: int

    def subroots(self) -> DataFrame:
        """(tree, root): a row per group; ``tree`` is ``n`` for the null group, else ``s`` and its name."""
        return _roots(self.blocks, self.levels).select("tree", F.lower(F.hex("root")).alias("root"))

    def root(self) -> DataFrame:
        """(root): one row, or none for an empty table."""
        return _roots(self.top, self.levels).select(F.lower(F.hex("root")).alias("root"))


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source",
             claims: tuple[Column, dict[str, Column]] | None = None, levels: int = LEVELS) -> Manifest:
    """Build the trees over ``docs``: a leaf per row from ``fields``, in groups by ``group_col``.

    In a group leaves ascend by ``id_col`` (null first), equal ids by their leaf; repeated rows
    are leaves of their own. Groups ascend bytewise, null first. ``claims`` is (where, other
    values of some fields): rows for which ``where`` holds claim to have those values, and
    ``prove`` tests the claim. Nulls are allowed everywhere; other columns are ignored,
    whatever their names. An empty table has no blocks and no root.
    """
    ship(docs.sparkSession)
    cols = {c: F.col(f"`{c}`") for c in fields}
    other = F.lit(None).cast("binary")
    if claims is not None:
        other = F.when(claims[0], F.unhex(leaf([claims[1].get(c, cols[c]) for c in fields])))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(f"`{group_col}`").cast("string")), F.lit("n")).alias("tree"),
        F.unhex(leaf(list(cols.values()))).alias("digest"), F.col(f"`{id_col}`").alias("id"), other.alias("claim"))
    blocks = _forest(rows, ["id"], levels)
    roots = _roots(blocks, levels).select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("name"))
    return Manifest(blocks, _forest(roots, ["name"], levels), levels)


def _top_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lowest blocks of the top tree to a row per group: tree, path over its root, root."""
    for batch in batches:
        nodes, leaves, up, above, names, roots = (c.to_pylist() for c in batch.columns)
        for i in range(batch.num_rows):
            b = Block(nodes[i], leaves[i], up[i], _unpacked(above[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[i], pa.string()), pa.array([_packed(b.path(k)) for k in range(leaves[i])], pa.binary()),
                 pa.array([bytes.fromhex(b.digest(0, k)) for k in range(leaves[i])], pa.binary()),
                 pa.array([roots[i]] * leaves[i], pa.binary())], names=["tree", "above", "subroot", "top"])


def _prove(batches: Iterable[pa.RecordBatch], paths: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, leaves, up, above, subroot, top = (c.to_pylist() for c in batch.columns[:6])
        for i in range(batch.num_rows):
            b, n = Block(nodes[i], leaves[i], up[i], _unpacked(above[i])), leaves[i]
            ids, claims = batch.column(6).slice(i, 1).flatten(), batch.column(7).slice(i, 1).flatten().to_pylist()
            own, proofs, folded, listed = [], [], [], []
            for first in range(0, n, FANOUT):
                run, beyond = b.run(0, first), b.beyond(first)
                rest = "".join(left + right for left, right in beyond)
                for place, digest in enumerate(run):
                    step = [("".join(run[:place]), "".join(run[place + 1:]))] if up[i] else []
                    claim = claims[first + place]
                    own.append(digest)
                    others = "".join(left + right for left, right in step) + rest
                    proofs.append(hexed(others))
                    folded.append(fold(digest if claim is None else claim.hex(), step + beyond))
                    if paths:
                        listed.append([others[k:k + 2 * _SIZE] for k in range(0, len(others), 2 * _SIZE)])
            root = top[i].hex()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own), pa.array([subroot[i].hex()] * n), pa.array([root] * n), pa.array(proofs), pa.array(folded),
                 pa.array([f == root for f in folded], pa.bool_()), *([pa.array(listed, pa.list_(pa.string()))] if paths else [])],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *["siblings"] * paths])


def prove(built: Manifest, id_col: str = "doc_id", siblings: bool = False) -> DataFrame:
    """A row per leaf: ``id_col``, ``leaf``, ``subroot`` and ``root`` (of the rows as they are),
    ``proof_sha256`` (digest of all siblings up to the root, left to right, as hex text),
    ``folded_root`` (what the claimed leaf, or else the leaf, folds to) and ``verified`` (that it
    is the root); with ``siblings`` also their list."""
    levels = built.levels
    ship(built.top[0].sparkSession)
    top = _roots(built.top, levels).select("tree", F.lit(b"").alias("above"), F.col("root").alias("top"))
    over = _above(built.top, top, levels)[0]
    tops = written(built.top[0].join(over, ["tree", "block"]).select("nodes", "leaves", "up", "above", "name", "top")
                   .mapInArrow(_top_paths, "tree string, above binary, subroot binary, top binary"), "subroots")
    above = _above(built.blocks, tops, levels)[0]
    rows = built.blocks[0].join(above, ["tree", "block"]).select("nodes", "leaves", "up", "above", "subroot", "top", "id", "claim")
    text = [StructField(c, StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = StructType([StructField("id", built.blocks[0].schema["id"].dataType.elementType), *text,
                         StructField("verified", BooleanType()),
                         *([StructField("siblings", ArrayType(StringType()))] if siblings else [])])
    return rows.mapInArrow(partial(_prove, paths=siblings), schema).withColumnRenamed("id", id_col)
