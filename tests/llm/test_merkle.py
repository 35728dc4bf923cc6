"""Merkle manifest: layout rules, trees and proofs against a plain recursion, odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict) -> str:
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def climb(nodes: list[str]):
    """(root, siblings of each node level by level, (left, right) steps of each node)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place // 16 * 16
            run = nodes[first:first + 16]
            steps[i].append(("".join(run[:place - first]), "".join(run[place - first + 1:])))
        nodes, at = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)], [p // 16 for p in at]
    return nodes[0], steps


def brute(rows: list[dict], tampered) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        done[s] = climb([leaf(r) for r in groups[s]])
    root, top = climb([done[s][0] for s in names])
    out = []
    for s, over in zip(names, top, strict=True):
        for r, steps in zip(groups[s], done[s][1], strict=True):
            claim, path = leaf(tampered(r)), steps + over
            node = claim
            for left, right in path:
                node = h(left, node, right)
            out.append((r["doc_id"], leaf(r), done[s][0], root, h(*[x for p in path for x in p]), node, node == root))
    return out


def lowered(r: dict) -> dict:
    if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 or r["text"] is None:
        return r
    return r | {"text": "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])}


def found(spark, docs, levels):
    claims = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
              {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")})
    return [tuple(r) for r in merkle.prove(merkle.manifest(docs, FIELDS, claims=claims, levels=levels)).collect()]


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_layout(levels):
    at = merkle.addresses(levels)
    assert [len(a) for a in at] == [16 ** k for k in range(levels)] and at[0][0] == 0
    assert sorted(np.concatenate(at)) == list(range(sum(map(len, at))))
    half = levels // 2
    for k in range(half, levels) if half else ():  # a subtree that hangs from the top half is one stretch
        for below in range(min(16 ** half, 5)):
            own = np.concatenate([at[d][below * 16 ** (d - half):(below + 1) * 16 ** (d - half)] for d in range(half, levels)])
            assert own.max() - own.min() == len(own) - 1 and own.min() == at[half][below]


@pytest.mark.parametrize("n, height", [(1, 0), (2, 1), (16, 1), (17, 2), (250, 2), (256, 2), (257, 3), (1, 3), (4096, 3)])
def test_block(n, height):
    digests = [h(str(i)) for i in range(n)]
    block = merkle.Block(merkle.build(digests, height), n, height, [])
    level = digests
    for k in range(height + 1):
        assert [block.digest(k, i) for i in range(len(level))] == level
        level = [h(*level[i:i + 16]) for i in range(0, len(level), 16)]
    path = [("aa" * 32, ""), ("", ""), ("bb" * 64, "cc" * 480)]
    assert merkle._unpacked(merkle._packed(path)) == path
    root = block.digest(height, 0)
    assert all(merkle.fold(digests[i], block.path(i)) == root for i in range(0, n, 7))


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_trees_and_proofs(spark, levels):
    sizes = {"src0": 700, "src1": 17, "é": 16, "a": 1, None: 33, "": 5} | {f"s{i}": 2 for i in range(30)}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append({"doc_id": i * 37 % 1009, "text": None if i % 11 == 0 else f"Text {'ÄB' * (i % 5)} {i}", "lang": None if i % 7 == 0 else "en",
                         "source": s, "n_chars": None if i % 13 == 0 else i})
            i += 1
    rows += [rows[5] | {"doc_id": None}, rows[5] | {"doc_id": None, "text": "Z"}, rows[40] | {}, rows[40] | {}, rows[40] | {"text": "Other"}]
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) + ("x",) for r in rows],
                                 DDL + ", digest string").repartition(9)
    assert sorted(found(spark, docs, levels), key=str) == sorted(brute(rows, lowered), key=str)


def test_small_tables(spark):
    one = spark.createDataFrame([(5, "HELLO", "en", None, 5)], DDL)
    (row,) = found(spark, one, 4)
    want = leaf({"doc_id": 5, "text": "HELLO", "lang": "en", "source": None, "n_chars": 5})
    assert row[1:4] == (want,) * 3 and row[4] == h("")
    assert found(spark, one.limit(0), 4) == []
    built = merkle.manifest(one, FIELDS)
    assert [r["root"] for r in built.root().collect()] == [want] and built.subroots().first()["tree"] == "n"
    many = spark.createDataFrame([(i, "same", "en", "s", 4) for i in range(40)], DDL)
    rows = merkle.prove(merkle.manifest(many, FIELDS), siblings=True).collect()
    assert all(h(*r["siblings"]) == r["proof_sha256"] and len(r["siblings"]) == (17 if r["doc_id"] < 32 else 9) for r in rows)
    assert all(r["verified"] for r in rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, sf).collect()]
    assert sorted(got) == sorted(brute(rows, lowered)) and any(not r[-1] for r in got)
