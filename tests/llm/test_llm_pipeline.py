"""The pipeline, stage by stage, against brute force on a given table; SQL queries against DuckDB."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_llm_native import _targets
from test_llm_python import _check_places, _slow_components, _slow_print

import corpus_pipeline
from keepwell.llm import tokens
from keepwell.llm.common import written
from keepwell.llm.oracle import ORACLE_SQL
from keepwell.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _duck(sql, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def _mixed(docs):
    """How often each (doc_id, source, size) is taken: hashes in order, the cut nearest to the budget."""
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    goal, taken = _targets(sizes), {}
    for source, total in sizes.items():
        whole = int(goal[source] // total) if total else 0
        rest = goal[source] - whole * total
        rows = sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest()[:16], i, n) for i, s, n in docs if s == source)
        best, upto, chosen = rest, 0, 0
        for k, (_, _, n) in enumerate(rows):
            upto += n
            if abs(rest - upto) <= best:
                best, chosen = abs(rest - upto), k + 1
            if upto >= rest:
                break
        taken |= {i: whole + (rest > 0 and k < chosen) for k, (_, i, _) in enumerate(rows)}
    return taken


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text or "" for r in docs.collect()}
    sources = {r.doc_id: r.source for r in docs.collect()}
    names, rows = _duck(ORACLE_SQL["op6_quality_rules"])
    want = {r[names.index("doc_id")] for r in rows if r[names.index("kept")]}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), "stage")
        got = docs.collect()
        if k < 4:
            assert docs.columns == columns and all(r.text == texts[r.doc_id] for r in got if r.text is not None)
        if k == 1:
            want = set({texts[i]: i for i in sorted(want)}.values())
        if k == 2:
            order = sorted(want)
            want = {order[r] for r in set(_slow_components([_slow_print(texts[i]) for i in order]))}
        if k == 3:
            copies = _mixed([(i, sources[i], len(texts[i].encode().split())) for i in want])
            assert Counter(r.doc_id for r in got) == Counter({i: n for i, n in copies.items() if n})
        elif k < 3:
            assert sorted(r.doc_id for r in got) == sorted(want)
        else:
            bpe, pieces = tokens.word_bpe(), Counter()
            for i, n in copies.items():
                ids = np.append(bpe.encode(texts[i]), 1).astype("<u4")
                for p, at in enumerate(range(0, len(ids), 4096)):
                    part = ids[at:at + 4096]
                    pieces[(i, p, at, len(part), zlib.crc32(part.tobytes()))] += n
            assert Counter(tuple(r)[:5] for r in got) == +pieces
            _check_places(got)


def test_certified_cutoffs_reject_in_query_and_stage(spark):
    """With labels enough to certify cutoffs, the learned rules reject documents that the base
    rules keep; the query and the pipeline's first stage agree with SQL on every row."""
    sf = "/root/testdata/sf0.1"
    names, rows = _duck(ORACLE_SQL["op6_quality_rules"], sf)
    got = QUERIES["op6_quality_rules"](spark, sf).select(*names)
    assert Counter(tuple(r) for r in got.collect()) == Counter(rows)
    row = {r[0]: dict(zip(names, r, strict=True)) for r in rows}
    learned = [i for i, r in row.items() if not r["kept"] and not r["base_failed"]]
    assert len(learned) > 100
    stage = corpus_pipeline.filter_quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert sorted(r.doc_id for r in stage.select("doc_id").collect()) == sorted(i for i, r in row.items() if r["kept"])


def test_stages_take_empty_tables_and_odd_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS kept", "'x' AS sha", "2 AS n_words", "3 AS fp", "4 AS src")
    for table in (docs, docs.where("false")):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, SF)
            if k < 4:
                assert out.columns == docs.columns
            assert (out.count() == 0) == (table is not docs)


def test_stages_take_nulls_and_repeats(spark):
    rows = [(None, None, None, None, None), (1, None, "en", None, 0), (1, None, "en", None, 0), (2, "", None, "s", 0),
            (3, " ".join(f"w{i}" for i in range(80)), "en", "s", 5), (3, " ".join(f"w{i}" for i in range(80)), "en", "s", 5),
            (None, " ".join(f"v{i}" for i in range(80)), "en", None, 5), (4, "a\nb " * 200_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
    assert {r.doc_id for r in docs.collect()} <= {None, 3} and docs.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    names, rows = _duck(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)

    def plain(row, columns):
        cells = dict(zip(columns, row, strict=True))
        return tuple(round(cells[c], 6) if isinstance(cells[c], float) else cells[c] for c in sorted(columns))

    assert Counter(plain(r, got.columns) for r in got.collect()) == Counter(plain(r, names) for r in rows)


def test_queries_of_python_operators(spark):
    """The registered queries carry the contract's columns for every row of their table."""
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    shapes = {
        "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
        "op9_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                         "slot": "bigint", "grown_shard": "int"},
        "op10_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    }
    for name, kinds in shapes.items():
        out = QUERIES[name](spark, SF)
        assert dict(out.dtypes) == kinds
        assert sorted(r.doc_id for r in out.collect()) == ids
    groups = defaultdict(set)
    for r in QUERIES["op5_simhash"](spark, SF).collect():
        groups[r.component_id].add(r.doc_id)
    assert all(min(g) == c for c, g in groups.items())
