"""Edges that earlier tests left open, and plain versions of the learner and of the shuffle's law."""

from __future__ import annotations

import hashlib
import io
import itertools
import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import chat, common, exact, packing, sharding, simhash, token_count, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- filters

def test_members_miss_none_and_pass_few(spark):
    keys = spark.range(0, 3000).select((F.col("id") * 7).alias("k"))
    rows = spark.range(0, 60_000).select(F.col("id").alias("k"), F.lit("x").alias("word"), F.lit(1).alias("hit"))
    for most, share in ((1 << 20, .15), (64, .95)):  # the second is far too small: it prunes less and still misses none
        found, others = common.Members(keys, "k", most_words=most).split(rows, "k")
        assert found.columns == others.columns == rows.columns
        assert found.join(keys, "k").count() == 3000 and found.count() + others.count() == 60_000
        assert found.count() < share * 60_000
    none = common.Members(keys.limit(0), "k").split(rows, "k")
    assert none[0].count() == 0 and none[1].count() == 60_000


def test_suspects_stay_few_with_many_groups(spark):
    """20,000 repeated (length, prefix) groups: rows of other groups are still recognized as unique."""
    rows = spark.range(0, 60_000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") < 40_000, F.concat(F.lit("copy "), (F.col("id") / 2).cast("long").cast("string"))).otherwise(
        F.concat(F.lit("single "), F.sha2(F.col("id").cast("string").cast("binary"), 256), F.col("id").cast("string"))).alias("text"))
    flagged, _, live = exact._flagged(rows, F.col("text"), 64)
    assert flagged.where(F.col(live) & (F.col("doc_id") < 40_000)).count() == 40_000
    assert flagged.where(F.col(live) & (F.col("doc_id") >= 40_000)).count() < 4_000
    kept = exact.deduplicate(rows)
    assert kept.count() == 40_000 and kept.agg(F.min(F.when(F.col("doc_id") < 40_000, F.col("doc_id") % 2))).first()[0] == 1


def _texts_below_exchanges(df, column: str) -> list[str]:
    """Exchanges (but broadcasts) of the plan that carry ``column``."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.inputPlan())
            continue
        if node.nodeName() == "Exchange" and column in node.output().mkString(","):
            found.append(node.toString().splitlines()[0])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_unique_texts_meet_no_exchange(spark):
    """With broadcasts off, a row whose text recurs is shuffled, one whose text does not is not."""
    docs = spark.createDataFrame([(i, f"text {i // 2 if i < 10 else i}", "en", "s", 1) for i in range(40)], DOCS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact.deduplicate(docs)
        exchanges = _texts_below_exchanges(kept, "max_by") + _texts_below_exchanges(kept, "text#")
        assert all("SortMergeJoin" not in e for e in exchanges) and len(exchanges) <= 1  # the copies', pre-aggregated
        assert kept.count() == 35
        near = simhash.deduplicate(docs)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and near.count() <= 40
        pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
        assert warc.read(warc.write(pages)).where("record_type = 'revisit'").count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- archives

def _records(*data, step=7):
    return list(warc.Archive(io.BytesIO(b"".join(data)), keep_payload=True, step=step))


def test_foreign_header_bytes():
    head = b"HTTP/1.1 200 OK\r\nX-N\xe9me: caf\xe9\r\n\r\nbody"
    (r,) = _records(warc.record("response", [("Content-Type", "application/http")], head))
    assert r.payload == b"body" and r.http == {"x-n\ufffdme": "caf\ufffd"}


@pytest.mark.parametrize("block", [b"", b"no head at all", b"HTTP/1.1 200 OK\r\nA: b\r\n", b"HTTP/1.1 200 OK\r\nA: " + b"b" * (3 << 20)])
def test_message_without_a_head_is_payload(block):
    (r,) = _records(warc.record("response", [("Content-Type", "application/http")], block), step=1 << 16)
    assert r.payload == block and r.payload_bytes == len(block) and r.http == {} and r.block_bytes == len(block)
    assert r.payload_digest == warc.digest(block)


def test_long_message_without_a_head_takes_linear_time():
    took = []
    for mb in (8, 32):
        data = warc.record("response", [("Content-Type", "application/http")], b"x" * (mb << 20), level=1)
        t = time.time()
        (r,) = warc.Archive(io.BytesIO(data))
        took.append(time.time() - t)
        assert r.payload_bytes == mb << 20
    assert took[1] < 10 * took[0] + .5


# --- chat

def test_conversation_ids_of_any_type_and_ties(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", None), (2, None, None, None), (None, 0, "user", "x")]
    texts = {}
    for kind in ("int", "string", "date", "long"):
        conv = F.expr(f"date_add(date'2024-01-01', conv_id)") if kind == "date" else F.col("conv_id").cast(kind)
        df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string").withColumn("conv_id", conv)
        rows = {}
        for n in (1, 5):
            back = chat.read_back(chat.format_conversations(df.repartition(n), chunk_tokens=3))
            assert dict(back.dtypes)["conv_id"] == dict(df.dtypes)["conv_id"]
            rows[n] = sorted((r["turns_sha256"], r["n_turns"], r["loss_chars"], r["formatted_chars"]) for r in back.collect())
        assert rows[1] == rows[5]  # ties do not depend on the order of the rows
        texts[kind] = rows[1]
    assert len({str(v) for v in texts.values()}) == 1 and sum(n for _, n, *_ in texts["int"]) == 6
    assert hashlib.sha256(b"user\nx\n").hexdigest() in {h for h, *_ in texts["int"]}


def test_a_conversation_of_many_turns(spark):
    """Chunks are whole, in order, and their number does not change what is read back."""
    turns = spark.range(20_000).select(F.lit(7).alias("conv_id"), "id", F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text")).withColumnRenamed("id", "turn")
    made = chat.format_conversations(turns, chunk_tokens=1000)
    sizes = [r[0] for r in made.select(F.size("ids")).collect()]
    assert len(sizes) > 50 and sorted(sizes)[1:] == [1000] * (len(sizes) - 1)
    (row,) = chat.read_back(made).collect()
    want = hashlib.sha256("".join(f"{'user' if i % 2 == 0 else 'assistant'}\nturn {i}\n" for i in range(20_000)).encode()).hexdigest()
    assert (row["n_turns"], row["turns_sha256"]) == (20_000, want)


@pytest.mark.parametrize("same", [False, True])
def test_a_hot_conversation_is_many_ranges(spark, monkeypatch, same):
    """A conversation that holds nearly all turns, different or equal ones, lies in most ranges; its
    chunks count on across them and only the last one ends it."""
    made, kept = [], chat.written

    def seen(df, name):
        made.append((name, kept(df, name)))
        return made[-1][1]

    monkeypatch.setattr(chat, "written", seen)
    n, text = 4000, "\\\\ " * 3 + "é <turn>"
    turns = spark.range(n).select(F.when(F.col("id") % 50 == 1, F.col("id")).alias("conv_id"), F.lit(3 if same else F.col("id")).alias("turn"),
                                  F.lit("assistant").alias("role"),
                                  F.lit(text) if same else F.concat(F.lit(text), F.col("id").cast("string")).alias("text"))
    turns = turns.toDF("conv_id", "turn", "role", "text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = chat.format_conversations(turns, chunk_tokens=100)
        chunks = sorted((r["chunk"], r["ids"], r["loss"]) for r in done.where("conv_id is null").collect())
        places = dict(made)["chat_chunks"].where("conv_id is null").select("place").distinct().count()
        rows = {r["conv_id"]: r for r in chat.read_back(done).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert places >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 1 > 1
    assert [c for c, *_ in chunks] == list(range(len(chunks)))
    assert [i for _, ids, _ in chunks for i in ids if i == chat.END] == [chat.END] and chunks[-1][1][-1] == chat.END
    assert all(0 < len(ids) == len(loss) <= 100 for _, ids, loss in chunks)
    hot = [text if same else f"{text}{i}" for i in range(n) if i % 50 != 1]
    assert len(rows) == 1 + n // 50
    assert rows[None]["turns_sha256"] == hashlib.sha256("".join(f"assistant\n{t}\n" for t in hot).encode()).hexdigest()
    assert rows[None]["loss_sha256"] == hashlib.sha256("".join(hot).encode()).hexdigest()
    assert (rows[None]["n_turns"], rows[None]["loss_chars"]) == (len(hot), sum(map(len, hot)))


def test_runs_of_backslashes_and_blanks_across_chunks(spark):
    texts = ["\\" * 1001, "a" + "\\" * 77 + "<turn>", " " * 1_500_000, "\\"]
    turns = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)], "conv_id int, turn int, role string, text string")
    for size in (2, 3, 1000):
        (row,) = chat.read_back(chat.format_conversations(turns if size > 3 else turns.where("turn <> 2"), chunk_tokens=size)).collect()
        said = "".join(t for t in texts if size > 3 or t[0] != " ")
        assert (row["loss_chars"], row["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_short_conversations_are_not_shuffled_to_be_read(spark):
    turns = spark.range(300).select((F.col("id") % 100).alias("conv_id"), "id", F.lit("user").alias("role"), F.lit("x").alias("text"))
    made = chat.format_conversations(turns.withColumnRenamed("id", "turn"))
    plan = chat.read_back(made)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    assert made.count() == 100 and made.where(F.col("ids")[F.size("ids") - 1] != chat.END).count() == 0


# --- packing, token files

def test_pack_keeps_every_column(spark):
    cut = spark.createDataFrame([(5, "a", 1, True, 9), (3, "b", 2, False, 8)], "length long, row string, bin_group int, unfilled boolean, ROW_ int")
    got = packing.pack(cut, packing.Capacity(tokens=8, documents=8, attention=64))
    assert got.columns == [*cut.columns, "sequence_id", "offset"]
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(tuple(r) for r in cut.collect())
    with pytest.raises(ValueError, match="named like results"):
        packing.pack(cut.withColumn("offset", F.lit(1)))


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds_and_placement_is_best_fit(rule):
    """Against a plain loop over all open sequences; each of the three capacities stops pieces."""
    rng = np.random.default_rng(9)
    cap = packing.Capacity(tokens=64, documents=6, attention=64 * 64, weights=(1.0, .5, .25), rule=rule)
    stopped = Counter()
    for lengths in (rng.integers(1, 65, 300), rng.integers(1, 9, 300), rng.choice([46, 44, 20, 18, 3], 300), rng.integers(1, 4, 300)):
        bins, offsets = packing.best_fit(lengths, cap)
        full, open_ = np.array([64.0, 6.0, 4096.0]), []
        want = {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
            scores = []
            for b, left in enumerate(open_):
                for name, short in zip(("tokens", "documents", "attention"), left < need, strict=True):
                    stopped[name] += bool(short)
                if (left >= need).all():
                    w = np.array(cap.weights)
                    scores.append(((w * ((left - need) / full) ** 2).sum() if rule == "norm" else -(w * (need / full) * (left / full)).sum(), b))
            if scores:
                best = min(s for s, _ in scores)
                want[i] = {b for s, b in scores if s <= best + 1e-12}
                at = next((b for b in want[i] if b == bins[i]), None)
                assert at is not None, (lengths[i], want[i], bins[i])
            else:
                assert bins[i] == len(open_)
                open_.append(full.copy())
            open_[bins[i]] -= need
        assert all((left >= 0).all() for left in open_)
    assert all(stopped[k] for k in ("tokens", "documents", "attention"))


def test_token_ids_must_fit(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    with pytest.raises(ValueError, match="do not fit"):
        token_count.write_token_files(docs, dtype="<u1")
    import base64
    wide = tmp_path / "wide.tiktoken"
    wide.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % (i if i else 70_000) for i in range(256)))
    with pytest.raises(ValueError, match="must be free"):
        token_count.write_token_files(docs, vocab=str(wide))


# --- the learner, one coordinate at a time

def test_ftrl_against_dicts():
    rng = np.random.default_rng(3)
    s = toxicity.Settings(least_docs=2, epochs=3)
    examples = [np.unique(rng.integers(0, 40, rng.integers(1, 12)).astype(np.uint32) * 977) for _ in range(120)]
    labels = np.array([int((e % 5 == 0).any()) for e in examples])
    names, weights, bias = toxicity.train(examples, labels, s)
    count = Counter(int(f) for e in examples for f in e)
    share = (labels.sum() + .5) / (len(labels) + 10)
    prior, z, n, bz, bn = math.log(share / (1 - share)), Counter(), Counter(), 0.0, 0.0

    def weight(f):
        if abs(z[f]) <= s.l1:
            return 0.0
        return -(z[f] - math.copysign(s.l1, z[f])) / ((s.beta + math.sqrt(n[f])) / s.alpha + s.l2)

    order = np.random.default_rng(0)
    for _ in range(s.epochs):
        for i in order.permutation(len(examples)):
            feats = [int(f) for f in examples[i] if count[int(f)] >= s.least_docs]
            w, b = {f: weight(f) for f in feats}, prior - bz / ((s.beta + math.sqrt(bn)) / s.alpha)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()) + b)))) - labels[i]
            for f in feats:
                sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / s.alpha
                z[f] += g - sigma * w[f]
                n[f] += g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / s.alpha * (b - prior)
            bn += g * g
    want = {f: weight(f) for f in z if weight(f)}
    assert set(names.tolist()) == set(want) and len(want) > 3
    assert all(w == pytest.approx(want[int(f)], rel=1e-9) for f, w in zip(names, weights, strict=True))
    assert bias == pytest.approx(prior - bz / ((s.beta + math.sqrt(bn)) / s.alpha), rel=1e-9)


# --- the full law of the shuffle

def test_matrix_has_the_law_of_a_uniform_permutation():
    """Rows 3, 2 dealt to blocks 2, 2, 1: every matrix as often as all 120 permutations give it."""
    rows, columns = np.array([3, 2]), np.array([2, 2, 1])
    want = Counter()
    for p in itertools.permutations(range(5)):
        block = [(0, 0, 1, 1, 2)[k] for k in p]
        want[tuple(tuple(block[a:b].count(c) for c in range(3)) for a, b in ((0, 3), (3, 5)))] += 1 / 120
    n = 6000
    got = Counter(tuple(tuple(sharding.matrix_row(p, rows, columns, seed).tolist()) for p in (0, 1)) for seed in range(n))
    assert set(got) == set(want)
    chi = sum((got[m] - n * p) ** 2 / (n * p) for m, p in want.items())
    assert chi < 2.0 * (len(want) - 1) + 12
