"""Operators that run Python in tasks, against brute force, round trips and edge rows."""

import gzip
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from keepwell.llm import chat, packing, sharding, simhash, store, token_count, tokens, toxicity, warc
from keepwell.llm.bpe import loaded
from keepwell.llm.common import scratch

EDGE = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "one two"), (6, "ONE two  three"), (7, "one two three"), (8, "É é ß ſ"),
        (9, "long words " * 40_000), (9, "long words " * 40_000), (None, "no id here at all"), (10, "<|endoftext|> said"),
        (11, "x" * 200_000), (12, "İstanbul ΣΑΣ 漢字 🙂 á \x1c b")]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "k") for r in rows],
                                 "doc_id long, text string, id string, fp int, shard string")


# --- WARC

def test_warc_round_trip(spark):
    rows = [(5, "http://a/ü b", "same"), (3, "http://b/", "same"), (9, None, "same"), (1, "http://c/", None), (2, "", ""),
            (4, "http://d/\r\nX: y", "é" * 70_000), (None, "http://e/", "same"), (None, "http://f/", "alone"),
            (7, "http://g/", "twice"), (7, "http://g/", "twice")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    for least in (0, 5):
        got = warc.read(warc.write(pages, revisit_bytes=least), payloads=True).where("record_type <> 'warcinfo'").withColumn(
            "page", warc.page_id(F.col("record_id")).cast("long")).withColumn(
            "to", warc.page_id(F.col("refers_to")).cast("long")).collect()
        assert len(got) == len(rows) and all(r.digest_ok for r in got)
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(first.get(h or "", i), i)
        want = Counter()
        for i, _, h in rows:
            h = h or ""
            n = len(h.encode())
            many = sum((x[2] or "") == h for x in rows) > 1
            to = first.get(h) if many and n >= least and first.get(h) != i else None
            want[(i, n, warc.digest(h.encode()), "response" if to is None else "revisit", to)] += 1
        assert Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.to) for r in got) == want
        assert {r.payload.decode() for r in got if r.record_type == "response"} == {h or "" for _, _, h in rows}
    assert warc.write(pages.where("false")).count() == 0
    assert warc.read(warc.write(pages.where("false"))).count() == 0


def test_warc_one_member_per_record(spark):
    pages = spark.createDataFrame([(i, "u", "p" * i) for i in range(9)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write(pages, archive_bytes=1500).collect()
    assert len(manifest) > 1 and sum(r.records for r in manifest) == 9
    for r in manifest:
        data = store.reader(r.path).read()
        members = 0
        while data:
            inflate = zlib.decompressobj(31)
            text = inflate.decompress(data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and inflate.eof
            data, members = inflate.unused_data, members + 1
        assert members == r.records + 1


def _archive(*records, step=7):
    return list(warc.Archive(io.BytesIO(b"".join(records)), keep_payload=True, step=step))


def test_warc_reader_frames_and_verifies():
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nmore"
    good = warc.record("response", [("Content-Type", "application/http")], block)
    for step in (1, 7, 1 << 20):
        (r,) = _archive(good, step=step)
        assert r.payload == b"body\r\n\r\nmore" and r.payload_bytes == 12 and r.http == {"a": "b"}
        assert r.headers["warc-block-digest"] == "sha1:" + r.block_digest
    for broken in (good[:-9], good + b"\x1f\x8b", gzip.compress(b"no record"), gzip.compress(b"WARC/1.1\r\nA: b\r\n\r\n"),
                   gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"),
                   gzip.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\ntoo long\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            _archive(broken)
    bad = gzip.compress(b"WARC/1.1\r\nWARC-Block-Digest: sha1:AAAA\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    assert _archive(bad)[0].block_digest != "AAAA"
    assert _archive() == []


# --- toxicity

def _toxic_rows(n, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(20, 200))]
        bad = rnd.random() < 0.2
        if bad:
            words[rnd.randrange(len(words))] = rnd.choice(["vile,", "Nasty", "vile"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_held_out(spark):
    rows = _toxic_rows(1500, 1)
    docs = docs_of(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    assert model.count() < 2000  # L1 leaves few coordinates
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {r[0]: r[2] for r in rows}
    out = [i for i in truth if got[i].held_out]
    assert {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0} == set(out)
    assert np.mean([got[i].predicted == truth[i] for i in out]) > 0.97
    again = toxicity.score(docs.repartition(5), toxicity.fit(docs.repartition(3), labels.where(~toxicity.held_out("doc_id"))))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in got.items()}


def test_toxicity_bounds_and_edges(spark):
    docs = docs_of(spark, EDGE)
    labels = spark.createDataFrame([(4, 1), (4, 0), (9, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    small = toxicity.Settings(sample_docs=1, sample_bytes=100, least_docs=1)
    for s in (toxicity.Settings(least_docs=1), small):
        rows = toxicity.score(docs, toxicity.fit(docs, labels, settings=s)).collect()
        assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    nothing = toxicity.fit(docs, labels.where("false"))
    assert nothing.count() == 1 and all(r.predicted == 0 for r in toxicity.score(docs, nothing).collect())
    assert toxicity.score(docs.where("false"), nothing).count() == 0


def test_a_long_text_does_not_end_the_sample(spark):
    rows = _toxic_rows(1500, 1)
    longest = spark.createDataFrame([(r[0],) for r in rows], "id long").orderBy(F.xxhash64("id")).first().id
    texts = [(i, "long " * 200_000 if i == longest else t) for i, t, _ in rows]
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(spark, texts), labels, settings=toxicity.Settings(sample_bytes=900_000))
    assert model.count() > 1
    with pytest.warns(UserWarning, match="examples of label"):
        toxicity.fit(docs_of(spark, texts), labels, settings=toxicity.Settings(sample_bytes=1000))


def test_features_do_not_depend_on_stretches(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(100))
    whole = toxicity.text_features(text)
    monkeypatch.setattr(toxicity, "_CHUNK", 7)
    assert np.array_equal(whole, toxicity.text_features(text))


# --- chat

TURNS = [(1, 0, "user", "hi <turn> \\ </turn>"), (1, 1, "assistant", "### Assistant: \\n <|endoftext|>"), (1, 2, "assistant", ""),
         (2, None, "user", "last"), (2, 0, "assistant", None), (2, 0, "assistant", None), (3, 0, None, "\\"), (None, 0, "user", "a"),
         (None, 1, "assistant", "é🙂" * 30_000), (4, 0, "assistant", "<<turn>/turn>\\<text>")]


def _chat_expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is None, t, r, x))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[0], r[1] or 0))
        said = "".join(x or "" for _, _, r, x in turns if r == "assistant")
        whole = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in turns)
        shown = sum(len("<turn><text></turn>" + chat.escape(r or "") + chat.escape(x or "")) for _, _, r, x in turns) + len("<|endoftext|>")
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), shown)
    return out


@pytest.mark.parametrize("chunk", [2, 5, 1 << 16])
def test_chat_reads_back(spark, chunk):
    turns = spark.createDataFrame([(*r, "x") for r in TURNS], "conv_id long, turn long, role string, text string, ids string")
    made = chat.format_conversations(turns, chunk_tokens=chunk)
    assert all(len(r.ids) == len(r.loss) <= chunk for r in made.collect())
    assert {r[0]: tuple(r)[1:] for r in chat.read_back(made).collect()} == _chat_expected(TURNS)
    assert chat.read_back(chat.format_conversations(turns.where("false"))).count() == 0


def test_chat_escape_is_reversible_and_total():
    rnd = random.Random(3)
    parts = [*chat.CONTROL, "\\", "<", "turn>", "</", "#", " ", "a", "\n", "|>"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        shown = chat.escape(text)
        assert chat.unescape(shown) == text and not any(c in shown for c in chat.CONTROL)


def test_chat_mask_covers_the_text_only():
    bpe = loaded(tokens.public("byte_bpe_50k.tiktoken"))
    ids, begin, end = chat.encode_turn(bpe, "assistant", "some words", True)
    assert bpe.decode(ids[begin:end]) == b"some words" and ids[0] == chat.OPEN and ids[-1] == chat.CLOSE
    other, b, e = chat.encode_turn(bpe, "user", "some words", False)
    assert b == e
    mask = chat.loss_mask(np.array([len(ids), len(other), len(ids)]), np.array([begin, b, begin]), np.array([end, e, end]))
    assert bpe.decode(np.concatenate([ids, other, ids])[mask]) == b"some wordssome words"
    assert (bpe.encode("<turn></turn><|endoftext|>") < chat.END).all()


# --- SimHash

def _slow_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _slow_components(prints, radius=3):
    seen = list(range(len(prints)))

    def root(i):
        while seen[i] != i:
            i = seen[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                seen[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprint(monkeypatch):
    for _, t in EDGE[:9] + EDGE[10:]:
        assert simhash.fingerprint((t or "").encode()) == _slow_print(t)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    text = " ".join(f"w{i % 37}" for i in range(60))
    assert simhash.fingerprint(text.encode()) == _slow_print(text)


def test_simhash_edges(spark):
    docs = docs_of(spark, EDGE)
    got = simhash.group(docs).collect()
    assert len(got) == len(EDGE)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == {("0" * 16, 1)} and by[6] == by[7] and next(iter(by[7]))[1] == 6
    assert next(iter(by[None]))[1] is None
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert 2 not in kept and 3 not in kept and 7 not in kept and kept[1] == 1 and kept[9] == 2 and kept[None] == 1
    assert simhash.group(docs.where("false")).count() == 0


def test_simhash_judges_rows_of_an_id_apart(spark):
    same, lone, near = "one two three", " ".join(f"w{i}" for i in range(60)), "ONE two three"
    rows = [(1, same), (2, near), (2, lone), (None, near), (3, "a b c"), (3, "A b c"), (None, "p q r"), (None, "P q r")]
    out = [(r.doc_id, r.text) for r in simhash.deduplicate(docs_of(spark, rows)).collect()]
    assert (1, same) in out and (2, lone) in out and (2, near) not in out and (None, near) not in out
    assert sum(i == 3 for i, _ in out) == 1 and sum(i is None for i, _ in out) == 1 and len(out) == 4


@pytest.mark.parametrize("cap", [1024, 6])
def test_links_find_every_component(spark, cap):
    rnd = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 25)):  # clusters, tight and loose
            x = centre
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    edges = simhash.links(nodes, 3, shard_cap=cap)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(edges).collect()}
    want = defaultdict(set)
    for x, r in zip(prints, _slow_components(prints), strict=True):
        want[r].add(x)
    have = defaultdict(set)
    for x in prints:
        have[roots.get(x, x)].add(x)
    assert sorted(map(sorted, have.values())) == sorted(map(sorted, want.values()))


def test_bk_tree_finds_all():
    rnd = random.Random(2)
    tree, values = simhash.BkTree(), list({rnd.getrandbits(10) for _ in range(400)})
    for v in values:
        tree.add(v)
    for _ in range(50):
        x, r = rnd.getrandbits(10), rnd.randint(0, 4)
        assert sorted(tree.within(x, r)) == [i for i, v in enumerate(values) if (v ^ x).bit_count() <= r]
    assert simhash.BkTree().within(3, 64) == []


# --- tokens and packing

def test_word_ids_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokens.public("word_bpe_49k.json")), tokens.word_bpe()
    rnd = random.Random(4)
    alphabet = [*"abcdehinorstuv", "the", "ing", "tion", "é", "ß", "Ä", "ª", "²", "1", "42", "'s", "'ll", "don't", ".", ",", "!!", "--",
                "_", "$", " ", "\n", " ", " ", "\x00", "\x1d", "ı", "İ", "Σ", "漢", "🙂", "́", "</w>", "<|endoftext|>", "ﬁ", "ŉ"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_met_before_are_not_merged_again(monkeypatch):
    bpe = tokens.WordBpe(tokens.public("word_bpe_49k.json"))
    texts = ["The cat don't sit, éß42", "  ", "", "cat the 42", "x" * 5000 + " don't the", "sit, SIT, sit,"]
    want = [bpe._slow.encode(t, add_special_tokens=False).ids for t in texts]
    merged, merge = [], bpe._merge
    monkeypatch.setattr(bpe, "_merge", lambda words: merged.extend(words) or merge(words))
    assert [bpe.encode(t).tolist() for t in texts] == want
    assert sorted(merged) == sorted({w for t in texts for w in t.lower().split()})
    monkeypatch.setattr(tokens, "KEPT_CHARS", 8)  # the table stays bounded, the ids stay the same
    assert [bpe.encode(t).tolist() for t in [*texts, *texts]] == [*want, *want]
    assert bpe._chars <= 8 and not any(len(w) > 8 for w in bpe._kept)


def test_packing_every_id_once(spark):
    docs = docs_of(spark, EDGE)
    got = packing.pack_documents(docs, group_pieces=5).collect()
    bpe, want = tokens.word_bpe(), Counter()
    for i, t in EDGE:
        ids = np.append(bpe.encode(t or ""), 1).astype("<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    _check_places(got)
    assert packing.pack_documents(docs.where("false")).count() == 0


def _check_places(rows, tokens=4096, documents=10 ** 9, attention=10 ** 18):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens and len(parts) <= documents and sum(n * n for _, n in parts) <= attention


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_capacity(rule):
    rnd = np.random.default_rng(1)
    lengths = np.r_[rnd.integers(1, 400, 3000), rnd.integers(400, 4097, 300), 4096, 1]
    for cap in (packing.Capacity(rule=rule), packing.Capacity(documents=5, rule=rule)):
        bins, offsets = packing.best_fit(lengths, cap)
        by = defaultdict(list)
        for b, o, n in zip(bins, offsets, lengths, strict=True):
            by[b].append((o, n))
        for parts in by.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            assert sum(n for _, n in parts) <= 4096 and len(parts) <= cap.documents
        if cap.documents > 5 and rule == "norm":
            assert len(by) <= -(-lengths.sum() // 4096) * 1.02 + 1
    small = packing.Capacity(tokens=10, documents=3, attention=100, rule=rule)
    bins, _ = packing.best_fit(np.array([9, 1, 1, 1, 1, 5, 5, 10]), small)
    assert max(Counter(bins.tolist()).values()) <= 3


def test_short_pieces_fill_sequences_of_all_groups(spark):
    for lengths, want in ((F.lit(1) + F.col("id") % 3, 10), (F.lit(10).cast("long"), 49)):
        rows = packing.pack(spark.range(20_000).select("id", lengths.alias("length")), group_pieces=500).collect()
        assert sorted(r.id for r in rows) == list(range(20_000))
        _check_places(rows)
        assert len({r.sequence_id for r in rows}) == want


def test_packing_empty_group():
    bins, offsets = packing.best_fit(np.zeros(0, np.int64), packing.Capacity())
    assert len(bins) == len(offsets) == 0


def test_sequences(spark):
    docs = docs_of(spark, [r for r in EDGE if r[0] not in (None, 9)])
    packed = packing.pack_documents(docs)
    seqs = {r.sequence_id: r for r in packing.sequences(docs, packed).collect()}
    for r in packed.collect():
        part = np.array(seqs[r.sequence_id].ids[r.offset:r.offset + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    assert all(sum(s.lengths) == len(s.ids) for s in seqs.values())


# --- sharding

def test_shards_are_exact_and_gapless(spark):
    docs = docs_of(spark, [*EDGE, *[(100 + i, f"t{i}") for i in range(300)]])
    for block in (7, 1 << 16):
        got = sharding.shuffle(docs, 24, block_rows=block).collect()
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        n = len(EDGE) + 300
        assert sorted(len(s) for s in slots.values()) == sorted([n // 24] * (24 - n % 24) + [n // 24 + 1] * (n % 24))
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    slim = sharding.shard_documents(docs).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in slim} == {
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert sharding.shuffle(docs.where("false")).count() == 0


def test_rows_of_a_block_are_not_held_together(spark):
    plan = sharding.shuffle(docs_of(spark, EDGE))._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and plan.count("MapInArrow") == 2 and "row_number" in plan
    sizes = SimpleNamespace(value=(None, None, np.array([2, 3]), np.array([0, 1]), np.array([0, 0])))
    batches = [pa.RecordBatch.from_pydict({"x": [7] * n, "block": b, "rank": r}) for n, b, r in ((1, [0], [1]), (3, [0, 1, 1], [2, 1, 2]))]
    rest = pa.RecordBatch.from_pydict({"x": [7], "block": [1], "rank": [3]})
    slots = [(r["shard"], r["slot"]) for b in sharding._place([*batches, rest], 1, sizes, 7) for r in b.to_pylist()]
    assert sorted(slots) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2)]
    for wrong in (batches, [*batches, rest, rest]):
        with pytest.raises(ValueError, match="block 1 got"):
            list(sharding._place(wrong, 1, sizes, 7))


def test_matrix_has_its_sums_and_law():
    rows, columns = np.array([3, 0, 5, 4, 1]), np.array([6, 2, 5])
    hits = np.zeros((5, 3))
    for seed in range(3000):
        m = np.array([sharding.matrix_row(p, rows, columns, seed) for p in range(5)])
        assert (m.sum(axis=1) == rows).all() and (m.sum(axis=0) == columns).all()
        hits += m
    assert np.allclose(hits / 3000, np.outer(rows, columns) / 13, atol=0.08)


def test_large_hypergeometric(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(sharding, "_NUMPY_LIMIT", 0)
    draws = [sharding.hypergeometric(30, 50, 20, rng) for _ in range(4000)]
    assert abs(np.mean(draws) - 7.5) < 0.1 and abs(np.var(draws) - 20 * .375 * .625 * 60 / 79) < 0.2
    big = sharding.hypergeometric(10 ** 12, 3 * 10 ** 12, 10 ** 11, rng)
    assert abs(big - 25 * 10 ** 9) < 10 ** 6
    assert sharding.split_counts(np.array([5, 0, 7]), 12, rng).tolist() == [5, 0, 7]


def test_shuffle_is_uniform(spark):
    seen = Counter()
    rows = spark.range(8).repartition(3).withColumnRenamed("id", "doc_id")
    for seed in range(25):
        for r in sharding.shuffle(rows, 4, seed=seed).collect():
            seen[r.doc_id, r.shard] += 1
    assert len(seen) > 28 and max(seen.values()) <= 17


# --- token counts

@pytest.mark.parametrize("block", [3, 1 << 20])
def test_token_counts(spark, block):
    rows = [r for r in EDGE if len(r[1] or "") < 100] + [(20, "w " * 30)] if block == 3 else EDGE
    docs = docs_of(spark, rows)
    bpe = loaded(tokens.public("byte_bpe_50k.tiktoken"))
    want = Counter((i, len(bpe.encode(t or ""))) for i, t in rows)
    assert Counter(tuple(r) for r in token_count.count_documents(docs, block_tokens=block).collect()) == want
    assert token_count.count_documents(docs.where("false")).count() == 0


def test_documents_of_token_files_are_not_broadcast(spark):
    """Their file is small and they are as many as the documents, so its size says nothing."""
    got = token_count.count_documents(docs_of(spark, [(i, f"t{i}") for i in range(300)]).repartition(3))
    for _ in range(2):  # as planned, and as run
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[path#\d+, nth#\d+L?\]", plan), plan
        assert sorted(r.doc_id for r in got.collect()) == list(range(300))


def test_a_run_of_blanks_is_counted(spark):
    """The library's own splitter fails on it."""
    text = "a" + " " * 1_500_000 + "b"
    ((_, n),) = token_count.count_documents(docs_of(spark, [(1, text)])).collect()
    ids = loaded(tokens.public("byte_bpe_50k.tiktoken")).encode(text)
    assert n == len(ids) and loaded(tokens.public("byte_bpe_50k.tiktoken")).decode(ids) == text.encode()


def test_scan_stitches_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_count, "RUN", 2)
    rnd, folder, want, files = random.Random(6), scratch(spark, "flat"), set(), []
    for f, n in enumerate((0, 1, 5, 64, 203)):
        ids = [rnd.choice([0, 0, 0, 0, 1, 2]) for _ in range(n)] if f != 3 else [7] * n  # one file without a separator
        path, out = store.new_file(folder, ".tokens")
        out.write(np.array(ids, dtype="<u2").tobytes())
        out.close()
        files.append((path, n))
        start = nth = 0
        for i, x in enumerate(ids):
            if x == 0:
                want.add((path, nth, start, i - start, True))
                start, nth = i + 1, nth + 1
        if start < n:
            want.add((path, nth, start, n - start, False))
    for block in (1, 4, 1000):
        got = token_count.scan(spark.createDataFrame(files, "path string, tokens long"), end=0, block_tokens=block)
        rows = [tuple(r) for r in got.select("path", "nth", "start", "n_tokens", "ended").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_written_shards(spark, tmp_path):
    docs = docs_of(spark, [(i, f"t{i}") for i in range(50)])
    sharding.write_shards(docs, str(tmp_path / "out"), shards=6, block_rows=3)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.text == f"t{r.doc_id}"
    assert sorted(map(len, slots.values())) == [8, 8, 8, 8, 9, 9] and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shuffle_is_the_same_after_lost_tasks(spark):
    """The same rows in the same partitions give the same shards, in whatever order a task
    reads them: numbers are written, draws are seeded by node, partition and block."""
    rows = spark.range(500).repartition(7, "id").withColumnRenamed("id", "doc_id")
    a = {(r.doc_id, r.shard, r.slot) for r in sharding.shuffle(rows, 5, seed=3, block_rows=20).collect()}
    b = {(r.doc_id, r.shard, r.slot) for r in sharding.shuffle(rows, 5, seed=3, block_rows=20).collect()}
    c = {(r.doc_id, r.shard, r.slot) for r in sharding.shuffle(rows, 5, seed=4, block_rows=20).collect()}
    assert a == b and a != c
