"""Exact dedup, mixing and quality rules on hand-made rows."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keepwell.llm import exact, mixing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, h string, src int, `a.b` int"


def docs_of(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, 0, "x", "y", 1, 2) for r in rows], DOCS)


EDGE = [
    (1, "same text", "en", "a"), (2, "same text", "en", "b"), (3, None, None, None), (4, "", "en", None),
    (5, "same texu", "de", "a"), (6, "x" * 300_000, "en", "a"), (7, "x" * 299_999 + "y", "en", "a"),
    (8, "x" * 300_000, "fr", "z"), (9, "lone", "en", "é"), (9, "lone", "en", "é"), (None, "lone", "en", "é"),
    (None, "nobody", "en", "a"), (None, "nobody", "en", "a"), (10, " same text", "en", "a"),
]


def test_exact_marks(spark):
    got = [r.asDict() for r in exact.mark(docs_of(spark, EDGE), digest_all=True).collect()]
    assert len(got) == len(EDGE)
    groups = defaultdict(list)
    for i, t, *_ in EDGE:
        groups[t or ""].append(i)
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r["text_sha256"]].append(r)
    for text, ids in groups.items():
        rows = by_sha[hashlib.sha256(text.encode()).hexdigest()]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
        assert {r["keep_id"] for r in rows} == {keep} and {r["group_size"] for r in rows} == {len(ids)}
        assert [r["doc_id"] for r in rows if r["kept"]] == [keep]  # one row exactly


def test_exact_digest_only_of_suspects(spark):
    rows = exact.mark(docs_of(spark, EDGE)).collect()
    sha = {r.doc_id: r.text_sha256 for r in rows}
    assert sha[1] and sha[6] and sha[10] is None


def test_exact_keeps_one_whole_row_of_each(spark):
    docs = docs_of(spark, EDGE)
    out = exact.deduplicate(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(len(r.text or "") for r in kept) == sorted(len(t) for t in {t or "" for _, t, *_ in EDGE})
    assert {r.text: r.doc_id for r in kept}["same text"] == 2
    assert {r.text: r.source for r in kept}["x" * 300_000] == "z"


def test_exact_empty(spark):
    none = docs_of(spark, EDGE).where("false")
    assert exact.mark(none).count() == 0 and exact.deduplicate(none).count() == 0


def test_exact_plan_has_no_python(spark):
    plan = exact.deduplicate(docs_of(spark, EDGE))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def _targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(limit * sizes[s] for s in capped)
        t = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if t[s] > limit * sizes[s]}
        if not over:
            return t | {s: limit * sizes[s] for s in capped}
        capped |= over


def test_mixing_targets_and_words(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", s) for i, s in enumerate(["a"] * 300 + ["b"] * 20 + [None] * 90 + ["é"] * 60)]
    rows += [(None, "one two", "en", "a"), (9999, None, "en", "b"), (9998, "", "en", "only empty")]
    got = mixing.plan(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want = _targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 7 / 2  # half of the largest document
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mixing_is_nested_and_repeats(spark):
    docs = docs_of(spark, [(i, "a b c", "en", "s") for i in range(500)])
    small, large = (mixing.plan(docs, share=s) for s in (0.2, 0.6))
    a = {r.doc_id for r in small.where("taken > 0").collect()}
    b = {r.doc_id for r in large.where("taken > 0").collect()}
    assert a < b and len(a) == 100 and len(b) == 300
    again = mixing.plan(docs.repartition(7), share=0.2).where("taken > 0").collect()
    assert a == {r.doc_id for r in again}


def test_mix_rows(spark):
    docs = docs_of(spark, [(i, "a b", "en", "s" if i % 3 else None) for i in range(60)])
    plan = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in plan.items() if v})
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.plan(docs.where("false")).count() == 0


def _repeated(words):
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    return len({p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)})


TEXTS = [None, "", " \n\t ", "a", "a a", "a a a", "a a a a", "x y z x y z", "a b c d a b c e b c d", "é # b\nc\n\nc\n c\n#*$%&|<>",
         "one\x0btwo\x0cthree\rfour five six", "p q " * 40, " ".join(f"w{i % 50}" for i in range(120)),
         " ".join(f"w{i}" for i in range(60)), "long " * 50_000]


def test_quality_features(spark):
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in quality.features(docs).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        ws = [w.decode() for w in raw.split()]  # bytes.split: ASCII white space only
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(ws), sum(map(len, ws)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_lines == len(lines)
        assert r.n_repeat_words == _repeated(ws)
        assert r.base_failed == (len(ws) < 50 or 100 * _repeated(ws) > 50 * len(ws))


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (3, 10, 0.1), (10, 10, 0.1), (5, 2000, 0.025), (40, 2000, 0.025), (0, 15000, 0.05), (700, 15000, 0.05)]
    for k, n, p in cases:
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p)
                            + (n - j) * math.log1p(-p)) for j in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-8)


def test_binomial_tail_far_above_the_mean(spark):
    for k, n, p in [(500, 5000, 0.025), (1000, 20_000, 0.025), (300, 1000, 0.025), (4999, 5000, 0.025), (126, 5000, 0.025), (160, 5000, 0.025), (125, 5000, 0.025)]:
        above = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p)
                             + (n - j) * math.log1p(-p)) for j in range(k + 1, n + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        assert got == pytest.approx(1 - above, rel=1e-8)


def test_a_jump_of_rejected_good_ones_is_refused(spark):
    """At cutoffs down to 0.25, 1 % of the good documents go, from 0.2 on 30 %: more bad ones
    would go there, but no cutoff below 0.25 may be used."""
    schema = ("stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_capitals long, "
              "n_lines long, n_dup_lines long, n_repeat_words long")
    kinds = [(True, 20, 520), (True, 580, 220), (True, 1400, 0), (False, 1000, 520), (False, 3000, 220)]
    rows = [("a", good, 200, 1000, symbols, 0, 20, 0, 0) for good, n, symbols in kinds for _ in range(n)]
    (limit,) = quality.cutoffs(spark.createDataFrame(rows, schema), "stratum", "good", risk=0.1).collect()
    assert limit["symbols"] == 0.5


def _labelled(spark, n_good, n_bad, bad_good=0):
    """Good documents without symbols (``bad_good`` of them with), bad ones full of them."""
    plain = " ".join(f"w{i}" for i in range(60))
    noisy = " ".join(f"w{i}###" for i in range(60))
    rows = [(i, noisy if i < bad_good else plain, "en", "s") for i in range(n_good)]
    rows += [(10_000 + i, noisy, "en", "s") for i in range(n_bad)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000)) for r in rows] + [(None, 1), (1, None)], "doc_id long, quality int")
    return docs_of(spark, rows), labels


def test_rules_need_evidence(spark):
    docs, labels = _labelled(spark, 600, 50)
    out = quality.judge(docs, labels)
    assert {r.doc_id for r in out.where("not kept").collect()} == set(range(10_000, 10_050))
    docs, labels = _labelled(spark, 60, 50)  # too few good documents to show a rate below the risk
    assert quality.judge(docs, labels).where("not kept").count() == 0
    docs, labels = _labelled(spark, 600, 50, bad_good=60)  # a tenth of the good ones would go
    assert quality.judge(docs, labels).where("not kept").count() == 0


def test_quality_edges(spark):
    docs, labels = _labelled(spark, 600, 50)
    assert quality.judge(docs.where("false"), labels).count() == 0
    assert quality.judge(docs, labels.where("false")).where("not kept").count() == 0
    odd = docs.unionByName(docs_of(spark, [(None, None, None, None), (77, "w " * 60, None, None), (77, "w " * 60, None, None)]))
    good = quality.keep_good(odd, labels)
    assert good.columns == odd.columns and good.count() == 600
    with pytest.raises(ValueError):
        quality.judge(docs, labels, text_col="kept")


def test_certified_cutoffs_hold_on_new_documents(spark):
    """Overlapping shares: whatever is chosen rejects at most the risk of good documents that
    the calibration has not seen, in each stratum; without overlap all bad ones go."""
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(12_000):
        stratum, good = ("a", "b")[i % 2], rnd.random() < 0.85
        centre = 0.1 if good else (0.22 if stratum == "a" else 0.6)  # close in a, apart in b
        symbols = max(0, int(1000 * rnd.gauss(centre, 0.05)))
        rows.append((i, stratum, good, 200, 1000, symbols, 30, 20, 0, 0))
    schema = ("doc_id int, stratum string, good boolean, n_words long, word_chars long, n_symbols long, n_capitals long, "
              "n_lines long, n_dup_lines long, n_repeat_words long")
    table = spark.createDataFrame(rows, schema)
    limits = {r.stratum: r.asDict() for r in quality.cutoffs(table.where("doc_id < 6000"), "stratum", "good", risk=0.1).collect()}
    assert set(limits) == {"a", "b"} and all(r["symbols"] and not r["lines"] for r in limits.values())
    for stratum, limit in limits.items():
        new = [(r[2], r[5] / 1000 >= limit["symbols"]) for r in rows if r[0] >= 6000 and r[1] == stratum]
        rejected = [out for good, out in new if good]
        assert sum(rejected) / len(rejected) <= 0.1 / len(quality.RULES) * 1.3
        caught = [out for good, out in new if not good]
        # in a, 0.2 would reject 2.3 % of the good: too near to 2.5 % to certify; 0.25 is next and catches 27 %
        assert limit["symbols"] == 0.25 or stratum == "b"
        assert sum(caught) / len(caught) > (0.2 if stratum == "a" else 0.99)
