"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Base rules are fixed. On top, each learned rule rejects a document whose share (of
symbols, capitals, repeated words, repeated lines) reaches a cutoff, and cutoffs come
from labelled documents: in each stratum (language) a rule may use a cutoff only if
the exact binomial test shows, with the labelled good documents of the stratum, that
it rejects good ones at a rate below the rule's part of the risk.

* Risk: all rules together reject at most ``risk`` of the good documents of a stratum;
  each gets an equal part (a union bound).
* Confidence: the guarantees hold together with probability 1 - ``error``. Tests are
  corrected over strata and rules (Bonferroni); along one rule's cutoffs, from the
  strictest evidence to the weakest, testing stops at the first failure (a fixed
  sequence needs no further correction, as the rejected sets are nested).
* Of the cutoffs that pass, the one that gains most (labelled bad documents rejected
  less good ones) is used; with no gain, or no passing cutoff, the rule rejects
  nothing in that stratum.

Counts per (stratum, rule, cutoff) are combined before the shuffle, so a stratum that
holds a third of all rows costs one row per cutoff and task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import SPACE, fresh, let, text_of, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Cutoffs of every learned rule, as shares.
CUTOFFS = (0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Learned rules: name -> (numerator, denominator) among the features.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
}


def _repeated_words(ws: Column) -> Column:
    """Words of ``ws`` that lie in a 3-word window found twice or more.

    Windows are compared by 64-bit hash within the document. Most documents repeat
    none, which a hash set shows; the others sort (hash, place) and add up the union of
    the repeated windows. Work is n log n in the words of a document."""
    windows = F.when(F.size(ws) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))).otherwise(
            F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, k, x: F.coalesce(F.get(s, k).getField("h") == x.getField("h"), F.lit(False))
        repeated = let(pairs, lambda s: F.filter(s, lambda x, k: same(s, k - 1, x) | same(s, k + 1, x)))
        places = F.sort_array(F.transform(repeated, lambda x: x.getField("i")))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.when(k == 0, F.lit(3)).otherwise(
                F.least(F.lit(3), i - F.get(p, k - 1)))), F.lit(0), lambda a, b: a + b))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines,
    n_repeat_words (long) and base_failed. Null text has no words."""
    text = text_of(text_col)
    has_word = lambda line: line.rlike("[^" + SPACE[1:-1] + "]")
    lines = F.filter(F.split(text, "\n", -1), has_word)
    measured = F.struct(
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                            _repeated_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
        .alias("l"),
        F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"))
    (m,) = fresh(docs, "measured")
    rows = docs.withColumn(m, let(measured, lambda x: x))
    f = lambda *path: F.col(".".join([m, *path]))
    out = rows.select(*[F.col(f"`{c}`") for c in docs.columns], f("w", "n_words"), f("word_chars"), f("n_symbols"),
                      f("n_capitals"), f("l", "n_lines"), f("l", "n_dup_lines"), f("w", "n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


def _share(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _lgamma(x: Column) -> Column:
    """log gamma for x >= 1: Stirling's series after moving the argument up by 8."""
    up = x + 8
    series = ((up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up)
              - 1 / (360 * F.pow(up, 3)) + 1 / (1260 * F.pow(up, 5)))
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    return series - F.log(steps)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p). Below the mean the terms are added from k down,
    from the mean on it is 1 less the terms from k + 1 up, so the sum always starts at its
    largest term. Terms more than 14 standard deviations and 60 steps further out are under
    1e-35 of the part of the distribution that is summed; the result is 1 when k >= n."""
    k, n = k.cast("double"), n.cast("double")
    low = k < n * p
    first = F.when(low, k).otherwise(F.least(k + 1, n))
    top = (_lgamma(n + 1) - _lgamma(first + 1) - _lgamma(n - first + 1) + first * math.log(p)
           + (n - first) * math.log1p(-p))
    terms = F.least(F.when(low, k).otherwise(n - first), F.ceil(14 * F.sqrt(n * p * (1 - p))) + 60).cast("int")
    start = F.struct(top.alias("term"), F.exp(top).alias("sum"))

    def out(acc: Column, j: Column) -> Column:  # the j-th step leads j terms away from the first
        at = F.when(low, first - j + 1).otherwise(n - first - j + 1)
        odds = F.when(low, F.lit((1 - p) / p)).otherwise(F.lit(p / (1 - p)))
        term = acc.getField("term") + F.log(at * odds / (n - at + 1))
        return F.struct(term.alias("term"), (acc.getField("sum") + F.exp(term)).alias("sum"))

    steps = F.when(terms >= 1, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, out, lambda acc: acc.getField("sum"))
    tail = F.when(low, total).otherwise(1 - total)
    return F.when(k >= n, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def cutoffs(labelled: DataFrame, stratum: str, good: str, risk: float = 0.1, error: float = 0.05) -> DataFrame:
    """One row per stratum of ``labelled`` (features, ``stratum``, boolean ``good``): a
    column per rule with its cutoff, null where no cutoff passes or gains."""
    part = risk / len(RULES)
    shares = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _share(r).alias("share")) for r in RULES]))
    reached = F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS]), lambda c: c <= F.col("s.share")))
    # by number of cutoffs reached, so one table holds the counts of every cutoff
    bins = written(labelled.select(F.col(stratum).alias("stratum"), F.col(good).alias("good"), shares.alias("s"))
                   .groupBy("stratum", F.col("s.rule").alias("rule"), reached.alias("reached"))
                   .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")),
                   "bins")
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("at"), F.lit(c).alias("cutoff"))
                               for i, c in enumerate(CUTOFFS)]))
    tests = bins.select("stratum").distinct().count() * len(RULES)
    level = error / max(tests, 1)
    hit = F.col("reached") >= F.col("at")
    counts = (bins.withColumn("g", grid).select("*", "g.at", "g.cutoff").groupBy("stratum", "rule", "at", "cutoff")
              .agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
                   F.sum(F.when(hit, F.col("good")).otherwise(0)).alias("good_out"),
                   F.sum(F.when(hit, F.col("bad")).otherwise(0)).alias("bad_out")))
    tail = F.when(F.col("n_good") > 0, binomial_tail(F.col("good_out"), F.greatest("n_good", F.lit(1)), part)).otherwise(1.0)
    gain = F.col("bad_out") - F.col("good_out")
    # from the highest cutoff down; a failure closes all lower ones
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    passed = (counts.withColumn("passes", F.min((tail <= level).cast("int")).over(down) == 1)
              .withColumn("gain", gain).where("passes and gain > 0"))
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff")).alias("best"))
    return written(best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("best.cutoff"))).alias(r) for r in RULES]), "cutoffs")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", label_col: str = "quality", risk: float = 0.1, error: float = 0.05,
          keep_text: bool = True) -> DataFrame:
    """``docs`` (all columns, the text only if ``keep_text``) with the features, ``base_failed`` and ``kept``.

    ``labels`` holds ``id_col`` and ``label_col`` (1 good, 0 bad; null labels and null ids
    are not used, several labels of an id count as good only if all are). Rows whose base
    rules fail are rejected and not used for calibration. Null strata form one stratum.
    Columns of ``docs`` that are named like a feature, ``base_failed`` or ``kept`` are
    replaced. An empty ``docs`` gives no rows; empty ``labels`` leave the base rules alone.
    """
    made = {"n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept"}
    if made & {id_col, text_col, stratum_col}:
        raise ValueError(f"input columns may not be named like results: {sorted(made)}")
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made])
    stratum, = fresh(own, "stratum")
    measured = features(own, text_col)
    scored = written((measured if keep_text else measured.drop(text_col))
                     .withColumn(stratum, F.coalesce(F.concat(F.lit("s"), F.col(stratum_col).cast("string")), F.lit("n"))),
                     "features")
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.min((F.col(label_col) == 1).cast("int")).alias("good")))
    used = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"]
    labelled = (scored.where("not base_failed").select(F.col(id_col).alias("id"), F.col(stratum).alias("stratum"), *used)
                .join(marks, "id").withColumn("good", F.col("good") == 1))
    limits = cutoffs(labelled, "stratum", "good", risk, error)
    names = fresh(scored, "at_stratum", *[f"at_{r}" for r in RULES])
    limits = limits.toDF(*names)
    over = F.lit(False)
    for rule, at in zip(RULES, names[1:], strict=True):
        over = over | F.coalesce(_share(rule) >= F.col(at), F.lit(False))
    out = scored.join(limits, F.col(stratum) == F.col(names[0]), "left").withColumn("kept", ~F.col("base_failed") & ~over)
    return out.drop(stratum, *names)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", label_col: str = "quality", risk: float = 0.1, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, whatever they are
    named (other columns go under numbers meanwhile)."""
    used = [id_col, text_col, stratum_col]
    other = [c for c in docs.columns if c not in used]
    slim = docs.select(*used, *[F.col(f"`{c}`").alias(f"other_{i}") for i, c in enumerate(other)])
    good = judge(slim, labels, id_col, text_col, stratum_col, label_col, risk, error).where("kept")
    names = {c: f"other_{i}" for i, c in enumerate(other)}
    return good.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
