"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Each document gets a fixed 64-bit hash. A source's share is all documents below a
hash threshold, found without sorting: sizes are summed by (source, first 12 bits),
the running sum shows in which bucket the budget ends, and only the rows of that
bucket are summed again by the next 12 bits, then by the rest. Thresholds are nested:
a larger budget takes a superset. Sums are combined before each shuffle, so a source
that holds a third of all rows sends one row per bucket and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import SPACE, fresh, text_of, written

#: Hex digits of the hash that each round of refinement reads: 12, 12 and 40 bits.
ROUNDS = ((1, 3), (4, 3), (7, 10))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-white-space."""
    return F.regexp_count(text, F.lit("[^" + SPACE[1:-1] + "]+")).cast("long")


def targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights``, repeating. Together they
    get ``share`` times all sizes in proportion to weight; none gets more than ``limit``
    times its size, and what is cut is shared out again by weight until none is above.
    That fixed point is a water level: with sources in order of limit by weight, the
    first k are at their limit and the rest get level times weight. One row per source,
    so the two global windows see a dimension table, not documents.
    """
    if not limit >= share > 0:
        raise ValueError("share must be above 0 and at most limit")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn(
        "weight", F.element_at(cyc, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(limit))
    by_ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(float(share))
    level = ((total - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # level: as if this source were the first below its limit; it is right for the first that fits
    ratio = F.col("cap") / F.col("weight")
    levels = ranked.withColumn("level", level).withColumn("cap", cap).withColumn("nth", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= ratio, F.struct("nth", "level"))).over(every)
    return levels.withColumn("first", first).select(
        "source", "source_size", "weight", F.least("cap", F.col("first.level") * F.col("weight")).alias("target"))


def _hash(id_col: str, text_col: str, seed: str) -> Column:
    key = F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 16)


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source (``src``), ``cut``: documents with a hash up to it (as hex text) make up
    the part of ``rest`` nearest to it. No row for a source whose ``rest`` is 0."""
    open_ = budgets.where("rest > 0").select("src", "rest", F.lit(0).cast("long").alias("below"),
                                             F.lit("").alias("prefix"))
    for start, digits in ROUNDS:
        # only rows of the boundary buckets survive this join: 1 in 4096 after round 1
        rows = sized.withColumn("prefix", F.substring("h", 1, start - 1)).join(
            open_.select("src", "prefix"), ["src", "prefix"], "left_semi")
        sums = (rows.groupBy("src", "prefix", F.substring("h", start, digits).alias("digits"))
                .agg(F.sum("size").alias("size")).join(open_, ["src", "prefix"]))
        run = Window.partitionBy("src").orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
        reached = sums.withColumn("upto", F.col("below") + F.sum("size").over(run)).where("upto >= rest")
        ends = written(reached.groupBy("src").agg(F.min(F.struct("digits", "upto", "size", "rest", "prefix")).alias("b")),
                       "boundary")
        open_ = ends.select("src", F.col("b.rest").alias("rest"), (F.col("b.upto") - F.col("b.size")).alias("below"),
                            F.concat("b.prefix", "b.digits").alias("prefix"))
    last = ends.select("src", F.concat("b.prefix", "b.digits").alias("prefix"), "b.upto", "b.rest",
                       (F.col("b.upto") - F.col("b.size")).alias("below"))
    # take the boundary hash itself if that comes nearer than stopping before it
    take = (F.col("upto") - F.col("rest")) <= (F.col("rest") - F.col("below"))
    return last.select("src", F.col("prefix").alias("cut"), take.alias("inclusive"))


def _source_key(source_col: str) -> Column:
    """A join key that null has too; 's...' and 'n' cannot be equal."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))


def _rules(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, limit: float,
           seed: str) -> tuple[DataFrame, DataFrame]:
    """The documents without text, and one row per source: what the mix takes of it."""
    sized = written(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), _source_key(source_col).alias("src"),
        word_count(text_of(text_col)).alias("size"), _hash(id_col, text_col, seed).alias("h")), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budgets = written(targets(sums, weights, share, limit)
                      .withColumn("src", _source_key("source")).withColumn("whole", whole.cast("int"))
                      .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "budgets")
    cuts = _thresholds(sized.select("src", "size", "h"), budgets)
    return sized, written(budgets.join(cuts, "src", "left")
                          .select("src", "source_size", "target", "whole", "cut", "inclusive"), "rules")


def _copies(h: Column, whole: Column, cut: Column, inclusive: Column) -> Column:
    below = F.when(inclusive, h <= cut).otherwise(h < cut)
    return whole + F.coalesce(below, F.lit(False)).cast("int")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size`` (words; null text has none),
    ``source`` (null is a source of its own), ``source_size``, ``target`` of the source,
    ``copies`` (how often the mix takes the row) and ``taken`` = size * copies.

    A target of k whole sizes and a rest takes every document k times and those below
    the threshold of the rest once more. The hash is that of the id as text (of the text
    where the id is null), so reruns agree; rows that agree in it are taken alike.
    An empty table gives no rows, a source of empty texts has target 0.
    """
    sized, rule = _rules(docs, id_col, text_col, source_col, weights, share, limit, seed)
    copies = _copies(F.col("h"), F.col("whole"), F.col("cut"), F.col("inclusive"))
    return (sized.join(rule, "src").withColumn("copies", copies)
            .select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, each as often as ``plan`` takes it.
    The rules (one row per source) meet the texts where they are read; texts are not
    shuffled unless there are more sources than the planner broadcasts."""
    _, rule = _rules(docs, id_col, text_col, source_col, weights, share, limit, seed)
    src, whole, cut, inclusive, copy = fresh(docs, "src", "whole", "cut", "inclusive", "copy")
    times = _copies(_hash(id_col, text_col, seed), F.col(whole), F.col(cut), F.col(inclusive))
    return (docs.withColumn(src, _source_key(source_col))
            .join(rule.select("src", "whole", "cut", "inclusive").toDF(src, whole, cut, inclusive), src)
            .withColumn(copy, F.explode(F.array_repeat(F.lit(True), times)))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
