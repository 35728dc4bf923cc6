"""Reference-based drift monitoring.

A reference is read once and kept as a baseline: one row per monitored column, its
quantiles, its categories, the counts of its bins between deciles, and an ordered index of
its distribution: every distinct value with the count of values up to it, cut into
``INDEX_BUCKETS`` ranges of about equal count per column, and a table of those ranges.

A current batch is unpivoted and counted once. Bins, ranges and rates of the reference are
tables of a bounded number of rows, so a comparison aggregates values of the batch only. For
the KS statistic the ranges also give bounds: between two range ends the reference rises from
one known count to another, and so does the batch, which bounds their distance in between.
Values of the reference are read again only in ranges whose bound exceeds the greatest
distance found at an end. All columns are handled by the same jobs, grouped by column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.config import DriftThresholds
from keepwell.operators.ordered import lerp, ordered_prefix
from keepwell.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from keepwell.scratch import written

PROBABILITY = "churn_probability"
QUANTILE_LEVELS = [i / 10 for i in range(11)]
PSI_FLOOR = 1e-6
#: Ranges of the distribution index per column, which bounds every table that is broadcast.
INDEX_BUCKETS = 1024
#: Parts of an open range that are swept side by side.
RANGE_PARTS = 64
# numpy.allclose defaults (fixed values)
ALLCLOSE_RTOL = 1e-5
ALLCLOSE_ATOL = 1e-8
MONITORED = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, PROBABILITY]
ALERT_SCHEMA = "alert_order int, severity string, column_name string, issue string, value double, detail string"


def monitored_columns(df: DataFrame) -> list[tuple[str, str]]:
    """(column, kind) in baseline order: numeric features, categorical, probability."""
    def kind(c: str) -> str:
        return "probability" if c == PROBABILITY else "categorical" if c in CATEGORICAL_FEATURES else "numeric"

    return [(c, kind(c)) for c in MONITORED if c in df.columns]


def numeric_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, present) rows; text columns parse leniently."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value double, present boolean")
    parts = []
    for c in cols:
        dtype = df.schema[c].dataType
        v = F.col(c).cast("double") if isinstance(dtype, T.NumericType) else F.col(c).cast("string").try_cast("double")
        parts.append(F.struct(F.lit(c).alias("column_name"), v.alias("value"), F.col(c).isNotNull().alias("present")))
    return df.select(F.explode(F.array(*parts)).alias("_u")).select("_u.*")


def _counted(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, present, n): how often each value occurs. Null values with
    ``present`` are text that is no number."""
    return written(numeric_long(df, cols).groupBy("column_name", "value", "present").agg(F.count(F.lit(1)).alias("n")),
                   "value_counts")


def _categories(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, category, n), null as its own category."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, category string, n long")
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in cols])
    return written(df.select(F.explode(parts).alias("_u")).groupBy("_u.column_name", "_u.category")
                   .agg(F.count(F.lit(1)).alias("n")), "category_counts")


@dataclass
class Baseline:
    """stats: column_name, column_order, kind, rows, missing_rate, minimum, maximum, n_categories;
    quantiles: column_name, q_index, q, quantile; categories: counts; bins: column_name, edges,
    bin, r, vr (count and sum of the values in a bin between deciles); index: column_name,
    bucket, value, n, upto; ranges: column_name, bucket, lo, before, upto, per bucket of the
    index its least value and the counts of values before and up to its last one."""

    stats: DataFrame
    quantiles: DataFrame
    categories: DataFrame
    bins: DataFrame
    index: DataFrame
    ranges: DataFrame


TABLES = ("stats", "quantiles", "categories", "bins", "index", "ranges")


def build_baseline(reference: DataFrame, buckets: int = INDEX_BUCKETS) -> Baseline:
    cols = monitored_columns(reference)
    values = _counted(reference, [c for c, k in cols if k != "categorical"])
    categories = _categories(reference, [c for c, k in cols if k == "categorical"])
    missing = F.sum(F.when(F.col("present"), 0).otherwise(F.col("n"))) / F.sum("n")
    is_prob = F.col("column_name") == F.lit(PROBABILITY)
    of_values = values.groupBy("column_name").agg(F.sum("n").alias("rows"), missing.alias("missing_rate"),
                                                  F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        "column_name", "rows", "missing_rate", F.when(is_prob, F.lit(0.0)).otherwise(F.col("lo")).alias("minimum"),
        F.when(is_prob, F.lit(1.0)).otherwise(F.col("hi")).alias("maximum"), F.lit(None).cast("long").alias("n_categories"))
    of_categories = categories.groupBy("column_name").agg(
        F.sum("n").alias("rows"), (F.sum(F.when(F.col("category").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("missing_rate"),
        F.lit(None).cast("double").alias("minimum"), F.lit(None).cast("double").alias("maximum"),
        F.count("category").alias("n_categories"))
    known = reference.sparkSession.createDataFrame(
        [(c, MONITORED.index(c), k) for c, k in cols], "column_name string, column_order int, kind string")
    stats = written(known.join(of_values.unionByName(of_categories), "column_name"), "baseline_stats")
    swept = ordered_prefix(_present(values).select("column_name", "value", "n"), [("value", True)], sums={"upto": F.col("n")},
                           by=["column_name"], rank_col="_vr", totals=True)
    index = written(swept.select(
        "column_name", F.expr(f"(upto - n) * {int(buckets)} div upto_total").cast("int").alias("bucket"), "value", "n", "upto"), "index")
    ranges = written(index.groupBy("column_name", "bucket").agg(
        F.min("value").alias("lo"), F.min(F.col("upto") - F.col("n")).alias("before"), F.max("upto").alias("upto")), "ranges")
    quantiles = written(indexed_quantiles(index, ranges, QUANTILE_LEVELS), "baseline_quantiles")
    edges = quantiles.groupBy("column_name").agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # at most 11 a column
    binned = _binned(index.select("column_name", "value", "n"), edges)
    bins = written(binned.groupBy("column_name", "edges", "bin").agg(
        F.sum("n").alias("r"), F.sum(F.col("n") * F.col("value")).alias("vr")), "bins")
    return Baseline(stats, quantiles, categories, bins, index, ranges)


def indexed_quantiles(index: DataFrame, ranges: DataFrame, probs) -> DataFrame:
    """(column_name, q_index, q, quantile) from a distribution index: a wanted place lies in one
    range, and only values of such ranges are read."""
    wanted = ranges.groupBy("column_name").agg((F.max("upto") - 1).alias("last")).select(
        "column_name", F.explode(F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(float(p)).alias("q"),
                                                    (F.col("last").cast("double") * F.lit(float(p))).alias("h"))
                                           for i, p in enumerate(probs)])).alias("t"), "last").select(
        "column_name", "t.*", F.floor("t.h").cast("long").alias("low"), F.least(F.floor("t.h").cast("long") + 1, F.col("last")).alias("high"))
    held = lambda at: (F.col("before") <= F.col(at)) & (F.col(at) < F.col("upto"))
    # a row per column, quantile and range that holds one of its two places: 22 a column at most
    places = ranges.join(F.broadcast(wanted), "column_name").where(held("low") | held("high")).drop("lo", "before", "upto")
    first = F.col("upto") - F.col("n")
    at = lambda i: F.min(F.when((first <= F.col(i)) & (F.col(i) < F.col("upto")), F.col("value")))
    found = index.join(F.broadcast(places), ["column_name", "bucket"]).groupBy("column_name", "q_index", "q").agg(
        at("low").alias("a"), at("high").alias("b"), F.max("h").alias("h"), F.max("low").alias("low"))
    return found.select("column_name", "q_index", "q", lerp(F.col("a"), F.col("b"), F.col("h") - F.col("low").cast("double")).alias("quantile"))


def _binned(values: DataFrame, edges: DataFrame) -> DataFrame:
    """``values`` with the ``edges`` of their column and their ``bin`` [a, b) between them, open at both ends."""
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    return values.join(F.broadcast(edges), "column_name").withColumn(
        "bin", F.size(F.filter(inner, lambda e: e <= F.col("value"))))


def _present(values: DataFrame) -> DataFrame:
    return values.where(F.col("value").isNotNull() & ~F.isnan("value"))


def as_baseline(reference: DataFrame | Baseline) -> Baseline:
    return reference if isinstance(reference, Baseline) else build_baseline(reference)


def baseline_stats(reference: DataFrame | Baseline) -> DataFrame:
    """One row per monitored column: kind, missing rate, range or number of categories."""
    return as_baseline(reference).stats.select("column_name", "kind", "rows", "missing_rate", "minimum", "maximum", "n_categories")


def baseline_quantiles(reference: DataFrame | Baseline) -> DataFrame:
    """The 11 reference quantiles (0, .1, …, 1) of every numeric column."""
    return as_baseline(reference).quantiles.where(F.col("column_name") != PROBABILITY)


@dataclass
class Batch:
    """A current batch, counted once."""

    columns: list[str]
    values: DataFrame
    categories: DataFrame


def count_batch(current: DataFrame) -> Batch:
    cols = monitored_columns(current)
    return Batch(current.columns, _counted(current, [c for c, k in cols if k != "categorical"]),
                 _categories(current, [c for c, k in cols if k == "categorical"]))


def as_batch(current: DataFrame | Batch) -> Batch:
    return current if isinstance(current, Batch) else count_batch(current)


def _present_counts(base: Baseline, batch: Batch) -> DataFrame:
    """(column_name, nr, nc): values of both sides, for columns of both; a row per column."""
    ref = base.ranges.groupBy("column_name").agg(F.max("upto").alias("nr"))
    now = batch.values.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.col("n")).otherwise(0)).alias("nc"))
    shared = base.stats.where(F.col("kind") != "categorical").select("column_name").join(now, "column_name")
    counts = shared.join(F.broadcast(ref), "column_name", "left").withColumn("nr", F.coalesce("nr", F.lit(0).cast("long")))
    return counts.where("nr > 0 or nc > 0").select("column_name", "nr", "nc")


def psi(reference: DataFrame | Baseline, current: DataFrame | Batch) -> DataFrame:
    """Population stability index per numeric column: reference deciles (distinct)
    as edges with open outer ends, bins [a, b), shares floored at 1e-6.
    Empty side → null; fewer than 3 edges → 0 if the means are close, else 1."""
    base, batch = as_baseline(reference), as_batch(current)
    edges = base.bins.select("column_name", "edges").distinct()
    now = _binned(_present(batch.values).select("column_name", "value", "n"), edges).groupBy("column_name", "bin").agg(
        F.sum("n").alias("c"), F.sum(F.col("n") * F.col("value")).alias("vc"))
    none = F.lit(None).cast("long")
    # at most 10 bins a column on either side
    both = base.bins.select("column_name", "bin", "r", "vr", none.alias("c"), none.cast("double").alias("vc"),
                            F.size("edges").alias("n_edges")).unionByName(
        now.select("column_name", "bin", none.alias("r"), none.cast("double").alias("vr"), "c", "vc", none.cast("int").alias("n_edges")))
    bins = both.groupBy("column_name", "bin").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("r", "c", "vr", "vc")], F.max("n_edges").alias("n_edges"))
    per = bins.groupBy("column_name").agg(
        F.sort_array(F.collect_list(F.struct("bin", "r", "c"))).alias("bins"),
        F.sum("vr").alias("vr"), F.sum("vc").alias("vc"), F.max("n_edges").alias("n_edges"))

    def part(total: Column, b: Column) -> Column:
        was = F.greatest(b["r"] / F.col("nr"), F.lit(PSI_FLOOR))
        now = F.greatest(b["c"] / F.col("nc"), F.lit(PSI_FLOOR))
        return total + (now - was) * F.log(now / was)

    mean_r, mean_c = F.col("vr") / F.col("nr"), F.col("vc") / F.col("nc")
    close = F.abs(mean_r - mean_c) <= F.lit(ALLCLOSE_ATOL) + F.lit(ALLCLOSE_RTOL) * F.abs(mean_c)
    return _present_counts(base, batch).join(F.broadcast(per), "column_name", "left").select(
        "column_name", F.when((F.col("nr") == 0) | (F.col("nc") == 0), F.lit(None).cast("double"))
        .when(F.col("n_edges") < 3, F.when(close, F.lit(0.0)).otherwise(F.lit(1.0)))
        .otherwise(F.aggregate("bins", F.lit(0.0), part)).alias("psi"))


def _in_ranges(base: Baseline, batch: Batch) -> DataFrame:
    """(column_name, value, c, bucket): values of the batch with the range of the reference
    that they lie in, -1 below all of them. At most ``INDEX_BUCKETS`` ends a column are compared
    in two levels: every 32nd first, then those up to the next."""
    ends = base.ranges.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("lo", "bucket"))).alias("ends")).select(
        "column_name", F.col("ends.lo").alias("los"), F.col("ends.bucket").alias("buckets"))
    step = 32
    coarse = F.transform(F.sequence(F.lit(1), F.size("los"), F.lit(step)), lambda i: F.element_at("los", i))
    begin = F.greatest(F.size(F.filter("coarse", lambda e: e <= F.col("value"))) - 1, F.lit(0)) * step
    place = F.col("begin") + F.size(F.filter(F.slice("los", F.col("begin") + 1, F.lit(step)), lambda e: e <= F.col("value")))
    rows = _present(batch.values).select("column_name", "value", F.col("n").alias("c")).join(
        F.broadcast(ends.withColumn("coarse", coarse)), "column_name").withColumn("begin", begin)
    return rows.select("column_name", "value", "c", F.coalesce(F.get("buckets", place - 1), F.lit(-1)).alias("bucket"))


def ks_statistic(reference: DataFrame | Baseline, current: DataFrame | Batch) -> DataFrame:
    """Two-sample KS statistic per numeric column: max |F_ref − F_cur| over every observed
    value; null where a side has none.

    At the ends of a range of the reference both counts are known. Within, both only rise, so
    the distance there is at most that of the one's last and the other's first count. Ranges
    whose bound does not exceed the best distance at an end are done; in the others the values
    of both sides are swept in order."""
    base, batch = as_baseline(reference), as_batch(current)
    counts = _present_counts(base, batch)
    values = _in_ranges(base, batch)
    found = values.groupBy("column_name", "bucket").agg(F.sum("c").alias("c_in"))
    ends = base.ranges.join(found, ["column_name", "bucket"], "full")
    one_column = Window.partitionBy("column_name")  # INDEX_BUCKETS rows and one a column
    order = one_column.orderBy("bucket")
    c_upto = F.coalesce(F.sum("c_in").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    zero = F.lit(0).cast("long")
    ends = ends.select("column_name", "bucket", F.max("upto").over(one_column).alias("nr"), F.sum("c_in").over(one_column).alias("nc"),
                       F.coalesce("before", zero).alias("r0"), F.coalesce("upto", zero).alias("r1"),
                       F.coalesce("c_in", zero).alias("c_in"), c_upto.alias("c1")).withColumn("c0", F.col("c1") - F.col("c_in"))
    gap = lambda r, c: F.abs(F.col(r) / F.col("nr") - F.col(c) / F.col("nc"))
    ends = ends.where("nr > 0 and nc > 0").withColumns({
        "at_ends": F.greatest(gap("r0", "c0"), gap("r1", "c1")), "bound": F.greatest(gap("r1", "c0"), gap("r0", "c1"))})
    ends = ends.withColumn("best", F.max("at_ends").over(one_column))
    open_ranges = ends.where("c_in > 0 and bound > best").select("column_name", "bucket", "r0", "c0", "nr", "nc")
    ref = base.index.join(F.broadcast(open_ranges), ["column_name", "bucket"]).select(
        "column_name", "bucket", "r0", "c0", "nr", "nc", "value", F.col("n").alias("r"), zero.alias("c"))
    now = values.join(F.broadcast(open_ranges), ["column_name", "bucket"]).select(
        "column_name", "bucket", "r0", "c0", "nr", "nc", "value", zero.alias("r"), "c")
    known = ["column_name", "bucket", "r0", "c0", "nr", "nc"]
    met = ref.unionByName(now).groupBy(*known, "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    # a batch may lie in one range alone, so a range is cut at approximate quantiles of its values:
    # they balance the tasks and decide nothing else
    one, part = ["column_name", "bucket"], ["column_name", "bucket", "part"]
    cuts = met.groupBy(*one).agg(F.percentile_approx("value", [i / RANGE_PARTS for i in range(1, RANGE_PARTS)], 1000).alias("cuts"))
    placed = met.join(cuts, one).withColumn("part", F.size(F.filter("cuts", lambda e: e < F.col("value")))).drop("cuts")
    before = Window.partitionBy(*one).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*part).agg(F.sum("r").alias("r"), F.sum("c").alias("c")).select(
        *part, *[F.coalesce(F.sum(x).over(before), zero).alias(f"{x}_before") for x in ("r", "c")])
    sweep = Window.partitionBy(*part).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inner = placed.select(*part, "r0", "c0", "nr", "nc", F.sum("r").over(sweep).alias("r"), F.sum("c").over(sweep).alias("c")).join(
        offsets, part).select("column_name", "nr", "nc", (F.col("r0") + F.col("r_before") + F.col("r")).alias("r"),
                              (F.col("c0") + F.col("c_before") + F.col("c")).alias("c"))
    best = ends.select("column_name", F.col("best").alias("gap")).unionByName(inner.select("column_name", gap("r", "c").alias("gap"))) \
        .groupBy("column_name").agg(F.max("gap").alias("ks_statistic"))
    return counts.select("column_name").join(F.broadcast(best), "column_name", "left")


def range_and_missing(reference: DataFrame | Baseline, current: DataFrame | Batch) -> DataFrame:
    """Per baseline column present in ``current``: missing rate, type-error rate and
    share outside the reference [min, max] (unknown → inside)."""
    base, batch = as_baseline(reference), as_batch(current)
    stats = F.broadcast(base.stats.select("column_name", "minimum", "maximum"))  # one row per column
    n, total = F.col("n"), F.sum("n")
    rate = lambda cond: F.sum(F.when(F.coalesce(cond, F.lit(False)), n).otherwise(0)) / total
    numeric = batch.values.join(stats, "column_name").groupBy("column_name").agg(
        rate(~F.col("present")).alias("missing_rate"),
        rate(F.col("present") & F.col("value").isNull()).alias("type_error_rate"),
        rate((F.col("value") < F.col("minimum")) | (F.col("value") > F.col("maximum"))).alias("outside_reference_range_rate"))
    none = F.lit(None).cast("double")
    categorical = batch.categories.join(stats, "column_name").groupBy("column_name").agg(
        rate(F.col("category").isNull()).alias("missing_rate")).withColumns(
        {"type_error_rate": none, "outside_reference_range_rate": none})
    return numeric.unionByName(categorical)


def new_categories(reference: DataFrame | Baseline, current: DataFrame | Batch) -> DataFrame:
    """Current category values never seen in the reference (anti-join on distinct values)."""
    base, batch = as_baseline(reference), as_batch(current)
    now = batch.categories.where("category is not null").join(F.broadcast(base.stats.select("column_name")), "column_name")
    return now.join(base.categories.select("column_name", "category"), ["column_name", "category"], "left_anti") \
        .select("column_name", "category")


ISSUE_ORDER = ("missing_rate_increase", "invalid_numeric_type", "values_outside_reference_range", "psi_drift",
               "ks_drift", "new_categories")


def drift_metrics(reference: DataFrame | Baseline, current: DataFrame | Batch) -> DataFrame:
    """Per monitored column present in ``current``: every comparison metric."""
    base, batch = as_baseline(reference), as_batch(current)
    return base.stats.select("column_name", "column_order", "kind", F.col("missing_rate").alias("baseline_missing_rate")) \
        .join(range_and_missing(base, batch), "column_name") \
        .join(psi(base, batch), "column_name", "left") \
        .join(ks_statistic(base, batch), "column_name", "left")


def drift_alerts(reference: DataFrame | Baseline, current: DataFrame | Batch,
                 thresholds: DriftThresholds = DriftThresholds()) -> DataFrame:
    """Ordered alerts (alert_order, severity, column_name, issue, value, detail): missing
    columns first (blocking), then per column in baseline order, one row per new category."""
    base, batch = as_baseline(reference), as_batch(current)
    metrics = drift_metrics(base, batch)
    numeric = F.col("kind") != "categorical"
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) != F.lit(math.inf))
    # in ISSUE_ORDER: severity, condition, value
    items = [
        ("warning", F.col("missing_rate") - F.col("baseline_missing_rate") > F.lit(thresholds.missing_increase_warning), "missing_rate"),
        ("blocking", numeric & (F.col("type_error_rate") > 0), "type_error_rate"),
        ("warning", numeric & (F.col("outside_reference_range_rate") > F.lit(thresholds.outside_range_warning)),
         "outside_reference_range_rate"),
        ("warning", numeric & finite("psi") & (F.col("psi") >= F.lit(thresholds.psi_warning)), "psi"),
        ("warning", numeric & finite("ks_statistic") & (F.col("ks_statistic") >= F.lit(thresholds.ks_warning)), "ks_statistic"),
    ]
    cells = [F.when(cond, F.struct(F.lit(i).alias("nth"), F.lit(severity).alias("severity"), F.lit(ISSUE_ORDER[i]).alias("issue"),
                                   F.col(value).cast("double").alias("value"))) for i, (severity, cond, value) in enumerate(items)]
    place = lambda nth: ((F.col("column_order") + 1) * 100 + nth).cast("int").alias("alert_order")
    no_detail = F.lit(None).cast("string").alias("detail")
    found = metrics.select("column_name", "column_order", F.explode(F.array_compact(F.array(*cells))).alias("a")).select(
        place(F.col("a.nth")), "a.severity", "column_name", "a.issue", "a.value", no_detail)
    fresh = new_categories(base, batch).join(F.broadcast(base.stats.select("column_name", "column_order")), "column_name").select(
        place(F.lit(ISSUE_ORDER.index("new_categories"))), F.lit("warning").alias("severity"), "column_name",
        F.lit("new_categories").alias("issue"), F.lit(None).cast("double").alias("value"), F.col("category").alias("detail"))
    gone = base.stats.where(~F.col("column_name").isin(batch.columns)).select(
        F.lit(0).alias("alert_order"), F.lit("blocking").alias("severity"), "column_name",
        F.lit("missing_column").alias("issue"), F.lit(None).cast("double").alias("value"), no_detail)
    return gone.unionByName(found).unionByName(fresh)


def drift_record(reference: DataFrame | Baseline, current: DataFrame | Batch, alerts: DataFrame | None = None,
                 thresholds: DriftThresholds = DriftThresholds()) -> DataFrame:
    """One row: reference and current rows, missing columns, alerts, blocking alerts, status."""
    base, batch = as_baseline(reference), as_batch(current)
    alerts = drift_alerts(base, batch, thresholds) if alerts is None else alerts
    found = alerts.agg(F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("severity") == "blocking").alias("blocking"),
                       F.array_join(F.sort_array(F.collect_list(F.when(F.col("issue") == "missing_column", F.col("column_name")))),
                                    ",").alias("missing_columns"))  # at most one per monitored column
    rows = lambda t: t.groupBy("column_name").agg(F.sum("n").alias("n")).agg(F.max("n").alias("n"))
    now = rows(batch.values.select("column_name", "n").unionByName(batch.categories.select("column_name", "n")))
    # three one-row tables side by side
    return base.stats.agg(F.max("rows").alias("reference_rows")).join(F.broadcast(now.withColumnRenamed("n", "current_rows"))) \
        .join(F.broadcast(found)).withColumn("status", F.when(F.col("blocking") > 0, "blocking").when(F.col("alerts") > 0, "alert")
                                             .otherwise("ok"))


def save_baseline(reference: DataFrame | Baseline, path: str) -> None:
    """Persist the baseline's tables as Parquet under ``path``; the index in order, so that a
    range is read by skipping row groups."""
    base = as_baseline(reference)
    for name in TABLES:
        table = getattr(base, name)
        if name == "index":
            table = table.repartitionByRange("column_name", "bucket").sortWithinPartitions("column_name", "bucket", "value")
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_baseline(spark: SparkSession, path: str) -> Baseline:
    return Baseline(*[spark.read.parquet(f"{path}/{name}") for name in TABLES])
