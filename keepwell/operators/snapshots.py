"""Point-in-time customer snapshots with future-only churn labels.

One plan serves every cutoff:

* each event id is collapsed once (``groupBy(event_id)``, a decomposable ``min``
  over a struct, so a huge group of copies is pre-aggregated map-side) into its
  first line (feature rule: dedup, then filter) and its first positive line
  (threshold rule: filter, then dedup; label rule: any positive line);
* every line is expanded to the cutoffs whose window holds it with
  ``explode(filter(<literal cutoff array>))`` – a projection, no join;
* features are two decomposable aggregates (per invoice, then per customer),
  regularity uses day-bucketed ``lag`` windows so one busy customer is spread
  over many tasks, and the label is one more aggregate; all four meet in
  joins on the same keys, which reuse one hash partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.config import SnapshotParams
from keepwell.functions.columns import (
    beside,
    days_between,
    epoch_micros,
    SEGMENT_OTHER,
    geographic_segment,
    is_positive_purchase,
    micros_between,
    MICROS_PER_DAY,
)
from keepwell.schemas import NUMERIC_FEATURES, require_columns
from keepwell.scratch import written
from keepwell.sources.publish import publish

KEYS = ["split", "cutoff_date", "customer_id"]
#: What the integrity rules read.
LINEAGE_COLUMNS = ["feature_max_event_date", "label_min_event_date", "label_window_start", "label_window_end"]
#: Line values are multiplied as doubles and summed as decimals of this type, so sums do not
#: depend on order; a value of 1e26 or more has no place in it and counts as unknown.
MONEY = "decimal(38,12)"

# ---- fixed values: eligibility criteria names, in evaluation order ----------------
CRITERIA = (
    "incomplete_observation_history",
    "incomplete_future_label_horizon",
    "recency_above_maximum",
    "insufficient_invoices",
)
ELIGIBLE = "eligible"
# ---------------------------------------------------------------------------------


class PointInTimeError(ValueError):
    """Temporal lineage or split isolation is violated."""


def ts_lit(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def transaction_bounds(tx: DataFrame) -> tuple[dt.datetime, dt.datetime]:
    """First and last timestamp over all lines (customers or not): one scalar job."""
    row = tx.agg(F.min("invoice_date").alias("lo"), F.max("invoice_date").alias("hi")).first()
    return row["lo"], row["hi"]


def cutoff_plan(params: SnapshotParams, bounds=None, strict: bool = True) -> list[dict]:
    """Per-cutoff window boundaries; raises for an incomplete label horizon."""
    out = []
    for split, cutoff in params.cutoffs():
        label_end = cutoff + dt.timedelta(days=params.horizon_days)
        item = {
            "split": split,
            "cutoff": cutoff,
            "feature_start": cutoff - dt.timedelta(days=params.history_days),
            "label_end": label_end,
            "recent_start": cutoff - dt.timedelta(days=params.recent_window_days),
            "historical_start": cutoff - dt.timedelta(days=2 * params.recent_window_days),
            "history_complete": True,
            "horizon_complete": True,
        }
        if bounds is not None:
            lo, hi = bounds
            item["history_complete"] = lo is not None and lo <= item["feature_start"]
            item["horizon_complete"] = hi is not None and label_end <= hi
            if strict and not item["horizon_complete"]:
                raise PointInTimeError(
                    f"Cutoff {cutoff.date()} has an incomplete {params.horizon_days}-day horizon; "
                    f"data ends {hi.date() if hi else None}")
        out.append(item)
    return out


def _cutoff_array(plan: list[dict]) -> Column:
    return F.array(*[F.struct(
        F.lit(c["split"]).alias("split"),
        ts_lit(c["cutoff"]).alias("cutoff"),
        ts_lit(c["feature_start"]).alias("feature_start"),
        ts_lit(c["label_end"]).alias("label_end"),
        ts_lit(c["recent_start"]).alias("recent_start"),
        ts_lit(c["historical_start"]).alias("historical_start"),
    ) for c in plan])


def _by_cutoff(plan: list[dict], field: str) -> Column:
    expr = None
    for c in plan:
        cond = F.col("cutoff_date") == ts_lit(c["cutoff"])
        expr = F.when(cond, F.lit(c[field])) if expr is None else expr.when(cond, F.lit(c[field]))
    return expr.otherwise(F.lit(None))


#: Equal for all lines of an event, as its id is a hash of them.
_EVENT_FIELDS = ["event_id", "invoice_no", "stock_code", "invoice_date", "customer_id"]
#: What tells copies apart, in order of the tie-break.
_LINE_FIELDS = ["quantity", "unit_price", "description", "country", "is_cancellation"]


def within(tx: DataFrame, after: dt.datetime | None, until: dt.datetime) -> DataFrame:
    """Lines in (``after``, ``until``]. All lines of an event have its timestamp, so this may
    come before deduplication, where it reaches the scan."""
    rows = tx.filter(F.col("invoice_date") <= ts_lit(until))
    return rows if after is None else rows.filter(F.col("invoice_date") > ts_lit(after))


def used_lines(tx: DataFrame, plan: list[dict]) -> DataFrame:
    """The lines that lie in any feature or label window of ``plan``."""
    return within(tx, min(c["feature_start"] for c in plan), max(c["label_end"] for c in plan))


def deduplicated_events(tx: DataFrame) -> DataFrame:
    """One row per event id (customers only): ``first`` = smallest line by
    (quantity, unit_price, description, country), ``first_positive`` = smallest
    positive line or null.

    Ids are counted by a 64-bit hash first, which moves two numbers a line at most. A line
    whose hash occurs once is its event's only one and stays where it is; only lines of
    repeated hashes are moved and compared, exactly by their id. Counts and minima are
    decomposable, so copies pre-aggregate map-side."""
    lines = tx.filter(F.col("customer_id").isNotNull()).select(*_EVENT_FIELDS, *_LINE_FIELDS)
    key = F.xxhash64("event_id")
    # written, so that its size is known when the joins are planned: few repeats are broadcast
    repeated = written(lines.groupBy(key.alias("_event")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_event"), "repeated_events")
    line = F.struct(*_LINE_FIELDS)
    positive = F.when(is_positive_purchase(), line)
    keyed = lines.withColumn("_event", key)
    alone = keyed.join(repeated, "_event", "left_anti").select(*_EVENT_FIELDS, line.alias("first"), positive.alias("first_positive"))
    met = (keyed.join(repeated, "_event", "left_semi").groupBy(*_EVENT_FIELDS)
           .agg(F.min(line).alias("first"), F.min(positive).alias("first_positive")))
    return alone.unionByName(met)


def feature_lines(events: DataFrame) -> DataFrame:
    """Deduplicated lines (feature rule: dedup first, filter positives later)."""
    return events.select(*_EVENT_FIELDS, "first.*")


def positive_events(events: DataFrame) -> DataFrame:
    """Events with at least one positive line, carried by their first positive line."""
    return events.filter(F.col("first_positive").isNotNull()).select(*_EVENT_FIELDS, "first_positive.*")


#: Time is cut into panes at every edge of a window of any cutoff; in a pane all windows agree.
_FEATURE_EDGES = ("feature_start", "historical_start", "recent_start", "cutoff")


def _edges(plan: list[dict], names) -> list[dt.datetime]:
    return sorted({c[name] for c in plan for name in names})


def _pane(plan: list[dict], names) -> Column:
    """The pane of ``invoice_date``: how many edges lie before it. Edge i (from 1) is before
    the lines of panes i and up."""
    pane = F.lit(0)
    for edge in _edges(plan, names):
        pane = pane + (F.col("invoice_date") > ts_lit(edge)).cast("int")
    return pane


def _explode_panes(partials: DataFrame, plan: list[dict], names, first: str, last: str) -> DataFrame:
    """``partials`` (with ``pane``) once per cutoff whose window (``first``, ``last``] holds the
    pane, with ``split``, ``cutoff_date`` and the pane numbers ``_c`` of the cutoff's edges."""
    edges = _edges(plan, names)
    cells = F.array(*[F.struct(F.lit(c["split"]).alias("split"), ts_lit(c["cutoff"]).alias("cutoff"),
                               *[F.lit(edges.index(c[name]) + 1).alias(name) for name in dict.fromkeys(["cutoff", *names]) if name != "cutoff"],
                               F.lit(edges.index(c["cutoff"]) + 1).alias("at")) for c in plan])
    edge = lambda c, name: c["at"] if name == "cutoff" else c[name]
    held = lambda c: (F.col("pane") >= edge(c, first)) & (F.col("pane") < edge(c, last))
    return (partials.withColumn("_c", F.explode(F.filter(cells, held)))
            .withColumn("split", F.col("_c.split")).withColumn("cutoff_date", F.col("_c.cutoff")))


def _gap_rows(dates: DataFrame, keys, order_cols, bucket_days: float | None) -> DataFrame:
    """Gaps (days) between consecutive dates per ``keys`` without ordering a whole
    key in one task: dates are cut into fixed time buckets, ``lag`` runs inside a
    bucket, and the gap across neighbouring buckets comes from bucket min/max.
    With None, where no key is large and rows lie by key already, ``lag`` runs over keys."""
    if bucket_days is None:
        gap = micros_between(F.lag("d").over(Window.partitionBy(*keys).orderBy(*order_cols)), F.col("d"))
        return dates.select(*keys, gap.alias("_gap")).where("_gap is not null").select(
            *keys, (F.col("_gap") / F.lit(MICROS_PER_DAY)).alias("gap_days"))
    bucket_us = int(bucket_days * MICROS_PER_DAY)
    d = dates.withColumn("_b", F.floor(epoch_micros(F.col("d")) / F.lit(bucket_us)))
    d = d.repartition(*keys, "_b")
    w = Window.partitionBy(*keys, "_b").orderBy(*order_cols)
    within = d.select(*keys, "_b", "d", micros_between(F.lag("d").over(w), F.col("d")).alias("_gap"))
    inner = within.filter(F.col("_gap").isNotNull()).select(
        *keys, (F.col("_gap") / F.lit(MICROS_PER_DAY)).alias("gap_days"))
    bounds = within.groupBy(*keys, "_b").agg(F.min("d").alias("_lo"), F.max("d").alias("_hi"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    cross = bounds.select(*keys, micros_between(F.lag("_hi").over(wb), F.col("_lo")).alias("_gap")) \
        .filter(F.col("_gap").isNotNull()) \
        .select(*keys, (F.col("_gap") / F.lit(MICROS_PER_DAY)).alias("gap_days"))
    return inner.unionByName(cross)


def segment_expr(country: Column, segment_map: dict | None) -> Column:
    """Country → segment: the retail rule by default, or an explicit (small) map
    such as nation → region; unmapped countries are 'Rest of world'."""
    if not segment_map:
        return geographic_segment(country)
    kv = []
    for k, v in sorted(segment_map.items()):
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), country), F.lit(SEGMENT_OTHER))


def customer_features(tx: DataFrame, params: SnapshotParams, plan: list[dict] | None = None,
                      events: DataFrame | None = None, bucket_days: float | None = 1.0,
                      segment_map: dict | None = None) -> DataFrame:
    """Per (split, cutoff, customer) feature aggregates over ``(cutoff-history, cutoff]``."""
    plan = plan or cutoff_plan(params)
    events = events if events is not None else deduplicated_events(used_lines(tx, plan))
    pos = is_positive_purchase()
    value = (F.col("quantity") * F.col("unit_price")).try_cast(MONEY)
    t = F.col("invoice_date")
    lines = feature_lines(events).withColumn("pane", _pane(plan, _FEATURE_EDGES))
    # a line is added up once, whatever the number of cutoffs; a window is a sum of panes. By country
    # too, so that every buffer has a fixed width and lines are hashed, not sorted
    panes = lines.groupBy("customer_id", "invoice_no", "country", "pane").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("is_cancellation")).alias("n_cancel"),
        F.max("invoice_date").alias("latest"),
        F.count_if(pos).alias("n_pos"),
        F.try_sum(F.when(pos, value)).alias("value"),
        F.sum(F.when(pos, F.col("quantity"))).alias("qty"),
        F.min(F.when(pos, t)).alias("first_t"),
        F.max(F.when(pos, t)).alias("last_t"))
    # cutoffs multiply rows, so rows are dealt before, by what every later key of them holds: the
    # aggregates below need no further exchange. Where rows lie by customer already, they stay
    dealt = (lambda df, *keys: df) if bucket_days is None else (lambda df, *keys: df.repartition(*keys))
    feat = _explode_panes(dealt(panes, "customer_id", "invoice_no"), plan, _FEATURE_EDGES, "feature_start", "cutoff")
    recent = F.col("pane") >= F.col("_c.recent_start")
    hist = (F.col("pane") >= F.col("_c.historical_start")) & ~recent
    has_pos = F.col("n_pos") > 0
    inv = feat.groupBy(*KEYS, "invoice_no").agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum("n_cancel").alias("n_cancel"),
        F.max(F.struct("latest", "country")).alias("latest"),
        F.sum("n_pos").alias("n_pos"),
        F.try_sum("value").alias("value"),
        F.sum("qty").alias("qty"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.try_sum(F.when(recent, F.col("value"))).alias("recent_value"),
        F.max(has_pos & recent).alias("in_recent"),
        F.try_sum(F.when(hist, F.col("value"))).alias("hist_value"),
        F.max(has_pos & hist).alias("in_hist"),
    )
    if bucket_days is not None:
        inv = written(inv, "invoices")  # read by customer totals and by gaps
    cust = inv.groupBy(*KEYS).agg(
        F.try_sum("value").alias("_monetary"),
        F.sum("qty").alias("quantity_purchased"),
        F.count_if(F.col("n_pos") > 0).alias("number_of_invoices"),
        F.min("first_t").alias("first_purchase_date"),
        F.max("last_t").alias("last_purchase_date"),
        F.sum("n_pos").alias("feature_event_count"),
        (F.sum("n_cancel") / F.sum("n_lines")).alias("cancellation_rate"),
        F.max("latest").getField("country").alias("_country"),
        F.try_sum("recent_value").alias("_recent"),
        F.count_if("in_recent").alias("recent_invoice_count"),
        F.try_sum("hist_value").alias("_hist"),
        F.count_if("in_hist").alias("historical_invoice_count"),
    ).filter(F.col("number_of_invoices") > 0)

    bought = lines.filter(pos).select("customer_id", "stock_code", "pane").distinct()
    products = (_explode_panes(dealt(bought, "customer_id", "stock_code"), plan, _FEATURE_EDGES, "feature_start", "cutoff").select(*KEYS, "stock_code").distinct()
                .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("number_of_unique_products")))

    dates = inv.filter(F.col("n_pos") > 0).select(*KEYS, F.col("first_t").alias("d")).distinct()
    gaps = _gap_rows(dates, KEYS, ["d"], bucket_days)
    regularity = gaps.groupBy(*KEYS).agg(
        F.when(F.count(F.lit(1)) >= 2, F.stddev_pop("gap_days")).alias("purchase_regularity_days"))

    out = cust.join(products, KEYS, "left").join(regularity, KEYS, "left")
    cutoff = F.col("cutoff_date")
    recency = days_between(F.col("last_purchase_date"), cutoff)
    tenure = days_between(F.col("first_purchase_date"), cutoff)
    recent_spend = F.coalesce(F.col("_recent").cast("double"), F.lit(0.0))
    hist_spend = F.coalesce(F.col("_hist").cast("double"), F.lit(0.0))
    monetary = F.col("_monetary").cast("double")
    return out.select(
        *KEYS,
        recency.alias("recency_days"),
        (F.col("number_of_invoices") / F.greatest(tenure / F.lit(30.0), F.lit(1.0))).alias("purchase_frequency"),
        monetary.alias("monetary_value"),
        (monetary / F.col("number_of_invoices")).alias("average_order_value"),
        tenure.alias("customer_tenure_days"),
        "number_of_invoices",
        F.coalesce("number_of_unique_products", F.lit(0)).cast("long").alias("number_of_unique_products"),
        "purchase_regularity_days",
        ((recent_spend - hist_spend) / (F.abs(hist_spend) + F.lit(1.0))).alias("recent_purchasing_trend"),
        F.col("cancellation_rate").cast("double").alias("cancellation_rate"),
        F.col("quantity_purchased").cast("double").alias("quantity_purchased"),
        recent_spend.alias("recent_spend"),
        hist_spend.alias("historical_spend"),
        ((recent_spend + F.lit(1.0)) / (hist_spend + F.lit(1.0))).alias("spend_change_ratio"),
        "recent_invoice_count",
        "historical_invoice_count",
        ((F.col("recent_invoice_count") + F.lit(1.0)) / (F.col("historical_invoice_count") + F.lit(1.0)))
        .alias("frequency_change_ratio"),
        segment_expr(F.col("_country"), segment_map).alias("geographic_segment"),
        "first_purchase_date",
        "last_purchase_date",
        F.col("last_purchase_date").alias("feature_max_event_date"),
        "feature_event_count",
    )


def future_labels(tx: DataFrame, params: SnapshotParams, plan: list[dict] | None = None,
                  events: DataFrame | None = None) -> DataFrame:
    """Label lineage per (split, cutoff, customer) over ``(cutoff, cutoff+horizon]``:
    positive purchases, not deduplicated (distinct events only)."""
    plan = plan or cutoff_plan(params)
    if events is None:
        events = deduplicated_events(within(tx, min(c["cutoff"] for c in plan), max(c["label_end"] for c in plan)))
    names = ("cutoff", "label_end")
    panes = positive_events(events).withColumn("pane", _pane(plan, names)).groupBy("customer_id", "pane").agg(
        F.min("invoice_date").alias("first_t"), F.max("invoice_date").alias("last_t"), F.count(F.lit(1)).alias("n"))
    return _explode_panes(panes, plan, names, "cutoff", "label_end").groupBy(*KEYS).agg(
        F.min("first_t").alias("label_min_event_date"),
        F.max("last_t").alias("label_max_event_date"),
        F.sum("n").alias("label_event_count"),
    )


def eligibility_columns(df: DataFrame, params: SnapshotParams, plan: list[dict]) -> DataFrame:
    """Four criteria in fixed order, ``is_eligible``, ``;``-joined reasons and the
    first failing criterion as the primary reason."""
    flags = {
        "incomplete_observation_history": ~_by_cutoff(plan, "history_complete"),
        "incomplete_future_label_horizon": ~_by_cutoff(plan, "horizon_complete"),
        "recency_above_maximum": F.coalesce(F.col("recency_days") > F.lit(params.max_recency_days), F.lit(False)),
        "insufficient_invoices": F.coalesce(F.col("number_of_invoices") < F.lit(params.minimum_invoices),
                                            F.lit(False)),
    }
    df = df.withColumns({f"fails_{k}": v for k, v in flags.items()})
    any_fail = None
    for k in CRITERIA:
        any_fail = F.col(f"fails_{k}") if any_fail is None else any_fail | F.col(f"fails_{k}")
    reasons = F.concat_ws(";", *[F.when(F.col(f"fails_{k}"), F.lit(k)) for k in CRITERIA])
    primary = None
    for k in CRITERIA:
        primary = F.when(F.col(f"fails_{k}"), F.lit(k)) if primary is None else \
            primary.when(F.col(f"fails_{k}"), F.lit(k))
    return df.withColumns({
        "observation_history_complete": _by_cutoff(plan, "history_complete"),
        "is_eligible": ~any_fail,
        "eligibility_reason": F.when(any_fail, reasons).otherwise(F.lit(ELIGIBLE)),
        "primary_exclusion_reason": primary.otherwise(F.lit(ELIGIBLE)),
    })


SNAPSHOT_TAIL = [
    "geographic_segment", "first_purchase_date", "last_purchase_date", "feature_max_event_date",
    "feature_event_count", "label_min_event_date", "label_max_event_date", "label_event_count", "churn",
    "feature_window_start", "label_window_start", "label_window_end", "observation_history_complete",
    "is_eligible", "eligibility_reason", "primary_exclusion_reason",
]
SNAPSHOT_COLUMNS = KEYS + NUMERIC_FEATURES + SNAPSHOT_TAIL


def snapshot_candidates(tx: DataFrame | None, params: SnapshotParams, bounds=None, bucket_days: float | None = 1.0,
                        strict: bool = True, segment_map: dict | None = None, only=None,
                        events: DataFrame | None = None) -> DataFrame:
    """All (split, cutoff, customer) candidates with features, label, lineage and
    eligibility columns. ``bounds`` defaults to one scalar job over ``tx``; ``only`` names the
    cutoffs wanted, if not all. With ``events``, deduplicated before, and ``bounds``, ``tx`` is not read."""
    params.validate()
    bounds = bounds if bounds is not None else transaction_bounds(tx)
    plan = [c for c in cutoff_plan(params, bounds, strict=strict) if only is None or c["cutoff"] in only]
    events = used_lines(events, plan) if events is not None else deduplicated_events(used_lines(tx, plan))
    feats = customer_features(tx, params, plan, events, bucket_days, segment_map)
    labels = future_labels(tx, params, plan, events)
    snap = feats.join(labels, KEYS, "left")
    cutoff = F.col("cutoff_date")
    snap = snap.withColumns({
        "churn": F.when(F.col("label_event_count").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("int"),
        "label_event_count": F.coalesce("label_event_count", F.lit(0)).cast("long"),
        "feature_window_start": F.timestamp_add("DAY", F.lit(-params.history_days), cutoff),
        "label_window_start": F.timestamp_add("MICROSECOND", F.lit(1), cutoff),
        "label_window_end": F.timestamp_add("DAY", F.lit(params.horizon_days), cutoff),
    })
    snap = eligibility_columns(snap, params, plan)
    return snap.select(*SNAPSHOT_COLUMNS)


def changed_cutoffs(added: DataFrame, params: SnapshotParams, before, after) -> list[tuple[str, dt.datetime]]:
    """(split, cutoff) whose candidates may differ once the lines ``added`` are there: a window
    holds one of them, or the bounds of all lines (``before``, ``after``) change what is complete.
    One pass over the new lines, one row back."""
    was, now = cutoff_plan(params, before, strict=False), cutoff_plan(params, after, strict=False)
    t = F.col("invoice_date")
    hits = added.agg(*[F.count_if((t > ts_lit(c["feature_start"])) & (t <= ts_lit(c["label_end"]))) for c in now]).first()
    flags = ("history_complete", "horizon_complete")
    return [(b["split"], b["cutoff"]) for a, b, n in zip(was, now, hits, strict=True) if n or any(a[f] != b[f] for f in flags)]


SNAPSHOT_PARTITIONS = ["split", "cutoff_day"]


def refresh_candidates(tx: DataFrame, added: DataFrame, params: SnapshotParams, path: str, before=None, strict: bool = True,
                       segment_map: dict | None = None) -> list[tuple[str, str]]:
    """Bring the published candidates at ``path`` up to date with ``tx``, which holds the lines
    ``added`` already. Only cutoffs that they concern are built again and replaced, in one
    step for readers. ``before``: first and last timestamp without the new lines; None for a
    first build of all. Returns the (split, day) replaced."""
    after = transaction_bounds(tx)
    todo = params.cutoffs() if before is None else changed_cutoffs(added, params, before, after)
    if not todo:
        return []
    rows = snapshot_candidates(tx, params, after, strict=strict, segment_map=segment_map, only={c for _, c in todo})
    rows = rows.withColumn("cutoff_day", F.date_format("cutoff_date", "yyyy-MM-dd"))
    days = [(split, cutoff.date().isoformat()) for split, cutoff in todo]
    publish(rows, path, SNAPSHOT_PARTITIONS, None if before is None else days)
    return days


def eligibility_summary(candidates: DataFrame) -> DataFrame:
    """Per (split, cutoff): totals, prevalence, criterion failures, primary reasons."""
    agg = [
        F.count(F.lit(1)).alias("total_customers_before_eligibility"),
        F.count_if("is_eligible").alias("eligible_customers"),
        F.count_if(~F.col("is_eligible")).alias("excluded_customers"),
        F.count_if(F.col("is_eligible") & (F.col("churn") == 1)).alias("eligible_churners"),
    ]
    agg += [F.count_if(F.col("eligibility_reason").contains(k)).alias(f"fails_{k}") for k in CRITERIA]
    agg += [F.count_if(F.col("primary_exclusion_reason") == F.lit(k)).alias(f"primary_{k}") for k in CRITERIA]
    return candidates.groupBy("split", "cutoff_date").agg(*agg).withColumn(
        "eligible_churn_prevalence",
        F.try_divide(F.col("eligible_churners").cast("double"), F.col("eligible_customers").cast("double")))


def eligibility_rollup(summary: DataFrame) -> DataFrame:
    """Sum of the per-cutoff summaries (the study-level population report)."""
    counts = [c for c in summary.columns if c not in ("split", "cutoff_date", "eligible_churn_prevalence")]
    return summary.agg(
        F.count(F.lit(1)).alias("cutoffs"), *[F.sum(c).cast("long").alias(c) for c in counts]
    ).withColumn("eligible_churn_prevalence",
                 F.try_divide(F.col("eligible_churners").cast("double"), F.col("eligible_customers").cast("double")))


def split_bounds(snapshots: DataFrame) -> DataFrame:
    """First cutoff and last label end per split."""
    return snapshots.groupBy("split").agg(
        F.min("cutoff_date").alias("first_cutoff"), F.max("label_window_end").alias("last_label_end"))


def leakage_violations(snapshots: DataFrame, tx: DataFrame, params: SnapshotParams) -> DataFrame:
    """Integrity rules as violation counts (all must be 0): feature after cutoff,
    label at/before cutoff, label before window, feature/label event overlap per
    cutoff (over all lines), and split order over every ordered pair of splits."""
    require_columns(snapshots, [*KEYS, *LINEAGE_COLUMNS], "snapshot")
    plan = cutoff_plan(params)
    rules = snapshots.agg(
        F.count_if(F.col("feature_max_event_date") > F.col("cutoff_date")).alias("feature_after_cutoff"),
        F.count_if(F.col("label_min_event_date") <= F.col("cutoff_date")).alias("label_at_or_before_cutoff"),
        F.count_if(F.col("label_min_event_date") < F.col("label_window_start")).alias("label_before_window"),
    )
    # an event overlaps when it has a line on both sides of a cutoff; flags per
    # (cutoff, event) are a decomposable max, so a huge copy group stays cheap
    lines = used_lines(tx, plan).select("event_id", "invoice_date")
    t = F.col("invoice_date")
    sides = lines.withColumn("_c", F.explode(F.filter(
        _cutoff_array(plan), lambda c: (t > c["feature_start"]) & (t <= c["label_end"]))))
    flags = sides.groupBy(F.col("_c.cutoff").alias("cutoff_date"), "event_id").agg(
        F.max(t <= F.col("_c.cutoff")).alias("_f"), F.max(t > F.col("_c.cutoff")).alias("_l"))
    overlap = flags.agg(F.count_if(F.col("_f") & F.col("_l")).alias("overlapping_events"))
    sb = split_bounds(snapshots)
    order = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1).otherwise(2)
    a = sb.select(order.alias("_ea"), F.col("last_label_end").alias("_end"))
    b = sb.select(order.alias("_lb"), F.col("first_cutoff").alias("_start"))
    # ≤ 3 rows per side: pairs of splits, an inequality join on a bounded table
    pairs = a.join(F.broadcast(b), F.col("_ea") < F.col("_lb")) \
        .agg(F.count_if(F.col("_end") >= F.col("_start")).alias("split_order_violations"))
    return beside(rules, overlap, pairs)


def assert_point_in_time(snapshots: DataFrame, tx: DataFrame, params: SnapshotParams) -> None:
    row = leakage_violations(snapshots, tx, params).first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise PointInTimeError(f"Point-in-time integrity violated: {bad}")


def assert_eligibility(snapshots: DataFrame, params: SnapshotParams) -> None:
    require_columns(snapshots, [*KEYS, "is_eligible", "recency_days", "number_of_invoices", *LINEAGE_COLUMNS], "snapshot")
    row = snapshots.agg(
        F.count_if(~F.col("is_eligible")).alias("rows that are not eligible"),
        F.count_if(F.col("recency_days") > params.max_recency_days).alias("rows above the recency ceiling"),
        F.count_if(F.col("number_of_invoices") < params.minimum_invoices).alias("rows with too few invoices"),
    ).first().asDict()
    found = ", ".join(f"{n} {what}" for what, n in row.items() if n)
    if found:
        raise ValueError(f"the snapshot holds {found}")


def build_snapshots(tx: DataFrame, params: SnapshotParams, check: bool = True,
                    bucket_days: float = 1.0, segment_map: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Eligible snapshots of every cutoff plus the per-cutoff eligibility summary.

    Candidates are written once; with ``check`` the gates run over the written table: a
    cutoff without candidates or without eligible customers raises, and so does any
    integrity violation.
    """
    candidates = written(snapshot_candidates(tx, params, bucket_days=bucket_days, segment_map=segment_map), "candidates")
    summary = written(eligibility_summary(candidates), "eligibility")
    snapshots = candidates.filter(F.col("is_eligible"))
    if check:
        seen = {(r["split"], r["cutoff_date"]): r for r in summary.collect()}  # ≤ one row per cutoff
        for split, cutoff in params.cutoffs():
            r = seen.get((split, cutoff))
            if r is None or r["total_customers_before_eligibility"] == 0:
                raise PointInTimeError(f"No eligible customers at cutoff {cutoff.date()}")
            if r["eligible_customers"] == 0:
                raise PointInTimeError(f"No eligible active repeat customers at cutoff {cutoff.date()}")
        assert_point_in_time(snapshots, tx, params)
        assert_eligibility(snapshots, params)
    return snapshots, summary
