"""Structured Streaming re-aims of the online surface.

* X2 ``transaction_stream``: raw lines → normalized lines, deduplicated by event
  id. Unlike the batch rule (smallest line per event), a stream keeps the first copy
  to *arrive*. Copies are matched by Spark's own state within an event-time watermark;
  lines that come later than that are dropped by Spark. ``account`` finds repeats and late
  lines afterwards from input and output, so no line goes unnoticed.
* X1 ``scoring_stream``: stateless per-row scoring with the fitted bundle, warnings and
  single-row economics for rows that meet the feature contract; the others go to
  ``quarantine_stream``.
* X3 ``drift_per_batch``: ``foreachBatch`` compares every micro-batch with a saved
  baseline and writes the alerts of a batch to the batch's own folder.
Sinks and checkpoints live under the shared checkpoint folder at names that do not
change, so a restarted query resumes from its offsets; a batch that runs again
overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.config import EconomicScenario, SnapshotParams
from keepwell.operators import drift, portfolio
from keepwell.operators.normalize import normalize_transactions
from keepwell.scratch import scope
from keepwell.session import ensure_checkpoint_dir
from keepwell.sources.tables import events_to_transactions

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def stream_root(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/keepwell_streams/{name}"


def timed_lines(raw_events: DataFrame) -> DataFrame:
    """Normalized lines with ``_event_time``: watermarks need an instant, so the wall-clock
    time is read as UTC."""
    lines = normalize_transactions(events_to_transactions(raw_events))
    return lines.withColumn("_event_time", F.to_utc_timestamp(F.col("invoice_date").cast("timestamp"), "UTC"))


def transaction_stream(raw_events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Normalize an event stream into transaction lines and drop repeated event ids that
    arrive within the watermark (later lines are dropped by Spark; see ``run_transactions``)."""
    return (timed_lines(raw_events).withWatermark("_event_time", watermark)
            .dropDuplicatesWithinWatermark(["event_id"]).drop("_event_time"))


def run_transactions(raw_events: DataFrame, sink: str, checkpoint: str, watermark: str = "1 day"):
    """Process what is available of a stream of events: first copies go to ``sink``/lines.
    Watermark, state and its expiry are Spark's; a restart resumes from ``checkpoint``."""
    return run_available(transaction_stream(raw_events, watermark), f"{sink}/lines", checkpoint)


def account(raw_events: DataFrame, sink: str) -> tuple[DataFrame, DataFrame]:
    """What became of the other lines, from the events that the stream has read (as a table)
    and the lines it kept: (repeats, late).

    ``repeats`` (event_id, repeats) counts the further copies of kept events, whenever they
    came; ``late`` has the lines of events of which no copy was kept, as all of them came
    behind the watermark. Lines kept, repeats and late lines add up to the input. Only
    event ids and counts meet in the join of repeats; late lines are an anti-join."""
    lines = normalize_transactions(events_to_transactions(raw_events))
    kept = _counted_ids(lines.sparkSession.read.parquet(f"{sink}/lines"), "kept")
    repeats = (_counted_ids(lines, "copies").join(kept, "event_id")
               .select("event_id", (F.col("copies") - F.col("kept")).alias("repeats")).where("repeats > 0"))
    return repeats, lines.join(kept.select("event_id"), "event_id", "left_anti").select(*lines.columns)


def _counted_ids(lines: DataFrame, name: str) -> DataFrame:
    return lines.groupBy("event_id").agg(F.count(F.lit(1)).alias(name))


def scoring_stream(features: DataFrame, bundle, scenario: EconomicScenario, params: SnapshotParams,
                   known_segments) -> DataFrame:
    """Per-row scoring with warnings and economics (no state) of rows that meet the contract."""
    from keepwell.operators.model import score

    valid, _ = portfolio.split_by_contract(features)
    return _score_columns(score(bundle, portfolio.row_warnings(valid, known_segments)), scenario, params)


def quarantine_stream(features: DataFrame) -> DataFrame:
    """Rows that break the feature contract, with their violations."""
    return portfolio.split_by_contract(features)[1]


def _score_columns(scored: DataFrame, scenario: EconomicScenario, params: SnapshotParams) -> DataFrame:
    from keepwell.operators import decisioning as dec

    ec = dec.with_economics(scored, scenario, params.history_days) \
        .withColumn("_ops", portfolio.operational_reasons(scored, params))
    ok = F.size("_ops") == 0
    reason = (F.when(~ok, F.concat(F.lit(portfolio.REASON_OPERATIONAL), F.array_join("_ops", ", ")))
              .when(F.coalesce(F.col("expected_net_value") <= 0, F.lit(False)),
                    F.lit(portfolio.REASON_SINGLE_NONPOSITIVE))
              .otherwise(F.lit(portfolio.REASON_SINGLE_POSITIVE)))
    return ec.select("customer_id", "churn_probability", "model_version", "warnings",
                     F.col("estimated_margin_at_risk").alias("margin_at_risk"), "expected_net_value",
                     (ok & F.col("economic_eligibility")).alias("economic_eligibility"), reason.alias("reason"))


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append"):
    """Process everything available now into a Parquet sink, then stop."""
    q = (stream.writeStream.format("parquet").outputMode(mode).option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def drift_per_batch(stream: DataFrame, baseline: drift.Baseline, sink: str, checkpoint: str):
    """Alerts of every micro-batch against the baseline, in a folder per batch id. A batch leaves
    no other tables, so a stream may run on for as long as it likes."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        with scope(batch.sparkSession):
            drift.drift_alerts(baseline, batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
