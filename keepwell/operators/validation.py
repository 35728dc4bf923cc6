"""Transaction quality summary and blocking rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.config import ValidationRules
from keepwell.functions.columns import beside
from keepwell.schemas import VALIDATION_REQUIRED, SchemaError, require_columns


class DataValidationError(ValueError):
    """A dataset violates a blocking quality rule."""


def iso_text(col) -> F.Column:
    """ISO-8601 text as Python's isoformat: fraction only when non-zero."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(col.isNull(), F.lit(None)).when(
        F.date_format(col, "SSSSSS") == F.lit("000000"), whole).otherwise(frac)


def usable_customer():
    return F.col("customer_id").isNotNull() & (F.col("customer_id") != F.lit(""))


def counters() -> list[F.Column]:
    """What one pass over the lines tells: everything of the summary but distinct counts."""
    usable = usable_customer()
    return [
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(usable).alias("rows"),
        F.min(F.when(usable, F.col("invoice_date"))).alias("_min_date"),
        F.max(F.when(usable, F.col("invoice_date"))).alias("_max_date"),
        F.count_if(~usable).alias("_missing_customers"),
        F.count_if(usable & F.col("is_cancellation")).alias("_cancelled"),
        F.count_if(F.coalesce(F.col("unit_price") < 0, F.lit(False))).alias("_negative_price"),
        F.count_if(F.col("invoice_date").isNull()).alias("_null_dates"),
        F.count_if(F.col("unit_price").isNull() | F.col("quantity").isNull()).alias("_null_numbers"),
    ]


COUNTER_SCHEMA = ("all_rows long, rows long, _min_date timestamp_ntz, _max_date timestamp_ntz, _missing_customers long, "
                  "_cancelled long, _negative_price long, _null_dates long, _null_numbers long")


def write_counted(tx: DataFrame, path: str) -> dict:
    """Write the lines and return the ``counters`` of what was written, taken by the tasks that
    write, so the lines are read once. A task that runs again counts once."""
    seen = Observation("lines")
    tx.observe(seen, *counters()).write.mode("overwrite").parquet(path)
    return seen.get


def validation_summary(tx: DataFrame, counted: dict | None = None) -> DataFrame:
    """Plain counters (of one aggregate pass, or as ``write_counted`` gave them) plus two
    pre-grouped distinct counts (customers, event ids) – separate group-bys instead of two distinct
    aggregates in one pass, which would expand every line three-fold. Rates over
    usable rows skip null and empty customers."""
    usable = usable_customer()
    if counted is None:
        plain = tx.agg(*counters())
    else:
        names = [c.split()[0] for c in COUNTER_SCHEMA.split(", ")]
        plain = tx.sparkSession.createDataFrame([tuple(counted[c] for c in names)], COUNTER_SCHEMA)
    kept = tx.filter(usable)
    customers = kept.select("customer_id").distinct().agg(F.count(F.lit(1)).alias("customers"))
    events = kept.select("event_id").distinct().agg(F.count(F.lit(1)).alias("_distinct_events"))

    row = beside(plain, customers, events)
    return row.select(
        "all_rows", "rows", "customers",
        iso_text(F.col("_min_date")).alias("minimum_date"),
        iso_text(F.col("_max_date")).alias("maximum_date"),
        F.try_divide(F.col("_missing_customers"), F.col("all_rows")).alias("missing_customer_rate"),
        F.try_divide(F.col("rows") - F.col("_distinct_events"), F.col("rows")).alias("duplicate_event_rate"),
        F.try_divide(F.col("_cancelled"), F.col("rows")).alias("cancellation_rate"),
        F.try_divide(F.col("_negative_price"), F.col("all_rows")).alias("negative_price_rate"),
        "_null_dates", "_null_numbers",
    )


SUMMARY_COLUMNS = [
    "rows", "customers", "minimum_date", "maximum_date", "missing_customer_rate",
    "duplicate_event_rate", "cancellation_rate", "negative_price_rate",
]


def validate_transactions(tx: DataFrame, rules: ValidationRules = ValidationRules(), counted: dict | None = None) -> dict:
    """Apply the blocking rules in a fixed order; return the summary as a dict. ``counted``: the
    counters of ``write_counted``, so that only distinct counts need another pass."""
    try:
        require_columns(tx, VALIDATION_REQUIRED, "required")
    except SchemaError as exc:
        raise DataValidationError(str(exc)) from exc
    if not isinstance(tx.schema["invoice_date"].dataType, (T.TimestampNTZType, T.TimestampType)):
        raise DataValidationError("invoice_date must be a timestamp column")
    row = validation_summary(tx, counted).first().asDict()
    # in this order: the first that holds is reported
    blocking = (
        (not row["all_rows"], "there are no transaction lines"),
        (row["_null_dates"], f"{row['_null_dates']} lines have no readable invoice_date"),
        (row["_null_numbers"], f"{row['_null_numbers']} lines have no numeric quantity or unit_price"),
        ((row["negative_price_rate"] or 0) > rules.negative_price_rate_max,
         f"negative unit_price on {row['negative_price_rate']} of all lines, {rules.negative_price_rate_max} are allowed"),
        (not row["rows"], "no line names a customer"),
        ((row["duplicate_event_rate"] or 0) > rules.duplicate_rate_max,
         f"duplicate events are {row['duplicate_event_rate']} of the lines, {rules.duplicate_rate_max} are allowed"),
    )
    for holds, message in blocking:
        if holds:
            raise DataValidationError(message)
    return {k: row[k] for k in SUMMARY_COLUMNS}


def transaction_eda(tx: DataFrame) -> DataFrame:
    """Rows, customers, first and last timestamp, cancellation rate (all lines)."""
    return tx.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.min("invoice_date").alias("start"),
        F.max("invoice_date").alias("end"),
        F.avg(F.col("is_cancellation").cast("double")).alias("cancellation_rate"),
    )
