"""Normalize raw transaction lines into the canonical typed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.functions.columns import cancellation_flag, event_id_expr
from keepwell.schemas import CANONICAL_COLUMNS, SOURCE_COLUMN_MAP, require_columns


# fixed values: text layouts tried after ISO-8601, month first like the source export
FALLBACK_TIMESTAMP_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy", "yyyy/M/d H:mm:ss", "yyyy/M/d")
#: A date has a four-digit year and two more parts; bare numbers are no dates.
DATE_TEXT = r"^(\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}/\d{1,2}/\d{4})([ T].*)?$"
#: Digits with an optional sign, point and exponent; type suffixes and words are no numbers.
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _lenient_timestamp(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    # text (or anything else): unparseable → null, never an error
    text = F.trim(c.cast("string"))
    parsed = [F.try_to_timestamp(text)] + [F.try_to_timestamp(text, F.lit(f)) for f in FALLBACK_TIMESTAMP_FORMATS]
    return F.when(text.rlike(DATE_TEXT), F.coalesce(*parsed)).cast("timestamp_ntz")


def _lenient_double(df: DataFrame, name: str):
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.NumericType):
        parsed = c.cast("double")
    else:
        text = F.trim(c.cast("string"))
        parsed = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    return F.when(F.isnan(parsed), F.lit(None).cast("double")).otherwise(parsed)


def normalize_transactions(frame: DataFrame) -> DataFrame:
    """Rename source columns, project the canonical set, parse leniently and derive
    ``is_cancellation``, ``line_value`` and ``event_id``.

    No sort: order is expressed where it matters (dedup tie-break, ranks).
    """
    renames = {src: dst for src, dst in SOURCE_COLUMN_MAP.items() if src in frame.columns}
    df = frame.withColumnsRenamed(renames) if renames else frame
    require_columns(df, CANONICAL_COLUMNS, "transaction")
    df = df.select(*CANONICAL_COLUMNS)
    df = df.select(
        F.col("invoice_no").cast("string").alias("invoice_no"),
        F.col("stock_code").cast("string").alias("stock_code"),
        F.col("description").cast("string").alias("description"),
        _lenient_double(df, "quantity").alias("quantity"),
        _lenient_timestamp(df, "invoice_date").alias("invoice_date"),
        _lenient_double(df, "unit_price").alias("unit_price"),
        F.regexp_replace(F.col("customer_id").cast("string"), r"\.0$", "").alias("customer_id"),
        F.col("country").cast("string").alias("country"),
    )
    return df.select(
        *CANONICAL_COLUMNS,
        cancellation_flag(F.col("invoice_no"), F.col("quantity")).alias("is_cancellation"),
        (F.col("quantity") * F.col("unit_price")).alias("line_value"),
        event_id_expr(F.col("invoice_no"), F.col("stock_code"), F.col("invoice_date"),
                      F.col("customer_id")).alias("event_id"),
    )
