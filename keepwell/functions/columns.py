"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values --------------------------------------------------------------
# Segment map: exact "United Kingdom"; these fifteen countries are "Europe";
# everything else is "Rest of world".
EUROPE_COUNTRIES = (
    "Austria", "Belgium", "Denmark", "Finland", "France", "Germany", "Iceland",
    "Ireland", "Italy", "Netherlands", "Norway", "Portugal", "Spain", "Sweden",
    "Switzerland",
)
SEGMENT_HOME = "United Kingdom"
SEGMENT_EUROPE = "Europe"
SEGMENT_OTHER = "Rest of world"
KNOWN_SEGMENTS = (SEGMENT_HOME, SEGMENT_EUROPE, SEGMENT_OTHER)
# ---------------------------------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000.0
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since 1970 for a timestamp_ntz (zone free)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from start to end (end - start)."""
    return micros_between(start, end) / F.lit(MICROS_PER_DAY)


def is_positive_purchase(cancel: str = "is_cancellation", quantity: str = "quantity",
                         price: str = "unit_price") -> Column:
    """Not cancelled AND quantity > 0 AND price >= 0; unknown counts as not positive."""
    return (~F.col(cancel)) & F.coalesce(F.col(quantity) > 0, F.lit(False)) & \
        F.coalesce(F.col(price) >= 0, F.lit(False))


def cancellation_flag(invoice_no: Column, quantity: Column) -> Column:
    """Invoice starting with C (any case) OR negative quantity; null-safe false."""
    return F.coalesce(F.upper(invoice_no).startswith("C"), F.lit(False)) | \
        F.coalesce(quantity < 0, F.lit(False))


def event_id_expr(invoice_no: Column, stock_code: Column, invoice_date: Column,
                  customer_id: Column) -> Column:
    """Stable 128-bit event key; nulls get a sentinel so they never collide with text."""
    def part(c):
        return F.coalesce(c, F.lit("\u0000"))
    return F.md5(F.concat_ws(
        "\u001f",
        part(invoice_no), part(stock_code),
        part(epoch_micros(invoice_date).cast("string")), part(customer_id),
    ))


def geographic_segment(country: Column, home: str = SEGMENT_HOME,
                       europe=EUROPE_COUNTRIES) -> Column:
    return (F.when(country == F.lit(home), F.lit(SEGMENT_HOME))
            .when(country.isin(*europe), F.lit(SEGMENT_EUROPE))
            .otherwise(F.lit(SEGMENT_OTHER)))


def pseudonymize(customer_id: Column, salt: str = "customer:") -> Column:
    """First 16 hex characters of sha256(salt + id); salt is a deployment parameter."""
    return F.substring(F.sha2(F.concat(F.lit(salt), customer_id.cast("string")), 256), 1, 16)


def beside(first, *others):
    """One-row tables as one row: every other side is broadcast, as it is one row."""
    for other in others:
        first = first.join(F.broadcast(other))
    return first
