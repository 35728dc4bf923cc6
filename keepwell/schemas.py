"""Canonical table layouts and the one column-presence check used everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame

# fixed values: names of the canonical columns
CANONICAL_COLUMNS = [
    "invoice_no", "stock_code", "description", "quantity",
    "invoice_date", "unit_price", "customer_id", "country",
]

# Source-name map of the public retail export (fixed values).
SOURCE_COLUMN_MAP = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

# fixed values: what validation reads
VALIDATION_REQUIRED = [
    "invoice_no", "stock_code", "quantity", "invoice_date", "unit_price",
    "customer_id", "country", "is_cancellation", "line_value", "event_id",
]

# fixed values: names of the features
NUMERIC_FEATURES = [
    "recency_days",
    "purchase_frequency",
    "monetary_value",
    "average_order_value",
    "customer_tenure_days",
    "number_of_invoices",
    "number_of_unique_products",
    "purchase_regularity_days",
    "recent_purchasing_trend",
    "cancellation_rate",
    "quantity_purchased",
    "recent_spend",
    "historical_spend",
    "spend_change_ratio",
    "recent_invoice_count",
    "historical_invoice_count",
    "frequency_change_ratio",
]
CATEGORICAL_FEATURES = ["geographic_segment"]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES


class SchemaError(ValueError):
    """A required column is absent."""


def require_columns(df: DataFrame, names, what: str = "input") -> None:
    """Fail naming every missing column (checked on the schema, no job)."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise SchemaError(f"Missing {what} columns: {missing}")
