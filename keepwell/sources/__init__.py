"""Readers and writers: driver-table adapters, CSV/Parquet transactions, sinks."""

from keepwell.sources.tables import load_table, events_transactions, orders_transactions  # noqa: F401
from keepwell.sources.files import read_raw_transactions, ingest_transactions  # noqa: F401
