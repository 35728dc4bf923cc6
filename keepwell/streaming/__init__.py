"""Structured Streaming jobs (transaction dedup, per-row scoring, per-batch drift)."""
