"""Ledger-driven incremental intake with Structured Streaming."""

from ingot.streaming.intake import stream_intake  # noqa: F401
