"""Incremental publishing of newly landed CSV files (Structured Streaming, exactly once)."""

from disclosure.streaming.publish import loan_stream, publish_available, publish_stream

__all__ = ["loan_stream", "publish_available", "publish_stream"]
