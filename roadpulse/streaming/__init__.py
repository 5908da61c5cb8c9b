"""Structured Streaming: ingestion, live scoring and continuous summaries."""
