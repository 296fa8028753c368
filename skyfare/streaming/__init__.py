"""Incremental forms of the batch jobs (Structured Streaming)."""
