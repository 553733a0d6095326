"""Structured Streaming forms of the incremental pipelines."""
