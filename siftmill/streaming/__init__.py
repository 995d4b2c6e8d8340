"""Incremental intake by Structured Streaming."""
