"""Incremental landing of raw payload files with Structured Streaming."""
