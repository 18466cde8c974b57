"""Incremental landing of listing files with Structured Streaming."""
