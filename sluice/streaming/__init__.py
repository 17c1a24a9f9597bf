"""Structured Streaming form of the quality gate (incremental raw-file loads)."""
