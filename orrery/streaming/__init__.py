"""Structured Streaming entry points (scoring new rows as they arrive)."""
