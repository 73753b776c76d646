"""Incremental bronze to silver with Structured Streaming."""
