"""Structured Streaming ingestion of JSON messages."""
