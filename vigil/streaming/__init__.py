"""Structured Streaming ingestion of landed feed pages."""
