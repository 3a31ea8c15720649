"""Structured Streaming ingestion and upsert."""
