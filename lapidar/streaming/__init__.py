"""Structured Streaming versions of the ingestion, upsert and fact loads."""
