"""Structured Streaming versions of the retry and upsert jobs."""
