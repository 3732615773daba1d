"""Structured Streaming: bronze ingest, duplicate removal, alerts."""
