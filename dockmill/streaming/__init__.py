"""Structured Streaming: resumable ingest."""
