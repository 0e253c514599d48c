"""Streams: resumable ingestion and clustering with state."""
