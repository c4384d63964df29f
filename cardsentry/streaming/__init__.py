"""Structured Streaming jobs: incremental file ingest and micro-batch scoring."""
