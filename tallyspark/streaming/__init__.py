"""Structured Streaming drivers for the incremental jobs (file streams + foreachBatch)."""
