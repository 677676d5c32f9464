"""Relational operators of the pipeline: dedup, quality, merge, staging, aggregates, warehouse."""
