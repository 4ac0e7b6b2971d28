"""Operators for training-data pipelines: deduplication, mixing, quality, extraction, encoding."""
