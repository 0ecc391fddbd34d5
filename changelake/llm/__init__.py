"""Operators of a training-data pipeline: deduplication, search, quality rules, mixing, packing and token files."""
