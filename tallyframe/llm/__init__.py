"""Operators for training-data pipelines: filters, deduplication, scans and packing."""
