"""Operators of a training-data pipeline: rules, formatting, scans, packing, models and deduplication."""
