"""Operators of a training-data pipeline: deduplication, filters, scans, tokens, page text."""
