"""Operators of a training-data pipeline: filters, dedup, search, extraction, tokens, packing."""
