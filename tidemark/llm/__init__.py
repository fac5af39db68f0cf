"""Operators of a training-data pipeline: search, scoring, deduplication, packing, token counts."""
