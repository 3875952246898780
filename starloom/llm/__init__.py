"""Operators of a large-scale training-data pipeline (mixing, quality, deduplication, language-model
scoring, token output, packing).  Nothing outside this package imports it."""
