"""Operators of a training-data pipeline: dedup, filters, tokenizers, packing, vector search."""
