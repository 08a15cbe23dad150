"""Operators for large training-data pipelines (packing, token stores, near
neighbours, document quality, deduplication, tokenisation, language ID)."""
