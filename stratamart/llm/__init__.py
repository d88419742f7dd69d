"""Operators for building training corpora: extraction, tokens, filters, near-duplicates, packing."""
