"""Operators for building training corpora: search, deduplication, classifiers, tokens, archives, packing."""
