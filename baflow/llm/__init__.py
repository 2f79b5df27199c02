"""Operators for preparing training data: scoring, filtering, de-duplicating and packing text corpora."""
