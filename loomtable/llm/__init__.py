"""Operators for large training corpora: deduplication, scoring, filtering and mixing of documents."""
