"""Operators for training-data pipelines: search, deduplication, extraction, filtering, mixing and tokenizing."""
