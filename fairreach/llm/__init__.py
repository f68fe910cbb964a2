"""Operators for preparing training data: filters, near-duplicates, search, tokens and models."""
