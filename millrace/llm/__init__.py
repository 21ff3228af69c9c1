"""Operators for text and model corpora. Nothing outside this package imports it."""
