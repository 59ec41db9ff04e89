"""Operators of a training-data pipeline: scans, tokenisation, filters, dedup.

Nothing else in the package imports this subpackage; the entry module adds its
queries (``llm.queries``) only when it is present.
"""
