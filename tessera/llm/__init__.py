"""Operators for preparing training text: filters, deduplication, tokenising.

Nothing outside this package imports it; its queries are in ``queries.py``.
"""
