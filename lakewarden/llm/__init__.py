"""Operators of a training-data pipeline: deduplication, quality, extraction, scoring, formatting, encoding, packing.

Nothing outside this folder imports it. The registered queries and their SQL are in ``queries.py``.
"""
