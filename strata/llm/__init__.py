"""Operators of a training-data pipeline: rules, packing, tokenisation, near-duplicates, secrets, PII, scoring.

Nothing outside this package imports it.
"""
