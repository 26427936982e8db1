"""Operators of a training-data pipeline: filters, detectors, deduplication, mixing and tokenisation.

Nothing outside this package imports it. ``registry`` holds its registered queries.
"""
