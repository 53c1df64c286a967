"""Tidemark: a PySpark feature engine.

Computes features as of any moment, joins them to training rows without leakage, publishes the
latest values, watches quality, drift and freshness, and trains and applies models on them.
"""
