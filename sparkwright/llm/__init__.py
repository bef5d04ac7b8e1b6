"""Operators for training-data pipelines (dedup, scoring, extraction, mixing, sharding).

Nothing else in the library imports this subpackage.
"""
