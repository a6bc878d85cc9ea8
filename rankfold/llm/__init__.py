"""Operators for preparing training data (filtering, deduplication, mixing, encoding).

Nothing else in the library imports this subpackage.
"""
