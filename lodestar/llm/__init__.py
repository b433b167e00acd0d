"""Operators for preparing text corpora: deduplication, filters, mixing, sharding, classifiers, encoding.

Nothing else in the library imports this package. Its queries are registered by ``catalog``.
"""
