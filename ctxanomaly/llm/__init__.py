"""Operators of a training-data pipeline (deduplication, filters, archives, packing).

Nothing outside this subpackage imports it; the entry file registers its
queries only where it can be imported.
"""
