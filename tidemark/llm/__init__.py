"""Operators that prepare training text: scoring, mixing, deduplication, tokens, packing.

Nothing else in the library imports this package.
"""
