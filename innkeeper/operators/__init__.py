"""Operators: dedup, surrogate keys, lookups and joins, data-quality rules."""
