"""Relational operators of the catalogue: deduplication, cohorts, shares, trends, pairs, merges."""
