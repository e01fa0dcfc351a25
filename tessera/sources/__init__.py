"""Readers: driver tables bound to the catalogue relations, captured files, archives."""
