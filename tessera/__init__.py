"""Catalogue analytics on Spark."""
