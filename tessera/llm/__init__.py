"""Training-data operators: token files, search, mixing, dedup, quality, packing, licences, language.

Nothing else in the library imports this subpackage.
"""
