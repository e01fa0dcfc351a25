"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from tessera.llm import bitsliced, divergence, language, licences, mixing, packing, quality, rules, secrets, simhash, substring, token_files, whitening

MODULES = (token_files, bitsliced, mixing, simhash, substring, quality, rules, packing, licences, language, whitening, divergence, secrets)


def queries() -> dict[str, Callable]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
