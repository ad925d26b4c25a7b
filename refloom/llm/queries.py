"""The queries of this package, gathered from its modules."""

from __future__ import annotations

from refloom.llm import distinctive_terms, mixing, name_variants, packing, page_content, reference_linkage, residue, set_join, survivorship

_MODULES = [distinctive_terms, set_join, name_variants, reference_linkage, survivorship, page_content, packing, mixing, residue]


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.oracle_sql().items()}
