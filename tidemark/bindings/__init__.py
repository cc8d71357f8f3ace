"""Queries over the test tables and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("report_queries", "operator_queries", "expression_queries", "source_queries")


def _load():
    for name in _MODULES:
        import_module(f"tidemark.bindings.{name}")
    return import_module("tidemark.bindings.registry")


def load_queries():
    return dict(_load().QUERIES)


def load_oracle():
    return dict(_load().ORACLE)
