"""Registered query catalogue: name → (spark, sf_dir) -> DataFrame, and
name → DuckDB SQL over the same tables (omitted where no SQL form
exists)."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("bronze_queries", "table_queries", "state_queries", "run_queries", "kept_queries", "profile_queries",
            "step_queries")


def all_queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(import_module(f"ingot.queries.{m}").QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _MODULES:
        out.update(import_module(f"ingot.queries.{m}").ORACLES)
    return out
