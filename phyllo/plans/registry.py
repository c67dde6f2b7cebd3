"""All queries of the core and their SQL, by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ("pages", "relational", "curation", "evaluation", "more", "readings", "exchange", "streams")


def _gather(what: str) -> dict:
    out: dict = {}
    for m in MODULES:
        try:
            mod = import_module(f"phyllo.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"phyllo.plans.{m}":
                raise
            continue
        out |= getattr(mod, what)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("SQL")
