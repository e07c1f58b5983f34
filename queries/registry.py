"""Every query module contributes a ``QUERIES`` and an ``ORACLE`` dictionary."""

from __future__ import annotations

from importlib import import_module

MODULES = ("sources", "texts", "tokens", "sequences", "ngram", "vectors", "rewards", "policy", "evals", "runlog", "streams")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(import_module(f"queries.{name}"), attribute))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
