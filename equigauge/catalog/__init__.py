"""The registered queries: each operator over the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ("fairness", "quality", "volumes", "training", "enforcement", "controls", "streams", "storage")


def _merged(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out.update(getattr(import_module(f"equigauge.catalog.{module}"), name))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracles() -> dict[str, str]:
    return _merged("ORACLES")
