"""Queries over the driver's tables, one per operator, with their oracle SQL."""

from __future__ import annotations


def _load() -> None:
    from importlib import import_module

    for name in ("models", "scalars", "relational", "moving"):
        import_module(f"teampulse.catalog.{name}")


def queries() -> dict:
    from teampulse.catalog.base import QUERIES

    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    from teampulse.catalog.base import ORACLES

    _load()
    return dict(ORACLES)
