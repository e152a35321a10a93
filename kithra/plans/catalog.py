"""Loads every query family."""

from __future__ import annotations

import importlib
import pkgutil

from . import registry


def _load() -> None:
    package = importlib.import_module(__package__)
    for module in sorted(m.name for m in pkgutil.iter_modules(package.__path__)):
        if module.startswith("q_"):
            importlib.import_module(f"{__package__}.{module}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracles():
    _load()
    return dict(registry.ORACLES)
