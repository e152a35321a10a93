"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
import pkgutil

from ..plans.registry import Tables

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark, sf_dir: str, name: str):
    Tables(spark, sf_dir)  # gives the executors this package
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load() -> None:
    package = importlib.import_module(__package__)
    for module in sorted(m.name for m in pkgutil.iter_modules(package.__path__)):
        if module.startswith("q_"):
            importlib.import_module(f"{__package__}.{module}")


def queries():
    load()
    return dict(QUERIES)


def oracles():
    load()
    return dict(ORACLES)
