"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

_BUILDS: dict[str, Build] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("ingest", "relational", "trend", "text", "stance", "hypothesis", "model")


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; `sql` is the equivalent statement for the oracle, where one exists."""

    def register(build: Build) -> Build:
        if name in _BUILDS:
            raise ValueError(f"query {name} is registered twice")
        _BUILDS[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"threadlens.plans.{module}_queries")


def builds() -> dict[str, Build]:
    _load()
    return dict(_BUILDS)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
