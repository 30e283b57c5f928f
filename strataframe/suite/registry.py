"""Registry of checked queries: a Spark callable and, where SQL can say the
same thing, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every suite module so that their queries register."""
    from . import (  # noqa: F401
        catalog_suite,
        manifest_suite,
        metadata_suite,
        product_suite,
        schema_suite,
        series_suite,
        spatial_suite,
        stack_suite,
    )
