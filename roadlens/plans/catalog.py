"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole of the driver's tables. Modules add entries with :func:`register`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.session import ship_package

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``. The stored builder pins the session
    time zone to UTC first: every timestamp in the data model is a UTC
    instant, and NTZ <-> instant casts follow the session zone."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = (utc, sql)
        return fn

    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the modules fills REGISTRY.
    from roadlens.plans import queries_batch, queries_serving, queries_stream  # noqa: F401

    return REGISTRY
