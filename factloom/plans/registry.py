"""All queries of the core with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import delivery, documents, evaluation, found, layout, scalars

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (found, scalars, documents, layout, evaluation, delivery)


def queries() -> dict[str, Query]:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
