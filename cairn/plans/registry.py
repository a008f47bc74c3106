"""Registry of named queries: a Spark callable and, where SQL can express
it, the equivalent DuckDB SQL used as an independent oracle."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...] = ()


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return deco


_SCALARS: dict = {}


def scalar(df: DataFrame, expr, cache_key=None):
    """One aggregate value computed on the cluster (a run parameter such as
    the as-of period); only the single value reaches the driver.

    With ``cache_key`` the value is kept for the session (key it on the
    input path and its modification time so new data gives a new value).
    """
    if cache_key is not None:
        key = (df.sparkSession.sparkContext.applicationId, cache_key)
        if key not in _SCALARS:
            _SCALARS[key] = df.agg(expr.alias("v")).first()["v"]
        return _SCALARS[key]
    return df.agg(expr.alias("v")).first()["v"]


def input_key(sf_dir: str, table: str, what: str):
    """Cache key for a scalar derived from one input table."""
    import os

    from cairn.sources.tables import table_path

    path = table_path(sf_dir, table)
    if os.path.isdir(path):  # a folder keeps its time when files below it change
        return None
    try:
        st = os.stat(path)
        stamp = (st.st_mtime_ns, st.st_size)
    except OSError:  # remote file systems: no local stat, no caching
        return None
    return (path, stamp, what)


def load_all() -> dict[str, Query]:
    # importing the modules fills REGISTRY
    from cairn.plans import analytics, dimensional, facts, joins, spark_sql, storage, stream_batches, streams  # noqa: F401

    return REGISTRY
