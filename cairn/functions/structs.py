"""Struct, map and JSON builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(**fields: Column) -> Column:
    """``json_build_object``: keys in the given order, NULL values kept."""
    return F.to_json(
        F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"}
    )


def string_map(**fields: Column) -> Column:
    """``map('k', v, ...)``; values cast to string (a map has one value type)."""
    args = []
    for k, c in fields.items():
        args += [F.lit(k), c.cast("string")]
    return F.create_map(*args)
