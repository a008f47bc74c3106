"""Jobs written as Spark SQL text over frames.

The text names its frames in braces (``FROM {players}``). Spark registers
each under a name of its own for the length of the call, so a caller's temp
views of the same names are neither replaced nor left behind; the Catalyst
plan is the same as from the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run ``query`` with ``frames`` in the places of their names and
    ``args`` for its ``:name`` parameters."""
    return spark.sql(query, args=args, **frames)
