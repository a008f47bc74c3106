"""Data-quality checks that PostgreSQL enforced by constraints (V1-V3).

Each returns the offending rows (empty when the table is clean), so a job
can fail on ``not df.isEmpty()`` or write the report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key check: keys that occur more than once (partial agg)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*keys, F.lit("duplicate_key").alias("problem"))
    )


def domain_violations(df: DataFrame, keys: list[str], column: str, domain) -> DataFrame:
    """ENUM check: NULL or a value outside ``domain``."""
    bad = F.col(column).isNull() | ~F.col(column).isin(*domain)
    return df.where(bad).select(*keys, F.lit(f"{column}_domain").alias("problem"))


def array_length_histogram(df: DataFrame, array_col: str) -> DataFrame:
    """``cardinality(a), COUNT(1) GROUP BY 1`` (V3)."""
    return df.groupBy(F.size(array_col).alias("cardinality")).agg(F.count(F.lit(1)).alias("rows"))
