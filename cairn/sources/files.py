"""File and in-memory sources (CSV, typed empty tables, generated series)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """CSV scan.

    * ``schema`` given: typed scan, no inference pass (preferred at scale).
    * ``infer_schema``: header plus a sampling pass over the files.
    * neither: every column is a string; cast later with ``try_cast``.
    * ``header=False`` with ``columns``: positional rename (``toDF``).
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    if columns:
        df = df.toDF(*columns)
    return df


def try_cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast string columns read from text; bad values become NULL, not errors."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """Typed empty bootstrap table (first run of a cumulative load)."""
    return spark.createDataFrame([], schema)


def rows_table(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """In-memory rows with an explicit schema (tests and fixtures)."""
    return spark.createDataFrame(rows, schema)


def integer_series(spark: SparkSession, start: int, stop: int, name: str = "value") -> DataFrame:
    """Inclusive integer series as a distributed range (GENERATE_SERIES)."""
    return spark.range(start, stop + 1).select(F.col("id").cast("int").alias(name))


def date_series(start: Column, stop: Column, name: str = "d") -> Column:
    """Inclusive day series per row: explode it where rows are needed."""
    return F.explode(F.sequence(start, stop, F.expr("INTERVAL 1 DAY"))).alias(name)
