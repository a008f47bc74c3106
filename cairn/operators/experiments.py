"""Experiment assignment and readout as batch jobs.

The reference asks an experimentation service for a user's group. Here
assignment is a deterministic hash bucket of the user id (same user, same
salt, same cell on every run and in any engine), and the readout is one
aggregation per cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_bucket(user_id, salt: str, buckets: int = 100):
    """``conv(substr(md5(salt || id), 1, 8), 16, 10) % buckets``."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), user_id.cast("string"))), 1, 8), 16, 10).cast("long")
    return (h % buckets).cast("int")


def assign(users: DataFrame, salt: str, cells=(("control", 50), ("treatment", 50)), key: str = "user_id") -> DataFrame:
    """One row per user: bucket 0..99 and the cell owning that bucket range."""
    b = hash_bucket(F.col(key), salt)
    expr = None
    upper = 0
    for name, share in cells:
        upper += share
        expr = F.when(b < upper, name) if expr is None else expr.when(b < upper, name)
    return users.select(key).distinct().select(key, b.alias("bucket"), expr.alias("cell"))


def readout(assignment: DataFrame, events: DataFrame, conversion_type: str, key: str = "user_id") -> DataFrame:
    """Per cell: users, converters, conversion rate, mean and variance of
    per-user value. Values are summed in cents as DECIMAL so the sums are
    exact in any order; only the final ratios are floating point."""
    per_user = events.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max((F.col("event_type") == conversion_type).cast("int")).alias("converted"),
        F.sum(F.round(F.col("value") * 100).cast("decimal(38,0)")).alias("cents"),
    )
    joined = assignment.join(per_user, key, "left").select(
        "cell",
        F.coalesce("converted", F.lit(0)).alias("converted"),
        F.coalesce("cents", F.lit(0).cast("decimal(38,0)")).alias("cents"),
    )
    agg = joined.groupBy("cell").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("converted").cast("long").alias("converters"),
        F.sum("cents").alias("_s"),
        F.sum(F.col("cents") * F.col("cents")).alias("_ss"),
    )
    n = F.col("users").cast("double")
    s = F.col("_s").cast("double")
    ss = F.col("_ss").cast("double")
    return agg.select(
        "cell",
        "users",
        "converters",
        (F.col("converters").cast("double") / n).alias("conversion_rate"),
        (s / n / 100.0).alias("mean_value"),
        ((n * ss - s * s) / (n * (n - 1)) / 10000.0).alias("var_value"),
    )


def z_test(readout_df: DataFrame, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Two-proportion z statistic of conversion between two cells (one row,
    from one global aggregate over the per-cell readout)."""
    def pick(cell, col):
        return F.max(F.when(F.col("cell") == cell, F.col(col))).cast("double")

    both = readout_df.agg(
        pick(control, "users").alias("n1"), pick(control, "converters").alias("x1"),
        pick(treatment, "users").alias("n2"), pick(treatment, "converters").alias("x2"),
    )
    p1 = F.col("x1") / F.col("n1")
    p2 = F.col("x2") / F.col("n2")
    p = (F.col("x1") + F.col("x2")) / (F.col("n1") + F.col("n2"))
    se = F.sqrt(p * (1 - p) * (1 / F.col("n1") + 1 / F.col("n2")))
    # z is undefined (NULL) when the pooled rate is 0 or 1
    return both.select(p1.alias("control_rate"), p2.alias("treatment_rate"), F.try_divide(p2 - p1, se).alias("z"))
