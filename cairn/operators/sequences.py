"""Ordered per-key sequences that stay parallel when one key is huge.

A window ``PARTITION BY key ORDER BY t`` puts every row of a key into one
task. Instead, running totals are a distributed prefix sum, at every size:
range-partition on ``(key, order...)`` so a hot key's rows spread over many
partitions (each holds a contiguous slice of the key's sequence), total
each (key, partition) block, and add the totals of the key's earlier
blocks, which come from a tiny per-block aggregate. Every window then sees
at most one partition's rows.

The range-partitioned frame is written to the shared folder first (see
``cut_lineage``): block ids must be the same for the two branches that
read it, and the written table also survives executor loss.

NULL keys are a key of their own; NULL flags count as 0 and NULL conditions
as not met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import cut_lineage


def prefix_totals(df: DataFrame, key: str, order: list[str], sums: list[str], partitions: int | None = None) -> DataFrame:
    """Adds ``_rn`` (1-based position of the row in its key's sequence) and
    ``cum_<c>`` (running sum of ``c`` up to and including the row).
    ``order`` must be a total order within a key."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, key, *order).withColumn("_blk", F.spark_partition_id()), "ranged")
    w_local = Window.partitionBy(key, "_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        F.count(F.lit(1)).over(w_local).alias("_lrn"),
        *[F.sum(c).over(w_local).alias(f"_l_{c}") for c in sums],
    )
    blocks = ranged.groupBy(key, "_blk").agg(
        F.count(F.lit(1)).alias("_bn"), *[F.sum(c).alias(f"_b_{c}") for c in sums]
    )
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        key,
        "_blk",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_o_n"),
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    local, offsets = local.alias("l"), offsets.alias("o")
    out = local.join(offsets, F.col(f"l.{key}").eqNullSafe(F.col(f"o.{key}")) & (F.col("l._blk") == F.col("o._blk")))
    return out.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("_o_n") + F.col("_lrn")).alias("_rn"),
        *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"cum_{c}") for c in sums],
    )


def best_stretch(games: DataFrame, key: str, order: list[str], flag: str, length: int = 90,
                 partitions: int | None = None) -> DataFrame:
    """Most flagged rows in any ``length`` consecutive rows per key
    (``sum(flag) OVER (ROWS length-1 PRECEDING)``, then ``max``).

    The rolling sum is ``cum(r) - cum(r - length)`` from ``prefix_totals``;
    the earlier total is fetched by an equi join on (key, position), which
    spreads a hot key over all tasks. A key with no set flag has 0.
    """
    g = cut_lineage(games.select(key, *order, F.coalesce(F.col(flag).cast("long"), F.lit(0)).alias("_f")), "stretch_in")
    pre = cut_lineage(prefix_totals(g, key, order, ["_f"], partitions).select(key, "_rn", "cum__f"), "stretch_totals")
    back = pre.select(F.col(key).alias("_k"), (F.col("_rn") + length).alias("_at"), F.col("cum__f").alias("_back"))
    rolled = pre.join(back, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_rn") == F.col("_at")), "left").select(
        key, (F.col("cum__f") - F.coalesce("_back", F.lit(0))).alias("_n")
    )
    return rolled.groupBy(key).agg(F.count(F.lit(1)).alias("games"), F.max("_n").alias(f"max_{flag}_in_{length}"))


def longest_streak(games: DataFrame, key: str, order: list[str], condition, name: str = "longest_streak",
                   partitions: int | None = None) -> DataFrame:
    """Longest run of consecutive rows meeting ``condition`` per key (gaps
    and islands: a row's island is the number of breaking rows before it).
    One pair of partial aggregations over ``prefix_totals``, no join back."""
    ok = F.coalesce(condition, F.lit(False)).cast("long")
    g = cut_lineage(games.select(key, *order, ok.alias("_ok"), (1 - ok).alias("_brk")), "streak_in")
    pre = prefix_totals(g, key, order, ["_brk"], partitions)
    islands = pre.groupBy(key, "cum__brk").agg(F.sum("_ok").alias("_len"), F.count(F.lit(1)).alias("_rows"))
    return islands.groupBy(key).agg(F.sum("_rows").alias("games"), F.max("_len").alias(name))
