"""Exact dedup with a heavy-hitter split (built-in functions only).

1. Every text becomes a slim row (row number, id, digest), written once to
   the shared folder, so the texts are read one time.
2. Bounded frequent-items sketches (the Misra-Gries family, as Spark's
   ``approx_top_k``), one per first byte of the digests, so that no single
   task merges all of them, name up to ``heavy`` candidates together. Which
   digests they name affects speed only, never the result.
3. The candidates are verified by an exact count and an exact winner, an
   aggregation that combines before its shuffle. Their at most ``heavy``
   winners are broadcast and decide the frequent digests map-side.
4. The remaining digests are shuffled in the ordinary way.

Texts are equal when their bytes are equal (SHA-256 digests of the whole
text are compared). Null texts count as empty texts. Of equal texts the row
with the largest id stays; a null id is smaller than any other, and of
repeated rows with the same id exactly one stays (``kept``). Other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import cut_lineage

HEAVY = 1024  # broadcast bound: digests whose winners travel map-side
TRACKED = 64  # counters of a sketch
PARTS = 256  # sketches, by the first byte of the digest


def slim_rows(documents: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """(row, id, digest) of every document."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return documents.select(
        row.alias("row"),
        F.col(id_col).alias("id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"),
    )


def frequent(slim: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``heavy`` digests that may be frequent. A digest with more
    than one in ``tracked`` of the rows of its part is among them."""
    each = max(1, heavy // PARTS)
    part = F.substring("digest", 1, 2) if heavy >= PARTS else F.lit("")
    items = slim.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k(digest, {each}, {int(tracked)})").alias("top"))
    found = items.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest"), F.col("t.count").alias("n"))
    return found.where("n > 1").select("digest").limit(heavy)


def mark_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    heavy: int = HEAVY,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per document: row, id, digest, keep_id, group_size, kept.

    ``row`` is ``row_col`` when given, else a number of the row within this
    result.
    """
    slim = cut_lineage(slim_rows(documents, id_col, text_col, row_col), "exact_dedup_slim")
    candidates = cut_lineage(frequent(slim, heavy, tracked), "exact_dedup_heavy")

    best = F.max(F.struct("id", "row")).alias("best")
    verified = slim.join(F.broadcast(candidates), "digest").groupBy("digest").agg(best, F.count("*").alias("group_size"))
    winners = cut_lineage(verified, "exact_dedup_winners")  # at most `heavy` rows

    tagged = slim.join(F.broadcast(winners), "digest", "left")
    columns = ["row", "id", "digest", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept")]
    decided = tagged.where(F.col("best").isNotNull()).select(*columns)

    # no candidate digest is left, so these groups are small
    group = Window.partitionBy("digest")
    rest = (
        tagged.where(F.col("best").isNull())
        .select("row", "id", "digest")
        .withColumn("best", F.max(F.struct("id", "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
        .select(*columns)
    )
    return decided.unionByName(rest)
