"""Vertex and edge tables of the property-graph model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import cut_lineage

from cairn.functions.structs import json_object, string_map


def dedup(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep one row per ``keys``: the first row under ``order`` (the
    reference's ``row_number() OVER (PARTITION BY keys) = 1``, made
    deterministic by a total order).

    With plain ascending column names the pick is ``min(struct(order...,
    rest...))``, an aggregation with a map-side partial step, so a key with
    millions of duplicate rows is reduced in every task before the shuffle.
    Other orderings (``desc`` columns) fall back to ``row_number``.
    """
    if all(isinstance(c, str) for c in order):
        rest = [c for c in df.columns if c not in keys and c not in order]
        packed = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
        return packed.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def team_vertices(teams: DataFrame, as_map: bool = False, tie_break: str = "source_rank") -> DataFrame:
    """One ``team`` vertex per team id, properties as JSON (or a string map)."""
    one = dedup(teams, ["team_id"], [tie_break])
    fields = dict(
        abbreviation=F.col("abbreviation"),
        nickname=F.col("nickname"),
        city=F.col("city"),
        arena=F.col("arena"),
        year_founded=F.col("yearfounded"),
    )
    props = string_map(**fields) if as_map else json_object(**fields)
    return one.select(
        F.col("team_id").alias("identifier"),
        F.lit("team").alias("type"),
        props.alias("properties"),
    )


def player_game_edges(details: DataFrame) -> DataFrame:
    """``plays_in`` edges player -> game from deduplicated game details."""
    return details.select(
        F.col("player_id").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("game_id").alias("object_identifier"),
        F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(
            start_position=F.col("start_position"),
            pts=F.col("pts"),
            team_id=F.col("team_id"),
            team_abbreviation=F.col("team_abbreviation"),
        ).alias("properties"),
    )


MAX_ROSTER_PER_TASK = 5000


def player_player_edges(details: DataFrame, max_roster_per_task: int | None = MAX_ROSTER_PER_TASK) -> DataFrame:
    """``shares_team`` / ``plays_against`` edges between players of one game,
    each unordered pair once (subject id > object id), with the number of
    shared games and both players' points.

    The pair list is the output itself, so the players of a game are joined
    with each other: an equi join with a residual predicate (no nested loop),
    on five projected columns. Games are cut into blocks of at most about
    ``max_roster_per_task`` players and each pair of blocks is a join key of
    its own, so a huge game's pairs spread over many tasks; most games are one
    block. ``None`` joins on the game alone.
    """
    # the block count and both sides of the join read it: written once
    slim = cut_lineage(details.select("game_id", "player_id", "player_name", "team_abbreviation", "pts"), "rosters")
    columns = [*slim.columns, "_b", "_lo", "_hi"]
    if max_roster_per_task is None:
        x = slim.select("*", *[F.lit(0).alias(c) for c in columns[-3:]])
    else:
        blocks = F.ceil(F.count(F.lit(1)) / F.lit(max_roster_per_task)).cast("int")
        rosters = slim.groupBy("game_id").agg(blocks.alias("_nb"))
        x = slim.join(rosters, "game_id").withColumn("_b", F.pmod(F.xxhash64("player_id"), F.col("_nb")).cast("int"))
        x = x.withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
        x = x.withColumn("_lo", F.least("_b", "_p")).withColumn("_hi", F.greatest("_b", "_p")).select(*columns)
    a, b = x.alias("a"), x.alias("b")
    on = (
        (F.col("a.game_id") == F.col("b.game_id"))
        & (F.col("a._lo") == F.col("b._lo"))
        & (F.col("a._hi") == F.col("b._hi"))
        # each pair only in the task of its own block pair
        & (F.least("a._b", "b._b") == F.col("a._lo"))
        & (F.greatest("a._b", "b._b") == F.col("a._hi"))
    )
    pairs = a.join(
        b,
        on & (F.col("a.player_name") != F.col("b.player_name")) & (F.col("a.player_id") > F.col("b.player_id")),
        "inner",
    )
    edge = F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"), "shares_team").otherwise(
        "plays_against"
    )
    return pairs.groupBy(
        F.col("a.player_id").alias("subject_identifier"),
        F.col("a.player_name").alias("subject_name"),
        F.col("b.player_id").alias("object_identifier"),
        F.col("b.player_name").alias("object_name"),
        edge.alias("edge_type"),
    ).agg(
        F.count(F.lit(1)).alias("num_games"),
        F.sum("a.pts").alias("subject_points"),
        F.sum("b.pts").alias("object_points"),
    )
