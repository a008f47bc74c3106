"""Lookup enrichment: IP address to location by an IP-range table.

The reference calls an HTTP geocoding service once per row. Here the
lookup is a range join against a location table (``start_ip <= ip <=
end_ip``). Ranges may nest or overlap: the narrowest wins, then the one
that starts first, then by its values. The ranges are first cut into
pieces that do not overlap, so a lookup gives at most one row. To keep it
an equi join, the pieces are cut at /16 blocks (at most 65,536 more rows
per level of nesting), and the events join on the block plus the range. The
pieces are a written table, so the planner knows their size: it broadcasts
them below the session's threshold, else it merges both sides sorted by
block, and adaptive execution splits the events of a hot block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import cut_lineage

EMPTY_GEO = "{}"


def ip_to_long(ip) -> F.Column:
    """Dotted IPv4 text to a number; malformed text gives NULL."""
    parts = F.split(ip, r"\.")
    octets = [F.get(parts, i).try_cast("long") for i in range(4)]
    valid = (F.size(parts) == 4)
    for o in octets:
        valid = valid & o.isNotNull() & (o >= 0) & (o <= 255)
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(valid, value)


def disjoint_ranges(locations: DataFrame) -> DataFrame:
    """Pieces (block, lo, hi) of the ranges that do not overlap, each with
    the narrowest range around it. Windows and joins are within a /16 block;
    rows whose range is empty or NULL are left out."""
    cut = (
        locations.where(F.col("start_ip") <= F.col("end_ip"))
        .select("*", F.explode(F.sequence(F.shiftright("start_ip", 16), F.shiftright("end_ip", 16))).alias("_block"))
        .withColumn("_lo", F.greatest("start_ip", F.shiftleft("_block", 16)))
        .withColumn("_hi", F.least("end_ip", F.shiftleft("_block", 16) + 65535))
    )
    points = cut.select("_block", F.explode(F.array("_lo", F.col("_hi") + 1)).alias("lo")).distinct()
    following = F.lead("lo").over(Window.partitionBy("_block").orderBy("lo"))
    pieces = points.withColumn("hi", following - 1).where(F.col("hi").isNotNull())
    around = pieces.join(cut, "_block").where((F.col("_lo") <= F.col("lo")) & (F.col("_hi") >= F.col("hi")))
    narrowest = F.min(F.struct((F.col("end_ip") - F.col("start_ip")).alias("width"), "start_ip", "country", "state", "city")).alias("r")
    return around.groupBy("_block", "lo", "hi").agg(narrowest).select("_block", "lo", "hi", "r.country", "r.state", "r.city")


def enrich_ip(events: DataFrame, locations: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Adds ``geodata`` (JSON with country, state, city; ``{}`` when no range
    matches) to every event: one row per event, none dropped."""
    ev = events.withColumn("_ip", ip_to_long(F.col(ip_col))).withColumn("_block", F.shiftright("_ip", 16))
    right = cut_lineage(disjoint_ranges(locations), "ip_pieces").withColumn("_hit", F.lit(True))
    cond = (ev["_block"] == right["_block"]) & (ev["_ip"] >= right["lo"]) & (ev["_ip"] <= right["hi"])
    joined = ev.join(right, cond, "left")
    place = F.struct(right["country"].alias("country"), right["state"].alias("state"), right["city"].alias("city"))
    geo = F.when(right["_hit"], F.to_json(place)).otherwise(F.lit(EMPTY_GEO))
    return joined.select(*[ev[c] for c in events.columns], geo.alias("geodata"))
