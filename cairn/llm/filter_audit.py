"""Interaction audit of quality filters by contingency tensor contractions.

Every document fails or passes each of five filters. All that any order of
the filters can show follows from how many documents of a part have each of
the 32 patterns of failures, so the audit counts these once and contracts.

1. Patterns: four filters look at one text alone (built-in functions, one
   scan, written as slim rows with a digest). The fifth fails a text that a
   smaller id has too: the smallest id of each digest is one aggregation, and
   (digest, id) rows that meet it pass, so a digest that a third of all rows
   share is not a join key by itself.
2. Counts: rows by part and pattern, and of them the good and the toxic ones;
   an aggregation that combines before its shuffle, at most 32 rows a part.
3. Contractions: the counts of a part are a 2x2x2x2x2 tensor. A step of an
   order selects pass, fail or all along each axis; one einsum applies the
   selections of all steps of all orders.

Null texts are empty; words are maximal runs of anything but space and
\\t..\\r. An empty text is short (A) and passes B, C and D. Repeated rows count
as often as they stand there; rows with the same id and text are not copies
of each other. A null id is not smaller than any id and no id is smaller
than it; such a row has no label. A null part is the empty string. A document
is good (toxic) when any label row of its id says so. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import cut_lineage

FILTERS = "ABCDE"  # axis and bit of each filter, in this order
MEASURES = ["n", "good", "toxic"]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> list[Column]:
    """Do the filters A to D reject the text?"""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words = F.size(words)
    return [
        n_words < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n_words,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]


def pattern_counts(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                   good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """part, code (bit i: filter i rejects), n, good, toxic."""
    text = F.coalesce(documents[text_col], F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text))]
    slim = documents.select(
        documents[id_col].alias("id"),
        F.coalesce(documents[part_col].cast("string"), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).alias("code"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    slim = cut_lineage(slim, "filter_audit_slim")

    rows = slim.where(F.col("id").isNotNull()).groupBy("id", "digest", "part", "code").agg(F.count("*").alias("n"))
    first = slim.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.select(
        labels[id_col].alias("id"),
        F.equal_null(labels[good_col], F.lit(1)).alias("is_good"),
        F.equal_null(labels[toxic_col], F.lit(1)).alias("is_toxic"),
    )
    marks = marks.where("is_good OR is_toxic").groupBy("id").agg(F.max("is_good").alias("is_good"), F.max("is_toxic").alias("is_toxic"))
    named = rows.join(first, ["id", "digest"], "left").join(marks, "id", "left")
    counted = named.select(
        "part",
        F.when(F.col("first"), F.col("code")).otherwise(F.col("code") + 16).alias("code"),
        "n",
        F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
        F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic"),
    )
    unnamed = slim.where(F.col("id").isNull()).select("part", "code", F.lit(1).cast("long").alias("n"), *(F.lit(0).cast("long").alias(m) for m in MEASURES[1:]))
    return counted.unionByName(unnamed).groupBy("part", "code").agg(*(F.sum(m).alias(m) for m in MEASURES))


def selections(orders: list[str]):
    """For every step of every order the choice along each axis (steps, 5, 2):
    of what is left after it, what it removes, all it rejects, and what only
    it rejects."""
    kept, removed, rejected, alone = [], [], [], []
    for order in orders:
        for step, name in enumerate(order):
            before = order[:step]
            kept.append([PASS if f in before or f == name else ALL for f in FILTERS])
            removed.append([FAIL if f == name else PASS if f in before else ALL for f in FILTERS])
            rejected.append([FAIL if f == name else ALL for f in FILTERS])
            alone.append([FAIL if f == name else PASS for f in FILTERS])
    return tuple(np.array(x, dtype=np.int64) for x in (kept, removed, rejected, alone))


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(steps, measures) sums of the tensor's selected cells."""
    return np.einsum("abcdem,sa,sb,sc,sd,se->sm", tensor, *np.moveaxis(chosen, 1, 0), optimize=True)


def audit_part(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part from its at most 32 counts."""
    cells = np.zeros((32, len(MEASURES)), dtype=np.int64)
    np.add.at(cells, counts["code"].to_numpy(), counts[MEASURES].to_numpy(dtype=np.int64))
    # bit i of the code is axis i
    tensor = cells.reshape(2, 2, 2, 2, 2, -1).transpose(4, 3, 2, 1, 0, 5)
    orders = ["".join(p) for p in permutations(FILTERS)]
    kept, removed, rejected, alone = (contract(tensor, chosen) for chosen in selections(orders))
    name = np.array([f for order in orders for f in order])
    shapley = {f: int(removed[name == f, 0].sum()) for f in FILTERS}
    return pd.DataFrame(
        {
            "part": counts["part"].iloc[0],
            "filter_order": np.repeat(orders, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders)),
            "kept": kept[:, 0],
            "removed": removed[:, 0],
            "redundant": rejected[:, 0] - removed[:, 0],
            "unique_fails": alone[:, 0],
            "good_lost": removed[:, 1],
            "toxic_lost": removed[:, 2],
            "shapley": [shapley[f] for f in name],
        }
    )


def audit(documents: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley; see ``pattern_counts`` for ``columns``."""
    return pattern_counts(documents, labels, **columns).groupBy("part").applyInPandas(audit_part, RESULT)
