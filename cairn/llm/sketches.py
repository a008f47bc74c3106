"""Sums of counting sketches that tasks hand over in parts."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb

KIND = "part int, counts binary"


def _add(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(tb.column(batch, "part").to_pylist(), tb.column(batch, "counts")):
            x = np.frombuffer(blob.as_py(), "<i8")
            sums[part] = sums[part] + x if part in sums else x
    blobs = [x.astype("<i8").tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"])


def summed_parts(counts: DataFrame, parts: int, finish=None, kind: str = KIND) -> DataFrame:
    """One row (part, counts) per part: the sum of all rows of the part.
    ``counts`` is a written table with a row per part and task; a tree of two
    levels adds them, so that no task adds up more than about the square root
    of the tasks, however many there were. ``finish`` maps the batches of sums
    to rows of ``kind`` in the same Python step: with a step of its own, each
    core would have two Python workers from then on."""

    def last(batches):
        return finish(_add(batches)) if finish else _add(batches)

    tasks = -(-counts.count() // parts)
    groups = max(1, math.isqrt(tasks))
    group = F.pmod(F.xxhash64("counts"), F.lit(groups))
    near = counts.select("part", "counts", group.alias("group")).repartition(parts * groups, "part", "group")
    return near.select("part", "counts").mapInArrow(_add, KIND).repartition(parts, "part").mapInArrow(last, kind)
