"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, of their first
bytes (two stem lengths), of neighbouring word pairs and of pairs that skip
one word, folded into ``2**bits`` coordinates. Words are runs of 0-9, a-z
(A-Z lower-cased) and non-ASCII characters. Training keeps per-coordinate
rates (FTRL-proximal) and an L1 term that leaves most weights at exactly
zero, so the model is a short list of (coordinate, weight) that is small
enough to broadcast: at most ``2**bits`` entries at any input size.

Fitting reads at most ``max_rows`` labelled rows, those with the smallest
hash of their id; scoring reads every whole text.

Null and empty texts have no features and score the intercept. Rows with a
null label are not learnt from; of several labels of one id the largest
counts. Null ids are scored but never matched with labels. An empty label
table gives a constant score of 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from cairn.llm import textbuf as tb
from cairn.llm.samples import bounded_sample

BITS = 22
MAX_ROWS = 20_000  # bound of the labelled rows that are fitted
STEMS = (4, 7)  # bytes of a word that count as its stem


@dataclass(frozen=True)
class Model:
    index: np.ndarray  # sorted coordinates with a weight other than 0
    weight: np.ndarray
    bias: float
    bits: int = BITS


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """Row and coordinate of every feature occurrence of a chunk of texts."""
    data = tb.LOWER[data]
    start, end, row = tb.words(data, offsets, tb.ALNUM)
    ph = tb.PrefixHash(data)
    whole = tb.mix(ph.ranges(start, end))
    mask = np.uint64((1 << bits) - 1)
    rows, feats = [row], [whole & mask]
    for k in STEMS:
        long = end - start > k
        stem = tb.mix(ph.ranges(start[long], start[long] + k) + np.uint64(k * 7919))
        rows.append(row[long])
        feats.append(stem & mask)
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        if len(row) > gap:
            same = row[:-gap] == row[gap:]
            pair = tb.mix(whole[:-gap] * np.uint64(0x9E3779B97F4A7C15) + whole[gap:] + np.uint64(salt))
            rows.append(row[:-gap][same])
            feats.append(pair[same] & mask)
    return np.concatenate(rows), np.concatenate(feats).astype(np.int64)


def ftrl(
    examples: list[np.ndarray],
    labels: np.ndarray,
    bits: int = BITS,
    epochs: int = 3,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 4.0,
    l2: float = 1.0,
) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over binary features; coordinate ``2**bits`` is the
    intercept, which is not shrunk. Returns (index, weight, bias)."""
    z = np.zeros((1 << bits) + 1)
    n = np.zeros((1 << bits) + 1)
    last = 1 << bits

    def weights(idx):
        zi, ni = z[idx], n[idx]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        if len(idx) and idx[-1] == last:
            w[-1] = -zi[-1] / ((beta + np.sqrt(ni[-1])) / alpha)
        return w

    for _ in range(epochs):
        for x, y in zip(examples, labels):
            idx = np.append(x, last)
            w = weights(idx)
            p = 1.0 / (1.0 + np.exp(-min(max(w.sum(), -35.0), 35.0)))
            g = p - y
            if g == 0.0:
                continue
            sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / alpha
            z[idx] += g - sigma * w
            n[idx] += g * g
    touched = np.flatnonzero(n[:last])
    w = weights(np.append(touched, last))
    keep = w[:-1] != 0.0
    return touched[keep], w[:-1][keep], float(w[-1])


def fit(
    labelled: DataFrame, id_col: str, text_col: str, label_col: str, bits: int = BITS, **ftrl_options
) -> Model:
    """Fit on a bounded frame of labelled rows (one row per id).

    The texts are hashed by many tasks; one task runs the sequential
    passes over the hashed rows, whose number the caller has bounded.
    """
    rows = labelled.select(
        F.xxhash64(F.col(id_col)).alias("k"), F.col(label_col).cast("int").alias("y"), F.col(text_col).alias("t")
    )

    def hash_rows(batches):
        for batch in batches:
            keys, ys, blobs = tb.column(batch, "k"), tb.column(batch, "y"), []
            for _, data, off in tb.chunks_of(tb.column(batch, "t")):
                row, feat = features(data, off, bits)
                pair = tb.distinct((row << bits) | feat)
                cut = np.searchsorted(pair >> bits, np.arange(len(off)))
                low = (pair & ((1 << bits) - 1)).astype(np.int32)
                blobs += [low[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([keys, ys, pa.array(blobs, pa.binary())], names=["k", "y", "f"])

    def train(batches):
        got = [(k, y, f) for b in batches for k, y, f in zip(*(c.to_pylist() for c in b.columns))]
        got.sort(key=lambda r: r[0])
        if not got or len({y for _, y, _ in got}) < 2:
            # one class only: a constant close to it
            bias = 35.0 if got and got[0][1] else -35.0
            index, weight = np.zeros(0, np.int64), np.zeros(0)
        else:
            x = [np.frombuffer(f, np.int32) for _, _, f in got]  # no copy: all rows' features are in memory once
            index, weight, bias = ftrl(x, np.array([y for _, y, _ in got]), bits, **ftrl_options)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([index.astype(np.int32).tobytes()], pa.binary()),
                pa.array([weight.astype(np.float64).tobytes()], pa.binary()),
                pa.array([bias], pa.float64()),
            ],
            names=["i", "w", "b"],
        )

    hashed = rows.mapInArrow(hash_rows, "k long, y int, f binary")
    got = hashed.repartition(1).mapInArrow(train, "i binary, w binary, b double").first()
    if got is None:
        return Model(np.zeros(0, np.int64), np.zeros(0), -35.0, bits)
    return Model(
        np.frombuffer(bytes(got["i"]), np.int32).astype(np.int64), np.frombuffer(bytes(got["w"]), np.float64), got["b"], bits
    )


def training_rows(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    where=None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """At most ``max_rows`` labelled documents: the ids are chosen from the
    labels alone, so the broadcast side has at most ``max_rows`` rows. Of
    several texts of one id the greatest is learnt from."""
    ids = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if where is not None:
        ids = ids.where(where)
    ids = ids.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__label"))
    ids = bounded_sample(ids, ["__id"], max_rows)
    docs = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    found = docs.join(F.broadcast(ids), "__id")
    return found.groupBy("__id").agg(F.max("__text").alias("__text"), F.max("__label").alias("__label"))


def score(documents: DataFrame, text_col: str, model: Model, score_col: str = "score") -> DataFrame:
    """``documents`` plus ``score_col`` in 0 to 1 (replaces a column of that
    name). One pass, no shuffle; the sparse weights travel with the tasks."""
    bc = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.drop(score_col)
    text = docs.columns.index(text_col)

    def run(batches):
        m = bc.value
        dense = np.zeros(1 << m.bits, dtype=np.float32)
        dense[m.index] = m.weight
        for batch in batches:
            out = np.full(batch.num_rows, m.bias)
            for first, data, off in tb.chunks_of(batch.column(text)):
                row, feat = features(data, off, m.bits)
                w = dense[feat]
                hit = np.flatnonzero(w)
                pair = tb.distinct((row[hit] << m.bits) | feat[hit])
                total = np.bincount(pair >> m.bits, weights=dense[pair & ((1 << m.bits) - 1)], minlength=len(off) - 1)
                out[first : first + len(off) - 1] += total
            out = 1.0 / (1.0 + np.exp(-np.clip(out, -35.0, 35.0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, score_col])

    return tb.map_whole(docs, run, (StructField(score_col, DoubleType()),))
