"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. The
word n-grams of the benchmark items are looked up in every whole document.
A first pass counts in how many documents each of them occurs; an item's
rare n-grams are those no more than ``rarity`` times as frequent as its
median one. A second pass aligns each passage around hits with the item
(Smith-Waterman on words: match 2, mismatch and gap -1). A passage with a
rare n-gram is always aligned. One with only common n-grams is aligned
unless a bound from its words shows that no alignment can be accepted, so
that common turns of phrase seldom start a search and ``rarity`` decides
the work, never the result. The score is the best alignment's, divided by
that of an exact copy; ``threshold`` accepts copies with about a third of
their words replaced, as long as one run of ``n`` words of the item is left.

The n-grams of the test set travel to the tasks in blocks of items of at
most about ``block_grams`` n-grams; a larger test set takes more passes over
the documents, never a larger broadcast. Passages are aligned where they
stand, so a document's text never moves. An item with fewer than ``n``
words is sought as a whole; one without words matches nothing. Of several
alignments of a passage with an item the first best one counts (ties), and
repeated benchmark rows are one item. Null texts count as empty, very long ones
are scanned whole. Rows with equal ids are scanned one by one. Other columns
are ignored, whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb

N = 3
RARITY = 4.0
THRESHOLD = 0.5
BLOCK_GRAMS = 1_000_000
FILTER_BITS = 22

MATCH, MISMATCH, GAP = 2, 1, 1


def word_hashes(data: np.ndarray, off: np.ndarray):
    data = tb.LOWER[data]
    start, end, row = tb.words(data, off, tb.ALNUM)
    return tb.mix(tb.PrefixHash(data).ranges(start, end)), row


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the passage position of its end."""
    m = len(passage)
    step = GAP * np.arange(m + 1, dtype=np.int64)
    prev = np.zeros(m + 1, np.int64)
    best, at = 0, 0
    for w in item:
        cur = np.zeros(m + 1, np.int64)
        cur[1:] = np.maximum(prev[:-1] + np.where(passage == w, MATCH, -MISMATCH), prev[1:] - GAP)
        np.maximum(cur, 0, out=cur)
        cur = np.maximum.accumulate(cur + step) - step  # gaps along the passage
        i = int(cur.argmax())
        if cur[i] > best:
            best, at = int(cur[i]), i
        prev = cur
    return best, at


class Items:
    """A bounded block of test items, as arrays that tasks search."""

    def __init__(self, ids: pa.Array, texts: list[str], n: int):
        self.ids = ids
        data, off = tb.buffer_of(pa.array(texts, pa.large_string()))
        hashes, row = word_hashes(data, off)
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        self.words = [hashes[a:b] for a, b in zip(cut[:-1], cut[1:])]
        grams, owner, place = [], [], []
        for i, w in enumerate(self.words):
            size = min(n, len(w))
            if size:
                g = join(w, size)
                grams.append(g)
                owner.append(np.full(len(g), i))
                place.append(np.arange(len(g)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.gram, self.owner, self.place = cat(grams, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.owner, self.place = self.gram[order], self.owner[order], self.place[order]
        self.sizes = sorted({min(n, len(w)) for w in self.words if len(w)})
        self.common = np.zeros(len(self.gram), bool)

    def restrict(self, keep: np.ndarray) -> None:
        self.gram, self.owner, self.place, self.common = self.gram[keep], self.owner[keep], self.place[keep], self.common[keep]

    def bitmap(self) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[(self.gram & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        return bits


def join(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words (the size is part of the hash)."""
    h = np.full(len(words) - size + 1, size, np.uint64) if len(words) >= size else np.zeros(0, np.uint64)
    for i in range(size):
        h = tb.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(h)])
    return h


def hits(items: Items, bits: np.ndarray, words: np.ndarray, row: np.ndarray):
    """Positions of words of a chunk that start an n-gram of the items, and
    the n-gram's first place in ``items.gram``."""
    at, place = [], []
    for size in items.sizes:
        h = join(words, size)
        pos = np.flatnonzero(bits[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        pos = pos[row[pos] == row[pos + size - 1]]
        j = np.searchsorted(items.gram, h[pos])
        j[j == len(items.gram)] = 0
        ok = items.gram[j] == h[pos]
        at.append(pos[ok])
        place.append(j[ok])
    at, place = np.concatenate(at), np.concatenate(place)
    order = np.argsort(at, kind="stable")
    return at[order], place[order]


def reach(item: np.ndarray, passage: np.ndarray) -> int:
    """No alignment of the item with the passage scores more: each word of
    an alignment's span is a match, and then one of the item's words, or
    costs at least 1; no word matches more often than the item has it."""
    total = np.concatenate([[0], np.cumsum(np.where(np.isin(passage, item), MATCH, -min(MISMATCH, GAP)))])
    word, has = np.unique(item, return_counts=True)
    seen, times = np.unique(passage, return_counts=True)
    _, i, j = np.intersect1d(word, seen, assume_unique=True, return_indices=True)
    return min(int((total - np.minimum.accumulate(total)).max()), MATCH * int(np.minimum(has[i], times[j]).sum()))


def align_row(items: Items, words: np.ndarray, at: np.ndarray, place: np.ndarray, threshold: float):
    """(item, score, first word, end word) of the items found in one row."""
    # a gram may belong to several items: expand to (item, position) hits
    count = np.searchsorted(items.gram, items.gram[place], side="right") - place
    which = np.repeat(place, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner, begin, common = items.owner[which], np.repeat(at, count) - items.place[which], items.common[which]
    order = np.lexsort((begin, owner))
    owner, begin, common = owner[order], begin[order], common[order]
    edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
    for s, e in zip(edge[:-1], edge[1:]):
        item = owner[s]
        w = items.words[item]
        # hits whose item would start within an item's length are one passage
        cut = [s, *(s + 1 + np.flatnonzero(np.diff(begin[s:e]) > len(w))), e]
        best = (0.0, 0, 0)
        for i, j in zip(cut[:-1], cut[1:]):
            a = max(0, int(begin[i]) - len(w) // 2)
            b = min(len(words), int(begin[j - 1]) + len(w) + len(w) // 2 + 1)
            if common[i:j].all() and reach(w, words[a:b]) / (MATCH * len(w)) < threshold:
                continue
            score, end = smith_waterman(w, words[a:b])
            if score > best[0]:
                best = (score, max(a, a + end - len(w)), a + end)
        score = best[0] / (MATCH * len(w))
        if score >= threshold:
            yield item, score, best[1], best[2]


def seed_counts(docs: DataFrame, bc) -> dict[int, int]:
    """In how many documents each n-gram of the block occurs; the result
    has at most the block's n-grams."""

    def run(batches):
        items = bc.value
        bits, total = items.bitmap(), np.zeros(len(items.gram), np.int64)
        for batch in batches:
            for _, data, off in tb.chunks_of(tb.column(batch, "text")):
                words, row = word_hashes(data, off)
                if len(words) and len(items.gram):
                    at, place = hits(items, bits, words, row)
                    pair = tb.distinct(row[at] * len(items.gram) + place)
                    total += np.bincount(pair % len(items.gram), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["place", "n"])

    counted = docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    return {r["place"]: r["n"] for r in counted.collect()}


def frequencies(items: Items, counts: dict[int, int]) -> np.ndarray:
    first = np.searchsorted(items.gram, items.gram)  # equal grams share a count
    return np.array([counts.get(int(p), 0) for p in first], dtype=float)


def rare(items: Items, df: np.ndarray, rarity: float) -> np.ndarray:
    """Which n-grams are at most ``rarity`` times as frequent as the median
    one of their item; one sort for all items."""
    order = np.lexsort((df, items.owner))
    ranked = df[order]
    _, start, item, size = np.unique(items.owner[order], return_index=True, return_inverse=True, return_counts=True)
    median = (ranked[start + (size - 1) // 2] + ranked[start + size // 2]) / 2
    keep = np.empty(len(df), bool)
    keep[order] = ranked <= (rarity * np.maximum(1.0, median))[item]
    return keep


def seeded_blocks(docs: DataFrame, tests: DataFrame, n: int, rarity: float, block_grams: int):
    """Broadcasts of the items of each block (id, text) with their n-grams
    that occur in ``docs``; blocks without any are left out."""
    grams = tests.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0  # a word has two characters or more with its gap
    n_blocks = max(1, -(-grams // (2 * block_grams)))
    id_type = tests.limit(0).toArrow().schema.field("id").type
    sc = docs.sparkSession.sparkContext
    for block in range(n_blocks):
        mine = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block).collect()
        mine.sort(key=lambda r: (r["id"] is not None, r["id"], r["text"]))
        items = Items(pa.array([r["id"] for r in mine], id_type), [r["text"] for r in mine], n)
        if not len(items.gram):
            continue
        everything = sc.broadcast(items)
        df = frequencies(items, seed_counts(docs, everything))
        items.common = ~rare(items, df, rarity)
        items.restrict(df > 0)
        everything.unpersist()
        if len(items.gram):
            yield sc.broadcast(items)


def _tests(benchmark: DataFrame, item_id_col: str, item_text_col: str) -> DataFrame:
    # repeated rows are one item, and blocks are dealt by a hash of both columns
    return benchmark.select(F.col(item_id_col).alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = N,
    rarity: float = RARITY,
    threshold: float = THRESHOLD,
    block_grams: int = BLOCK_GRAMS,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document and item found in it: id, row, item_id, score,
    first_word, end_word (of the best passage, in words from 0)."""
    row = F.col(row_col) if row_col else F.lit(0).cast("long")
    docs = documents.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    tests = _tests(benchmark, item_id_col, item_text_col)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, row {docs.schema['row'].dataType.simpleString()}, item_id {tests.schema['id'].dataType.simpleString()}, score double, first_word long, end_word long"
    out = None
    for bc in seeded_blocks(docs, tests, n, rarity, block_grams):
        found = _align(docs, bc, threshold, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return documents.sparkSession.createDataFrame([], schema)
    # equal items (repeated benchmark rows) report once
    return out.groupBy("id", "row", "item_id").agg(
        F.max(F.struct("score", (-F.col("first_word")).alias("back"), "end_word")).alias("b")
    ).select("id", "row", "item_id", F.col("b.score").alias("score"), (-F.col("b.back")).alias("first_word"), F.col("b.end_word").alias("end_word"))


def without_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = N,
    rarity: float = RARITY,
    threshold: float = THRESHOLD,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``documents`` without the rows that hold a copy of an item: each block
    of items is a filter where the rows stand, so no row moves."""
    out = documents
    docs = documents.select(F.col(text_col).alias("text"))
    for bc in seeded_blocks(docs, _tests(benchmark, item_id_col, item_text_col), n, rarity, block_grams):
        out = tb.map_whole(out, _filter(bc, documents.columns.index(text_col), threshold))
    return out


def _filter(bc, text: int, threshold: float):
    def run(batches):
        items = bc.value
        bits = items.bitmap()
        for batch in batches:
            stays = np.ones(batch.num_rows, bool)
            for r, *_ in found_in(items, bits, batch.column(text), threshold):
                stays[r] = False
            yield batch.filter(pa.array(stays))

    return run


def found_in(items: Items, bits: np.ndarray, texts: pa.Array, threshold: float):
    """(row, item, score, first word, end word) of what the texts hold."""
    for base, data, off in tb.chunks_of(texts):
        words, row = word_hashes(data, off)
        if not len(words):
            continue
        at, place = hits(items, bits, words, row)
        cut = np.searchsorted(row, np.arange(len(off)))
        for r in np.unique(row[at]):
            a, b = np.searchsorted(at, [cut[r], cut[r + 1]])
            mine = words[cut[r] : cut[r + 1]]
            for found in align_row(items, mine, at[a:b] - cut[r], place[a:b], threshold):
                yield base + int(r), *found


def _align(docs: DataFrame, bc, threshold: float, schema: str) -> DataFrame:
    def run(batches):
        items = bc.value
        bits = items.bitmap()
        for batch in batches:
            got = list(found_in(items, bits, tb.column(batch, "text"), threshold))
            rows, item, score, first, end = zip(*got) if got else ((),) * 5
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    tb.column(batch, "id").take(take),
                    tb.column(batch, "row").take(take),
                    items.ids.take(pa.array(item, pa.int64())),
                    pa.array(score, pa.float64()),
                    pa.array(first, pa.int64()),
                    pa.array(end, pa.int64()),
                ],
                names=["id", "row", "item_id", "score", "first_word", "end_word"],
            )

    return docs.mapInArrow(run, schema)
