"""N-gram Jaccard join with set-relation skipping, up to components.

A document's set is its distinct hashes of ``size`` consecutive words (A-Z
lower-cased, words are runs of anything but white space; a shorter text has
one shingle of all its words). Two sets link when their Jaccard similarity
is at least ``num / den``, an exact integer comparison. The result is each
document's component under the links; no link between different sets is
lost, and pairs within a group are not all made:

1. Equal sets collapse to one (their 64-bit set hash), first in the tasks.
2. Prefix index: shingles are ordered rare first, by a fixed-size sketch of
   their counts over all documents, then by hash; any order gives the same
   links. Two linked sets share one of their first
   ``n - ceil(n * num / den) + 1`` shingles. The index entries (shingle, set,
   set size, position) travel as packed arrays, in buckets whose number
   grows with the input.
3. Answer skipping: in each list, the set with the smallest position (its
   leader) is verified against the others first. The links found join sets
   into groups; a group's further inner pairs need no answer, and lists of one
   group are done.
4. Index skipping: what is left of a list is sorted by position. A partner's
   size must be within ``num / den`` and what both have left after their
   positions must still reach the overlap needed; beyond that position the
   rest of the list is skipped as a block. Sets that overlap with their leader
   by known amounts are skipped when these leave too little for each other, so
   two families that share a passage and do not link make no pairs. Long lists
   are dealt out by pairs of blocks of about ``LIST_BLOCK`` entries.
5. Of the pairs that are left, those with a verified common partner get
   their overlap's bounds from that partner's overlaps and are settled by
   them where possible; the others are verified.

Verification recomputes both sets from the texts, which are fetched once per
set in need (a fixed-size bitmap keeps the other texts out of the shuffle).

Null, empty and blank texts have the empty set, link with nothing and are
their own component. Ids may repeat; a null id never names a component unless
all ids of it are null. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb
from cairn.llm.components import connected_components
from cairn.llm.sketches import summed_parts
from cairn.session import cut_lineage

SKETCH_BITS = 20
SKETCH_PARTS = 64
BITMAP_BITS = 24
BUCKET_ENTRIES = 400_000
LIST_BLOCK = 2048  # entries of a list that one task compares with as many others
FLUSH_ENTRIES = 1_000_000


def sets_of(data: np.ndarray, off: np.ndarray, size: int):
    """Sorted distinct shingle hashes of every row of a chunk."""
    data = tb.LOWER[data]
    start, end, row = tb.words(data, off, tb.NOT_SPACE)
    h = tb.mix(tb.PrefixHash(data).ranges(start, end))
    s, r = tb.shingles(h, row, len(off) - 1, size)
    cut = np.searchsorted(r, np.arange(len(off)))
    return [tb.distinct(s[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def set_hash(s: np.ndarray) -> np.uint64:
    total = tb.mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64) if len(s) else np.uint64(0)
    return tb.mix(np.array([total], np.uint64) + np.uint64(len(s)))[0]


def needed_overlap(n, m, num: int, den: int):
    """Smallest i with den * i >= num * (n + m - i)."""
    return -(-(num * (n + m)) // (den + num))


def prefix_length(n, num: int, den: int):
    return n - -(-(n * num) // den) + 1


def _batch(names, *arrays):
    return pa.RecordBatch.from_arrays(list(arrays), names=list(names))


def describe(docs: DataFrame, size: int) -> DataFrame:
    """id, n, h of every document; and, as rows with a part number, the
    tasks' counts of hashed shingles."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ("id", "n", "h", "part", "counts")

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            n, h = [], []
            for _, data, off in tb.chunks_of(tb.column(batch, "text")):
                sets = sets_of(data, off, size)
                n += [len(s) for s in sets]
                h += [set_hash(s) for s in sets]
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                np.add(counts, np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)), out=counts)
            k = batch.num_rows
            yield _batch(
                names,
                tb.column(batch, "id"),
                pa.array(n, pa.int64()),
                pa.array(np.array(h, np.uint64).view(np.int64), pa.int64()),
                pa.nulls(k, pa.int32()),
                pa.nulls(k, pa.binary()),
            )
        if id_type is not None:
            parts = counts.astype("<i8").reshape(SKETCH_PARTS, -1)
            k = SKETCH_PARTS
            yield _batch(
                names,
                pa.nulls(k, id_type),
                pa.nulls(k, pa.int64()),
                pa.nulls(k, pa.int64()),
                pa.array(range(k), pa.int32()),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            )

    return docs.mapInArrow(run, f"id {kind}, n long, h long, part int, counts binary")


def rarity_classes(counts: DataFrame) -> np.ndarray:
    """One byte per sketch cell, larger for more frequent shingles; its size
    is fixed (1 MB)."""

    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint8)
    for r in summed_parts(counts, SKETCH_PARTS, _classes, "part int, classes binary").collect():
        out[r["part"]] = np.frombuffer(bytes(r["classes"]), np.uint8)
    return out.reshape(-1)


def _classes(batches):
    for batch in batches:
        sums = [np.frombuffer(x.as_py(), "<i8") for x in tb.column(batch, "counts")]
        classes = [np.minimum(255, 8 * np.log2(1 + x)).astype(np.uint8).tobytes() for x in sums]
        yield _batch(("part", "classes"), tb.column(batch, "part"), pa.array(classes, pa.binary()))


ENTRY = np.dtype([("token", "<u8"), ("h", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def index_entries(docs: DataFrame, bc, size: int, num: int, den: int, n_buckets: int) -> DataFrame:
    """Packed prefix entries per bucket of shingles."""

    def run(batches):
        classes = bc.value
        seen: set[int] = set()
        held, count = [], 0

        def flush():
            e = np.concatenate(held)
            bucket = (tb.mix(e["token"]) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            # columns apart, which compresses better than records
            blobs = [b"".join(np.ascontiguousarray(part[f]).tobytes() for f in ENTRY.names) for part in np.split(e, first[1:])]
            return _batch(("bucket", "entries"), pa.array(bucket[first], pa.int64()), pa.array(blobs, pa.binary()))

        for batch in batches:
            for _, data, off in tb.chunks_of(tb.column(batch, "text")):
                for s in sets_of(data, off, size):
                    if not len(s):
                        continue
                    h = int(set_hash(s).view(np.int64))
                    if h in seen:
                        continue  # an equal set of this task is indexed
                    if len(seen) < 2_000_000:  # a bound for memory; repeats collapse later too
                        seen.add(h)
                    order = np.lexsort((s, classes[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                    p = prefix_length(len(s), num, den)
                    e = np.empty(p, ENTRY)
                    e["token"], e["h"], e["n"], e["pos"] = s[order[:p]], h, len(s), np.arange(p)
                    held.append(e)
                    count += p
            if count >= FLUSH_ENTRIES:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "bucket long, entries binary")


def unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // ENTRY.itemsize
    out, at = np.empty(n, ENTRY), 0
    for f in ENTRY.names:
        t = ENTRY[f]
        out[f] = np.frombuffer(blob, t, n, at)
        at += n * t.itemsize
    return out


def shared_lists(packed: DataFrame, n_buckets: int) -> DataFrame:
    """Index entries whose shingle at least two different sets have."""

    def run(batches):
        # one partition holds few buckets; each is handled when complete
        buckets: dict[int, list[bytes]] = {}
        for batch in batches:
            for b, blob in zip(tb.column(batch, "bucket").to_pylist(), tb.column(batch, "entries")):
                buckets.setdefault(b, []).append(unpack(blob.as_py()))
        for b in list(buckets):
            e = np.concatenate(buckets.pop(b))
            e = e[np.lexsort((e["h"], e["pos"], e["token"]))]
            # equal sets have equal positions: their entries are neighbours
            same = (e["token"][1:] == e["token"][:-1]) & (e["h"][1:] == e["h"][:-1])
            e = e[np.concatenate([[True], ~same])] if len(e) else e
            again = e["token"][1:] == e["token"][:-1]
            keep = np.concatenate([[False], again]) | np.concatenate([again, [False]])
            e = e[keep]
            yield _batch(
                ("token", "h", "n", "pos"),
                pa.array(e["token"].view(np.int64), pa.int64()),
                pa.array(e["h"], pa.int64()),
                pa.array(e["n"], pa.int32()),
                pa.array(e["pos"], pa.int32()),
            )

    return packed.repartition(n_buckets, "bucket").mapInArrow(run, "token long, h long, n int, pos int")


def may_link(n, i, m, j, num: int, den: int):
    """Size filter and position filter of the pair of entries."""
    need = needed_overlap(n, m, num, den)
    return (den * np.minimum(n, m) >= num * np.maximum(n, m)) & (np.minimum(n - i, m - j) >= need)


def _pairs_batch(a, b):
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    if len(lo):
        order = np.lexsort((hi, lo))
        lo, hi = lo[order], hi[order]
        new = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        lo, hi = lo[new], hi[new]
    return _batch(("a", "b"), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()))


def _need(num: int, den: int) -> str:
    """``needed_overlap`` of columns n and m."""
    return f"(({num} * (n + m) + {den + num - 1}) div {den + num})"


def leaders_of(lists: DataFrame) -> DataFrame:
    """token, lead, m, j: each list's set with the smallest position."""
    first = lists.groupBy("token").agg(F.min(F.struct("pos", "h", "n")).alias("f"))
    return first.select("token", F.col("f.h").alias("lead"), F.col("f.n").cast("long").alias("m"), F.col("f.pos").alias("j"))


def leader_pairs(lists: DataFrame, leaders: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs of each list's leader with its others."""
    both = lists.withColumn("n", F.col("n").cast("long")).join(leaders, "token").where("h <> lead")
    both = both.where(f"{den} * least(n, m) >= {num} * greatest(n, m) AND least(n - pos, m - j) >= {_need(num, den)}")
    return both.select(F.least("h", "lead").alias("a"), F.greatest("h", "lead").alias("b")).distinct()


def list_blocks(placed: DataFrame) -> DataFrame:
    """Entries of a list of ``k`` blocks, once for each pair of blocks (lo,
    hi) that their own is part of. Most lists are one block."""
    cut = placed.withColumn("own", F.pmod(F.xxhash64("h"), F.col("k")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return cut.select("token", "h", "n", "pos", "root", "known", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def _block_pairs(c: dict, num: int, den: int):
    """(a, b) arrays: sets of different groups of one pair of blocks that may
    link, by size, position and what their leader's overlaps allow."""
    n, pos, h, root, known = (c[x] for x in ("n", "pos", "h", "root", "known"))
    one = c["own"] == c["lo"]
    inner = c["lo"][0] == c["hi"][0]
    left = np.flatnonzero(one)
    right = left if inner else np.flatnonzero(~one)
    for at, k in enumerate(left):
        # a set must itself have enough left; later positions have less
        if n[k] - pos[k] < -(-n[k] * num // den):
            continue  # fewer left than its smallest partner needs
        # positions ascend: past this one, even the longest admissible
        # partner has too little left, so the block is skipped
        last = int(np.searchsorted(pos[right], n[k] * den // num - needed_overlap(n[k], -(-n[k] * num // den), num, den), side="right"))
        r = right[at + 1 if inner else 0 : last]
        r = r[(root[r] != root[k]) & may_link(n[k], pos[k], n[r], pos[r], num, den)]
        if known[k] >= 0 and len(r):
            # both overlap with the list's leader by known amounts
            high = np.minimum(known[r] + n[k] - known[k], known[k] + n[r] - known[r])
            r = r[(known[r] < 0) | (high >= needed_overlap(n[k], n[r], num, den))]
        if len(r):
            yield np.full(len(r), h[k]), h[r]


def cross_pairs(placed: DataFrame, n_buckets: int, num: int, den: int) -> DataFrame:
    """Candidate pairs of sets of different groups within each list. A list
    is dealt out by pairs of its blocks, so a frequent shingle is many tasks'
    work and none holds more than two blocks of it at a time."""

    def run(batches):
        got = [pa.Table.from_batches([b]) for b in batches]
        if not got:
            return
        t = pa.concat_tables(got)
        cols = {x: t.column(x).to_numpy() for x in t.column_names}
        order = np.lexsort((cols["h"], cols["pos"], cols["hi"], cols["lo"], cols["token"]))
        cols = {x: v[order] for x, v in cols.items()}
        new = (cols["token"][1:] != cols["token"][:-1]) | (cols["lo"][1:] != cols["lo"][:-1]) | (cols["hi"][1:] != cols["hi"][:-1])
        edge = np.flatnonzero(np.concatenate([[True], new, [True]]))
        out, held = [], 0
        for s, e in zip(edge[:-1], edge[1:]):
            part = {x: v[s:e] for x, v in cols.items()}
            if (part["root"] == part["root"][0]).all():
                continue
            for pair in _block_pairs(part, num, den):
                out.append(pair)
                held += len(pair[0])
                if held > 2_000_000:
                    yield _pairs_batch(*(np.concatenate(x) for x in zip(*out)))
                    out, held = [], 0
        if held:
            yield _pairs_batch(*(np.concatenate(x) for x in zip(*out)))

    blocks = list_blocks(placed).withColumn("n", F.col("n").cast("long")).withColumn("pos", F.col("pos").cast("long"))
    return blocks.repartition(n_buckets, "token", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def texts_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """One text (h, text) of every set in ``wanted`` (h)."""
    cells = (
        wanted.select(F.expr(f"(h & {(1 << BITMAP_BITS) - 1})").alias("bit"))
        .groupBy(F.expr("shiftright(bit, 6)").alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .collect()
    )  # at most 2**(BITMAP_BITS - 6) rows
    words = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in cells:
        words[r["cell"]] = r["bits"]
    bc = docs.sparkSession.sparkContext.broadcast(np.unpackbits(words.view(np.uint8), bitorder="little").view(bool))

    def run(batches):
        bits, seen = bc.value, set()
        for batch in batches:
            at, hs = [], []
            for first, data, off in tb.chunks_of(tb.column(batch, "text")):
                for i, s in enumerate(sets_of(data, off, size)):
                    if not len(s):
                        continue
                    h = int(set_hash(s).view(np.int64))
                    if bits[h & ((1 << BITMAP_BITS) - 1)] and h not in seen:
                        if len(seen) < 2_000_000:
                            seen.add(h)
                        at.append(first + i)
                        hs.append(h)
            yield _batch(("h", "text"), pa.array(hs, pa.int64()), tb.column(batch, "text").take(pa.array(at, pa.int64())))

    some = docs.select("text").mapInArrow(run, "h long, text string")
    return cut_lineage(some.join(wanted, "h", "left_semi").dropDuplicates(["h"]), "jaccard_texts")


def verify(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """a, b, n, m, overlap of the pairs, from the whole texts."""
    left = texts.select(F.col("h").alias("a"), F.col("text").alias("s"))
    right = texts.select(F.col("h").alias("b"), F.col("text").alias("t"))

    def run(batches):
        for batch in batches:
            sides = []
            for name in ("s", "t"):
                sides.append([x for _, data, off in tb.chunks_of(tb.column(batch, name)) for x in sets_of(data, off, size)])
            n, m = [len(x) for x in sides[0]], [len(x) for x in sides[1]]
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)]
            longs = [pa.array(x, pa.int64()) for x in (n, m, common)]
            yield _batch(("a", "b", "n", "m", "overlap"), tb.column(batch, "a"), tb.column(batch, "b"), *longs)

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t")
    return joined.mapInArrow(run, "a long, b long, n long, m long, overlap long")


def settle(pairs: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """Bounds of the overlap of a pair (x, y) from sets L verified against
    both: |L & y| - |L - x| <= |x & y| <= |L & y| + |x - L|, and the same
    with x and y exchanged. a, b, n, m, low, high; low 0 and high null where
    no such set is known."""
    sides = known.select(F.col("a").alias("via"), F.col("b").alias("x"), F.col("n").alias("l"), F.col("m").alias("k"), "overlap")
    sides = sides.unionByName(
        known.select(F.col("b").alias("via"), F.col("a").alias("x"), F.col("m").alias("l"), F.col("n").alias("k"), "overlap")
    )
    x = sides.select(F.col("x").alias("a"), "via", F.col("l"), F.col("k").alias("n"), F.col("overlap").alias("oa"))
    y = sides.select(F.col("x").alias("b"), "via", F.col("k").alias("m"), F.col("overlap").alias("ob"))
    bounds = (
        pairs.join(x, "a")
        .join(y, ["b", "via"])
        .groupBy("a", "b", "n", "m")
        .agg(
            F.max(F.greatest(F.col("ob") - (F.col("l") - F.col("oa")), F.col("oa") - (F.col("l") - F.col("ob")))).alias("low"),
            F.min(F.least(F.col("ob") + F.col("n") - F.col("oa"), F.col("oa") + F.col("m") - F.col("ob"))).alias("high"),
        )
    )
    return pairs.join(bounds, ["a", "b"], "left")


def _linked(frame: DataFrame, overlap: str, num: int, den: int) -> DataFrame:
    o = F.col(overlap)
    return frame.where(o * den >= (F.col("n") + F.col("m") - o) * num)


def find_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 80, den: int = 100, block: int = LIST_BLOCK
) -> DataFrame:
    """id, n_shingles, h (set hash), component_id of every document; the
    component's id is its smallest document id. ``block`` bears on the way
    work is dealt, never on the result."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    described = cut_lineage(describe(docs, size), "jaccard_sets")
    info = described.where("part is null").select("id", "n", "h")
    total = info.agg(F.sum(F.col("n") * (den - num) / den + 1)).first()[0] or 0
    n_buckets = max(8, int(total // BUCKET_ENTRIES) + 1)
    sc = documents.sparkSession.sparkContext
    classes = sc.broadcast(rarity_classes(described.where("part is not null").select("part", "counts")))
    lists = cut_lineage(shared_lists(index_entries(docs, classes, size, num, den, n_buckets), n_buckets), "jaccard_lists")

    leaders = cut_lineage(leaders_of(lists), "jaccard_firsts")
    first = cut_lineage(leader_pairs(lists, leaders, num, den), "jaccard_leaders")
    texts = texts_of(docs, lists.select("h").distinct(), size)
    known = cut_lineage(verify(first, texts, size), "jaccard_known")
    links = _linked(known, "overlap", num, den).select("a", "b")
    groups = connected_components(links)

    root = groups.select(F.col("node").alias("h"), "root")
    placed = lists.join(root, "h", "left").withColumn("root", F.coalesce("root", "h"))
    # lists with sets of more than one group, their blocks and leaders
    spread = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("k"))
    spread = spread.where("lo < hi").select("token", "k").join(leaders.select("token", "lead", F.col("m").alias("lead_n")), "token")
    placed = placed.join(spread, "token")
    # what is known of an entry's overlap with its list's leader, else -1
    sides = known.select("a", "b", "overlap")
    placed = placed.withColumn("a", F.least("h", "lead")).withColumn("b", F.greatest("h", "lead")).join(sides, ["a", "b"], "left")
    placed = placed.withColumn("known", F.when(F.col("h") == F.col("lead"), F.col("lead_n")).otherwise(F.coalesce("overlap", F.lit(-1))).cast("long"))
    placed = cut_lineage(placed.select("token", "h", "n", "pos", "root", "known", "k"), "jaccard_open")
    rest = cross_pairs(placed, n_buckets, num, den).join(known.select("a", "b"), ["a", "b"], "left_anti")
    rest = cut_lineage(settle(cut_lineage(rest, "jaccard_rest"), known, num, den), "jaccard_bounds")
    certain = _linked(rest, "low", num, den).select("a", "b")
    need = F.expr(f"ceil(({num} * (n + m)) / {den + num})")
    doubtful = rest.where(F.col("high").isNull() | ((F.col("high") >= need) & ~(F.col("low") >= need))).select("a", "b")
    more = cut_lineage(verify(doubtful, texts, size), "jaccard_more")
    links = links.unionByName(certain).unionByName(_linked(more, "overlap", num, den).select("a", "b"))
    final = connected_components(links)

    per_set = info.where("n > 0").groupBy("h").agg(F.min("id").alias("low"))
    per_set = per_set.join(final.select(F.col("node").alias("h"), "root"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    named = per_set.join(per_set.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("h", "component_id")
    named = cut_lineage(named, "jaccard_named")
    out = info.join(named, "h", "left")
    return out.select("id", F.col("n").alias("n_shingles"), "h", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
