"""Removal of repeated substrings by a hash-compared suffix sort.

Every byte that is covered by a ``length``-byte string which also starts
earlier (in a document of smaller id, or before in the same one) is removed;
strings are judged on the input and never cross documents.

A full suffix array of the corpus would be one global sort. Here the sort is
sparse: equal strings have an equal smallest ``GRAM``-byte substring (by
hash, the leftmost of ties) at the same place. Windows that follow each other
and share it form a run, a string of its own, named by that substring.

1. Runs (substring hash, run hash, place) meet in buckets by substring hash.
   Of equal runs the earliest stays and the others are covered; repeats within
   a task are settled there and never meet. Most substrings have one run and
   are done. A sketch of fixed size counts the runs by substring first: where
   very many differ around frequent substrings (a phrase in a third of all
   documents), the runs are taken apart into single windows. These meet in
   buckets by their own hash and need none of the steps 2 and 3.
2. Runs that differ but share the substring are fetched from the texts. Their
   windows part by the side on which they reach further, and meet those with
   the same ``CORE`` bytes around the substring.
3. In such a group the suffixes at the core are sorted by merging, and so are
   the reversed prefixes. Two suffixes are compared by their longest common
   extension, found by binary search over prefix polynomial hashes, and the
   byte after it. Neighbours' extensions are then verified byte by byte; a
   hash collision splits them. Two windows that reach d bytes left of the core
   are equal when their runs' left extension is d or more and the right one is
   what is left of ``length``; the earliest of equal windows stays.
4. Texts drop their covered bytes.

Work travels in packed arrays by bucket; the number of buckets grows with
the input. Equal runs are merged in the tasks before they meet, so copies
of a document or passage, however many, do not meet in one task. Different
runs around one substring meet in one bucket up to ``HOT`` of them and twice
the sketch's average. Texts are numbered in a written table, so that each
pass sees the same numbers however the executors change in between.

Null texts count as empty; texts shorter than ``length`` lose nothing. Ids
are integers; a null id is smaller than any other, and rows with equal ids
count as documents in row order. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb
from cairn.llm.sketches import KIND, summed_parts
from cairn.session import cut_lineage

LENGTH = 100
GRAM = 32
SIDE = (LENGTH - GRAM) // 2  # bytes beside the substring that part groups
CORE = GRAM + SIDE
BUCKET_BYTES = 4 << 20  # text per bucket of documents
RUN_BYTES = 8 << 20  # text per bucket of runs
SEGMENT = 8 << 20  # a longer text is cut into overlapping segments
FLUSH = 400_000
SKETCH_BITS = 20  # cells that count runs by substring
SKETCH_PARTS = 64
HOT = 50_000  # runs of a cell, beyond twice the average, that are taken apart

# done: settled in its task (SETTLED), a window of a frequent substring (WINDOW), else 0
SETTLED, WINDOW = 1, 2
RUN = np.dtype([("gram", "<u8"), ("run", "<u8"), ("id", "<i8"), ("row", "<i8"), ("start", "<i8"), ("n", "<i2"), ("at", "<i2"), ("done", "<i2")])
SPOT = np.dtype([("id", "<i8"), ("row", "<i8"), ("start", "<i8"), ("n", "<i8"), ("at", "<i8")])


def pack(a: np.ndarray) -> bytes:
    """Columns apart and byte planes apart, which compresses well."""
    return b"".join(np.ascontiguousarray(a[f]).view(np.uint8).reshape(len(a), -1).T.tobytes() for f in a.dtype.names)


def unpack(blob: bytes, kind: np.dtype) -> np.ndarray:
    n = len(blob) // kind.itemsize
    out, at = np.empty(n, kind), 0
    for f in kind.names:
        size = kind[f].itemsize
        planes = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n)
        out[f] = np.ascontiguousarray(planes.T).view(kind[f]).reshape(n)
        at += n * size
    return out


def _split(bucket: np.ndarray, *arrays):
    """(bucket, parts) for each bucket present."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    cuts = np.append(first, len(bucket))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[a]), [x[order[a:b]] for x in arrays]


def home(row: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a document; ``row_bucket`` is the same as a column."""
    return (row ^ (row >> 33)) % n


def row_bucket(row, n: int):
    return row.bitwiseXOR(F.shiftright(row, 33)) % F.lit(n)


def cell_of(gram: np.ndarray) -> np.ndarray:
    return (gram >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def runs_of(data: np.ndarray, off: np.ndarray, hot: np.ndarray | None = None):
    """Row, start (in the chunk), windows, place of the substring, its hash
    and the run's hash of every run of a chunk. Runs around substrings of the
    cells ``hot`` are taken apart into windows."""
    n = len(data)
    if n < LENGTH:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    ph = tb.PrefixHash(data)
    g = np.arange(n - GRAM + 1)
    gram = tb.mix(ph.ranges(g, g + GRAM))
    key = (gram & ~np.uint64(0xFFFFFF)) | g.astype(np.uint64)
    span = LENGTH - GRAM + 1
    low, width = key, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: n - LENGTH + 1], low[span - width : span - width + n - LENGTH + 1])
    place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    ok = np.zeros(n - LENGTH + 2, np.int32)
    big = np.flatnonzero(np.diff(off) >= LENGTH)
    ok[off[big]] += 1
    ok[off[big + 1] - LENGTH + 1] -= 1
    ok = np.cumsum(ok[:-1]) > 0
    begins = ok.copy()
    begins[1:] &= ~ok[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(begins)
    ends = ok.copy()
    ends[:-1] &= ~ok[1:] | begins[1:]
    count = np.flatnonzero(ends) + 1 - start
    row = np.searchsorted(off, start, side="right") - 1
    at = place[start]
    if hot is not None and hot[cell_of(gram[at])].any():
        apart = hot[cell_of(gram[at])]
        times = np.where(apart, count, 1)
        which = np.repeat(np.arange(len(start)), times)
        step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        row, at, start = row[which], at[which], start[which] + step
        count = np.where(apart, 1, count)[which]
    whole = tb.mix(ph.ranges(start, start + count + LENGTH - 1) + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return row, start, count, at, gram[at], whole


def _chunks(batch):
    """(ids, rows, first bytes' offset in the text, bytes, offsets) of
    chunks; a very long text comes in segments that overlap."""
    ids = tb.column(batch, "id").fill_null(-(1 << 63)).to_numpy()
    rows = tb.column(batch, "row").to_numpy()
    for first, data, off in tb.chunks_of(tb.column(batch, "text")):
        if len(off) == 2 and len(data) > SEGMENT + LENGTH:
            for a in range(0, len(data) - LENGTH + 1, SEGMENT):
                part = data[a : a + SEGMENT + LENGTH - 1]
                yield ids[first : first + 1], rows[first : first + 1], a, part, np.array([0, len(part)])
        else:
            k = len(off) - 1
            yield ids[first : first + k], rows[first : first + k], 0, data, off


def _packed(bucket, blobs):
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def hot_cells(docs: DataFrame, hot: int = HOT) -> np.ndarray:
    """Cells of the sketch with more than ``hot`` runs beyond twice the
    average, counting equal runs of a task's chunk once."""

    def count(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, _, data, off in _chunks(batch):
                gram, whole = runs_of(data, off)[4:]
                np.add.at(counts, cell_of(gram[np.unique(whole, return_index=True)[1]]), 1)
        parts = counts.astype("<i8").reshape(SKETCH_PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    counted = cut_lineage(docs.mapInArrow(count, KIND), "suffix_sketch")
    total = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for r in summed_parts(counted, SKETCH_PARTS).collect():
        total[r["part"]] = np.frombuffer(bytes(r["counts"]), "<i8")
    return total.reshape(-1) > 2 * total.mean() + hot


def find_runs(docs: DataFrame, n_buckets: int, hot) -> DataFrame:
    """Packed runs by bucket; ``hot`` is the broadcast of ``hot_cells``."""

    def bucket_of(e):
        # by substring; windows by their own hash; what is settled only passes
        # through and is spread by its row
        key = np.where(e["done"] == WINDOW, tb.mix(e["gram"] + tb.mix(e["run"])), e["gram"])
        key = np.where(e["done"] == SETTLED, tb.mix(e["row"].view(np.uint64)), key)
        return (key % np.uint64(n_buckets)).astype(np.int64)

    def flush(held):
        e = np.concatenate(held)
        e = e[np.lexsort((e["start"], e["row"], e["id"], e["run"], e["gram"]))]
        # a later equal run of this task is covered; it needs no comparison
        e["done"][1:][(e["gram"][1:] == e["gram"][:-1]) & (e["run"][1:] == e["run"][:-1])] = SETTLED
        e = e[np.lexsort((e["start"], e["row"], bucket_of(e)))]
        parts = [(b, pack(x)) for b, (x,) in _split(bucket_of(e), e)]
        return _packed([b for b, _ in parts], [x for _, x in parts])

    def run(batches):
        held, count = [], 0
        cells = hot.value if hot.value.any() else None
        for batch in batches:
            for ids, rows, base, data, off in _chunks(batch):
                row, start, n, at, gram, whole = runs_of(data, off, cells)
                e = np.zeros(len(row), RUN)
                e["gram"], e["run"], e["id"], e["row"] = gram, whole, ids[row], rows[row]
                e["start"], e["n"], e["at"] = start - off[row] + base, n, at - start
                if cells is not None:
                    e["done"][cells[cell_of(gram)]] = WINDOW
                held.append(e)
                count += len(e)
                if count >= FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if count:
            yield flush(held)

    return docs.mapInArrow(run, "bucket long, blob binary")


def _spots(kind: str, e: np.ndarray, n_homes: int):
    spots = np.zeros(len(e), SPOT)
    for f in SPOT.names:
        spots[f] = e[f]
    for b, (x,) in _split(home(spots["row"], n_homes), spots):
        yield kind, b, pack(x)


def _spot_batch(rows):
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
        names=["kind", "home", "blob"],
    )


def _gather(batches, kind):
    """Arrays of each bucket of a partition."""
    got: dict[int, list] = {}
    for batch in batches:
        for b, blob in zip(tb.column(batch, "bucket").to_pylist(), tb.column(batch, "blob")):
            got.setdefault(b, []).append(blob.as_py())  # packed until its turn
    for b in list(got):
        yield b, [unpack(x, kind) if kind is not None else x for x in got.pop(b)]


def settle_runs(runs: DataFrame, n_buckets: int, n_homes: int) -> DataFrame:
    """Places of covered runs, and of first runs that share a substring."""

    def run(batches):
        for _, parts in _gather(batches, RUN):
            e = np.concatenate(parts)
            done, e = e[e["done"] == SETTLED], e[e["done"] != SETTLED]
            e = e[np.lexsort((e["start"], e["row"], e["id"], e["run"], e["gram"]))]
            first = np.ones(len(e), bool)
            same = e["gram"][1:] == e["gram"][:-1]
            first[1:] = ~(same & (e["run"][1:] == e["run"][:-1]))
            later, e = e[~first], e[first]
            same = e["gram"][1:] == e["gram"][:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(e) else np.zeros(0, bool)
            shared &= e["done"] != WINDOW
            yield _spot_batch([*_spots("covered", done, n_homes), *_spots("covered", later, n_homes), *_spots("shared", e[shared], n_homes)])

    return runs.repartition(n_buckets, "bucket").mapInArrow(run, "kind string, home long, blob binary")


def _doc_places(docs: pa.Table):
    """Bytes, offsets and the order of rows of a bucket's documents."""
    docs = docs.combine_chunks()
    text = docs.column("text")
    text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
    data, off = tb.buffer_of(text)
    rows = docs.column("row").to_numpy()
    return data, off, rows




def fetch_shared(texts: DataFrame, spots: DataFrame, n_buckets: int) -> DataFrame:
    """The strings of shared runs, by side, in buckets by their core."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        data, off, rows = _doc_places(left)
        out = {"bucket": [], "blob": []}
        if right.num_rows and len(rows):
            e = np.concatenate([unpack(x.as_py(), SPOT) for x in right.column("blob").combine_chunks()])
            order = np.argsort(rows)
            doc = order[np.searchsorted(rows[order], e["row"])]
            base = off[doc]
            anchor = base + e["start"] + e["at"]
            first, last = base + e["start"], base + e["start"] + e["n"] - 1  # first and last window
            # windows that reach SIDE bytes right of the substring, and the others
            turn = np.clip(anchor + CORE - LENGTH, first, last + 1)
            keys, strings = [], []
            for right_side, a, b in ((0, first, turn - 1), (1, turn, last)):
                ok = np.flatnonzero(a <= b)
                a, b, p = a[ok], b[ok], anchor[ok]
                core = p if right_side else p - SIDE
                keys.append(tb.mix(tb.fixed_ranges(data, core, CORE) + np.uint64(right_side)))
                s = np.zeros(len(ok), SPOT)
                s["id"], s["row"], s["start"] = e["id"][ok], e["row"][ok], a - base[ok]
                s["n"], s["at"] = b - a + 1, core - a
                strings.append((s, a))
            spots_, starts = np.concatenate([x for x, _ in strings]), np.concatenate([x for _, x in strings])
            key = np.concatenate(keys)
            for b, (s, k, at) in _split((key % np.uint64(n_buckets)).astype(np.int64), spots_, key, starts):
                size = s["n"] + LENGTH - 1
                body = b"".join(data[x : x + y].tobytes() for x, y in zip(at, size))
                head = np.int64(len(s)).tobytes()
                out["bucket"].append(b)
                out["blob"].append(head + pack(s) + k.tobytes() + body)
        return pa.table({"bucket": pa.array(out["bucket"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    return texts.groupBy("home").cogroup(spots.groupBy("home")).applyInArrow(run, "bucket long, blob binary")


# ---- the sort: suffixes compared by hashed common extensions


class Suffixes:
    """Suffixes of one byte buffer, each with an end beyond which it has no
    bytes. ``extension`` is the longest common prefix of two of them."""

    def __init__(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
        self.data, self.start, self.stop = data, start, stop
        self.hash = tb.PrefixHash(data)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Binary search over prefix hashes: logarithmic in the length."""
        a, b = self.start[i], self.start[j]
        high = np.minimum(self.stop[i] - a, self.stop[j] - b)
        low = np.zeros_like(high)
        step = 1 << int(max(1, high.max(initial=1))).bit_length()
        while step:
            step >>= 1
            if not step:
                break
            n = low + step
            ok = n <= high
            m = np.where(ok, n, 0)
            same = ok & (self.hash.ranges(a, a + m) == self.hash.ranges(b, b + m))
            low = np.where(same, n, low)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Is suffix i before suffix j? Ties by number, so order is total."""
        n = self.extension(i, j)
        a, b = self.start[i] + n, self.start[j] + n
        end_a, end_b = a >= self.stop[i], b >= self.stop[j]
        last = len(self.data) - 1
        byte_a = np.where(end_a, -1, self.data[np.minimum(a, last)].astype(np.int64))
        byte_b = np.where(end_b, -1, self.data[np.minimum(b, last)].astype(np.int64))
        return np.where(byte_a != byte_b, byte_a < byte_b, i < j)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order by group, then suffix: a bottom-up mergesort in which all
        merges of a level run at once; an element's place is its own rank plus
        that in the sibling run, found by binary search."""
        order = np.argsort(group, kind="stable")
        g = group[order]
        first = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0)) if len(g) else np.zeros(0, int)
        size = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] if len(g) else np.zeros(0, int)
        width = 1
        while len(g) and width < size.max():
            live = np.flatnonzero(size > width)  # larger groups only
            rank = live - begin[live]
            block = rank // width
            sibling = block ^ 1
            lo = begin[live] + np.minimum(sibling * width, size[live])
            hi = begin[live] + np.minimum((sibling + 1) * width, size[live])
            from_ = lo.copy()
            me = order[live]
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                before = self.less(order[mid], me[open_])
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            pair = begin[live] + (block // 2) * 2 * width
            target = pair + rank % width + (lo - from_)
            new = order.copy()
            new[target] = me
            order = new
            width *= 2
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Verified common extension of each element and the one before."""
        out = np.full(len(order), -1, np.int64)
        same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
        if len(same):
            i, j = order[same], order[same - 1]
            n = self.extension(i, j)
            out[same] = self.verified(self.start[i], self.start[j], n)
        return out

    def verified(self, a, b, n) -> np.ndarray:
        """Bytes that are really equal, of n whose hashes are."""
        total = np.concatenate([[0], np.cumsum(n)])
        which = np.repeat(np.arange(len(n)), n)
        k = np.arange(total[-1]) - total[:-1][which]
        differ = np.flatnonzero(self.data[a[which] + k] != self.data[b[which] + k])
        out = n.copy()
        if len(differ):
            np.minimum.at(out, which[differ], k[differ])
        return out


def covered_windows(spots: np.ndarray, key: np.ndarray, data: np.ndarray, off: np.ndarray):
    """(string, window) pairs of windows with an earlier equal one. String s
    is ``data[off[s]:off[s+1]]``, with ``spots["at"]`` bytes before its core
    and ``spots["n"]`` windows."""
    n = len(spots)
    group = np.unique(key, return_inverse=True)[1]
    core = off[:-1] + spots["at"]
    right = Suffixes(data, core, off[1:].copy())
    order_r = right.sort(group)
    near_r = right.neighbours(order_r, group)
    # reversed prefixes: the bytes before the core, read backwards
    size = len(data)
    left = Suffixes(np.ascontiguousarray(data[::-1]), size - core, size - off[:-1])
    order_l = left.sort(group)
    near_l = left.neighbours(order_l, group)
    earlier = np.lexsort((spots["start"], spots["row"], spots["id"]))
    age = np.empty(n, np.int64)
    age[earlier] = np.arange(n)
    out_s, out_w = [], []
    most = int(spots["at"].max(initial=0))
    for d in range(most + 1):
        # windows that start d bytes before the core
        w = spots["at"] - d
        has = (w >= 0) & (w < spots["n"])
        if not has.any():
            continue
        class_r = np.empty(n, np.int64)
        class_r[order_r] = np.cumsum(near_r < LENGTH - d)
        class_l = np.empty(n, np.int64)
        class_l[order_l] = np.cumsum(near_l < d)
        s = np.flatnonzero(has)
        s = s[np.lexsort((age[s], class_l[s], class_r[s]))]
        same = (class_r[s][1:] == class_r[s][:-1]) & (class_l[s][1:] == class_l[s][:-1])
        s = s[1:][same]
        out_s.append(s)
        out_w.append(w[s])
    if not out_s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_s), np.concatenate(out_w)


def compare_shared(strings: DataFrame, n_buckets: int, n_homes: int) -> DataFrame:
    def run(batches):
        for _, blobs in _gather(batches, None):
            spots, keys, bodies = [], [], []
            for blob in blobs:
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                at = 8 + n * SPOT.itemsize
                spots.append(unpack(blob[8:at], SPOT))
                keys.append(np.frombuffer(blob, np.uint64, n, at))
                bodies.append(np.frombuffer(blob, np.uint8, offset=at + 8 * n))
            spots, key, data = np.concatenate(spots), np.concatenate(keys), np.concatenate(bodies)
            off = np.concatenate([[0], np.cumsum(spots["n"] + LENGTH - 1)])
            s, w = covered_windows(spots, key, data, off)
            e = spots[s]
            e["start"] += w
            e["n"] = 1
            # windows that follow each other become one entry
            e = e[np.lexsort((e["start"], e["row"]))]
            if len(e):
                follows = (e["row"][1:] == e["row"][:-1]) & (e["start"][1:] == e["start"][:-1] + 1)
                first = np.flatnonzero(np.concatenate([[True], ~follows]))
                count = np.diff(np.append(first, len(e)))
                e = e[first]
                e["n"] = count
            yield _spot_batch(_spots("covered", e, n_homes))

    return strings.repartition(n_buckets, "bucket").mapInArrow(run, "kind string, home long, blob binary")


def remove_covered(texts: DataFrame, spots: DataFrame, id_type: str, with_text: bool) -> DataFrame:
    names = ["id", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        data, off, rows = _doc_places(left)
        size = np.diff(off)
        delta = np.zeros(len(data) + 1, np.int32)
        if right.num_rows and len(rows):
            e = np.concatenate([unpack(x.as_py(), SPOT) for x in right.column("blob").combine_chunks()])
            order = np.argsort(rows)
            base = off[order[np.searchsorted(rows[order], e["row"])]]
            np.add.at(delta, base + e["start"], 1)
            np.add.at(delta, base + e["start"] + e["n"] - 1 + LENGTH, -1)
        gone = np.cumsum(delta[:-1], dtype=np.int32) > 0
        removed, spans, digest, kept_texts = [], [], [], []
        raw = data.tobytes()
        for a, b in zip(off[:-1], off[1:]):
            g = gone[a:b]
            k = int(g.sum())
            if k:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
                ends = np.concatenate([[0], edge, [b - a]])
                kept = b"".join(raw[a + x : a + y] for x, y in zip(ends[0::2], ends[1::2]))
                spans.append(len(edge) // 2)
            else:
                kept = raw[a:b]
                spans.append(0)
            removed.append(k)
            digest.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept.decode("utf-8", "replace"))
        ids = left.column("id").combine_chunks()
        cols = [ids, pa.array(rows), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
        if with_text:
            cols.append(pa.array(kept_texts, pa.string()))
        return pa.table(cols, names=names)

    schema = f"id {id_type}, row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return texts.groupBy("home").cogroup(spots.groupBy("home")).applyInArrow(run, schema)


def dedup_substrings(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, hot: int = HOT
) -> DataFrame:
    """One row per document: id, row, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 (lowercase hex of what is left) and, if asked,
    kept_text (bytes cut within a character show as replacement marks).
    ``hot`` bears on the way work is dealt, never on the result."""
    base = documents.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = cut_lineage(base, "suffix_texts")
    id_type = base.schema["id"].dataType.simpleString()
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_homes = max(8, int(total // BUCKET_BYTES) + 1)
    n_buckets = max(8, int(total // RUN_BYTES) + 1)
    slim = base.select(F.col("id").cast("long").alias("id"), "row", "text")
    cells = documents.sparkSession.sparkContext.broadcast(hot_cells(slim, hot))
    spots = cut_lineage(settle_runs(find_runs(slim, n_buckets, cells), n_buckets, n_homes), "suffix_spots")
    texts = base.withColumn("home", row_bucket(F.col("row"), n_homes))
    shared = spots.where("kind = 'shared'")
    strings = fetch_shared(texts.select("home", "row", "text"), shared, n_buckets)
    more = cut_lineage(compare_shared(strings, n_buckets, n_homes), "suffix_covered")
    covered = spots.where("kind = 'covered'").unionByName(more)
    return remove_covered(texts, covered, id_type, with_text)
