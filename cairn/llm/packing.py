"""Best-fit packing by a grouping genetic algorithm on islands.

A document is its token ids and one end id. Documents longer than
``capacity`` are cut into pieces of ``capacity`` tokens, of which the first
may be shorter; full pieces are sequences of their own. The other pieces
are dealt by a hash into blocks of about ``block_items``, whose number
grows with the input. Each block is packed by ``islands`` populations that
evolve apart: a crossover injects the best-filled bins of one parent whole
into the other, bins that then hold an item twice are dissolved, and their
other items first change places with one or two items of a bin where that
fills it better, and the rest is placed best-fit, largest first. After each
round of generations the best packing of an island migrates to the next island
of its block, through a table in the shared folder. The search works on every
block that best-fit does not close: it ends before its last generation only
when the block has as few bins as its tokens need. The best packing of each
block places its pieces. Bins with more than a twentieth unused are taken
apart, and their pieces form the blocks of a next level, so that the whole
table meets the bound and not each block by itself; the last level has one
block. No task holds more than one block.

Null texts count as empty; an empty document is its end id alone. Repeated
rows are packed as often as they stand in the input; null ids are kept.
Other columns are ignored. An empty table gives an empty result.

Token ids: the byte-level BPE of a ``tokenizers`` file, run by ``tiktoken``
with ranks read from that file (same ids, five times the speed; compared in
the tests). Strings of the file's added tokens count as ordinary text, or with
``added_tokens`` as these tokens, as ``Tokenizer.encode`` reads them.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from cairn.llm import textbuf as tb
from cairn.session import cut_lineage

CAPACITY = 2048
BLOCK_ITEMS = 4096
ISLANDS = 2
ROUNDS = 2
GENERATIONS = 20  # a round, on blocks that best-fit does not close
POPULATION = 8
MOST_UNPLACED = 200  # unplaced items whose pairs an exchange looks at; the rest is placed best-fit
NEIGHBOURS = 2  # pairs of a bin's items that stand this close by length
LEFT_OVER = 20  # bins with more than a 20th unused go to the next level
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "id {id_type}, row long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Byte-level BPE of a ``tokenizers`` file whose ids are merge ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # the 256 printable stand-ins of byte-level BPE
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut_document(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, (starts + [n])[i + 1] - s) for i, s in enumerate(starts)]


def pieces(
    documents: DataFrame,
    id_col: str,
    text_col: str,
    tokenizer_path: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    row_col: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """id, row, piece, start, length, ids_crc32 of every piece."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    docs = documents.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        known = encoder(tokenizer_path)
        encode = partial(known.encode, allowed_special="all") if added_tokens else known.encode_ordinary
        for batch in batches:
            ids, rows, texts = (tb.column(batch, c) for c in ("id", "row", "text"))
            at, out = [], []
            for i, text in enumerate(texts):
                tokens = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for k, (s, n) in enumerate(cut_document(len(tokens), capacity)):
                    at.append(i)
                    out.append((k, s, n, zlib.crc32(tokens[s : s + n].tobytes())))
            cols = list(zip(*out)) if out else [[], [], [], []]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), rows.take(take), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["id", "row", "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(run, PIECES.format(id_type=id_type))


# ---- the genetic algorithm on the sorted lengths of one block


class Packing:
    """Items placed into bins; room[b] is what is left in bin b."""

    def __init__(self, n: int, capacity: int):
        self.capacity, self.bin, self.room = capacity, np.full(n, -1, np.int32), []

    def place(self, items, lengths) -> None:
        """Best-fit: each item goes where the least room is left over."""
        free: dict[int, list[int]] = {}
        levels = 0  # bit r is set when some open bin has room r
        for b, r in enumerate(self.room):
            if r:
                free.setdefault(r, []).append(b)
                levels |= 1 << r
        for i in items:
            need = int(lengths[i])
            fit = levels >> need
            if fit:
                r = need + (fit & -fit).bit_length() - 1
                stack = free[r]
                b = stack.pop()
                if not stack:
                    levels ^= 1 << r
            else:
                b, r = len(self.room), self.capacity
                self.room.append(r)
            left = r - need
            self.room[b] = left
            self.bin[i] = b
            if left:
                free.setdefault(left, []).append(b)
                levels |= 1 << left

    def compact(self, keep: np.ndarray) -> None:
        """Keep the marked bins only; items of others become unplaced."""
        number = np.where(keep, np.cumsum(keep) - 1, -1).astype(np.int32)
        placed = self.bin >= 0
        self.bin[placed] = number[self.bin[placed]]
        self.room = [r for r, k in zip(self.room, keep) if k]

    def fitness(self) -> tuple[int, float]:
        fill = 1.0 - np.array(self.room, dtype=float) / self.capacity
        return -len(self.room), float((fill * fill).sum())


def pack_order(lengths, order, capacity: int) -> Packing:
    p = Packing(len(lengths), capacity)
    p.place(order, lengths)
    return p


def exchange(p: Packing, items: np.ndarray, lengths, passes: int = 2) -> np.ndarray:
    """Fill bins of ``p`` better: one or two of a bin's items make room for
    one or two of the unplaced ``items`` that leave less of it unused. Each pass
    looks all candidates up in the sorted sums of the unplaced and takes them
    by their gain, a bin and an item once. What is unplaced then."""
    for _ in range(passes):
        room = np.array(p.room, dtype=np.int64)
        if not len(items) or not len(room):
            return items
        # sums of one and of two unplaced items
        few = items[: MOST_UNPLACED]
        i, j = np.triu_indices(len(few), 1)
        one, two = np.concatenate([few, few[i]]), np.concatenate([np.full(len(few), -1), few[j]])
        total = lengths[one] + np.where(two >= 0, lengths[two], 0)
        order = np.argsort(total, kind="stable")
        one, two, total = one[order], two[order], total[order]
        # one or two neighbours of a bin: its items in order of length
        open_bins = np.flatnonzero(room > 0)
        inside = np.flatnonzero((p.bin >= 0) & np.isin(p.bin, open_bins))
        inside = inside[np.argsort(p.bin[inside], kind="stable")]
        b = p.bin[inside]
        out_1, out_2 = [inside], [np.full(len(inside), -1)]
        for step in range(1, NEIGHBOURS + 1):
            same = np.flatnonzero(b[step:] == b[:-step])
            out_1.append(inside[same])
            out_2.append(inside[same + step])
        first, second = np.concatenate(out_1), np.concatenate(out_2)
        leaves = lengths[first] + np.where(second >= 0, lengths[second], 0)
        owner = p.bin[first]
        limit = leaves + room[owner]
        best = np.searchsorted(total, limit, side="right") - 1
        gain = np.where(best >= 0, total[np.maximum(best, 0)] - leaves, 0)
        taken = np.zeros(len(lengths), bool)
        used = np.zeros(len(room), bool)
        changed = False
        unplaced = set(items.tolist())
        for c in np.argsort(-gain, kind="stable"):
            if gain[c] <= 0:
                break
            bin_, come = int(owner[c]), [int(x) for x in (one[best[c]], two[best[c]]) if x >= 0]
            if used[bin_] or taken[come].any():
                continue
            used[bin_] = changed = True
            taken[come] = True
            for x in (first[c], second[c]):
                if x >= 0:
                    p.bin[x] = -1
                    unplaced.add(int(x))
            p.bin[come] = bin_
            unplaced -= set(come)
            p.room[bin_] -= int(gain[c])
        items = np.array(sorted(unplaced), dtype=np.int64)
        if not changed:
            break
    return items


def crossover(a: Packing, b: Packing, lengths, share: float, rng) -> Packing:
    """Inject well-filled bins of b whole into a copy of a."""
    child = Packing(len(lengths), a.capacity)
    child.bin, child.room = a.bin.copy(), list(a.room)
    room_b = np.array(b.room)
    pick = np.zeros(len(room_b), bool)
    best = np.argsort(room_b + rng.random(len(room_b)), kind="stable")
    pick[best[: max(1, int(len(best) * share))]] = True
    moved = pick[b.bin]
    keep = np.ones(len(child.room), bool)
    keep[child.bin[moved]] = False  # these bins hold an injected item
    displaced = ~keep[child.bin] & ~moved
    child.bin[moved] = -1
    child.compact(keep)
    number = np.where(pick, np.cumsum(pick) - 1 + len(child.room), -1)
    child.bin[moved] = number[b.bin[moved]]
    child.room += [int(r) for r in room_b[pick]]
    child.bin[displaced] = -1
    child.place(exchange(child, np.flatnonzero(displaced), lengths), lengths)  # largest first: lengths are sorted
    return child


def mutate(p: Packing, lengths, rng, share: float = 0.05) -> Packing:
    """Dissolve the emptiest bins and some others; place their items anew."""
    room = np.array(p.room)
    gone = np.argsort(-room - rng.random(len(room)), kind="stable")[: max(2, int(len(room) * share))]
    gone = np.union1d(gone, rng.integers(0, len(room), size=max(1, len(gone) // 2)))
    keep = np.ones(len(room), bool)
    keep[gone] = False
    child = Packing(len(lengths), p.capacity)
    child.bin, child.room = p.bin.copy(), list(p.room)
    items = np.flatnonzero(~keep[child.bin])
    child.bin[items] = -1
    child.compact(keep)
    child.place(exchange(child, items, lengths), lengths)
    return child


def evolve(lengths, population: list[Packing], capacity: int, seed: int, generations: int, size: int) -> tuple[list[Packing], int, int]:
    """Up to ``generations`` generations, the best packing first, how many
    there were, and the bins of the first packing (best-fit, for an empty
    population). They end early only when the best packing has as few bins as
    the sum of the lengths needs: no packing has fewer. Lengths sort
    descending."""
    rng = np.random.default_rng(seed)
    n = len(lengths)
    bound = -(-int(lengths.sum()) // capacity)
    pop = list(population)
    if not pop:
        pop.append(pack_order(lengths, range(n), capacity))
    done, start = 0, len(pop[0].room)
    while done < generations and min(len(p.room) for p in pop) > bound:
        while len(pop) < size:
            shaken = np.argsort(-lengths * (1.0 + 0.1 * rng.standard_normal(n)), kind="stable")
            pop.append(pack_order(lengths, shaken, capacity))
        pop = sorted(pop, key=Packing.fitness, reverse=True)[:size]
        # parents by tournament; the better of two gives its bins to the other
        for _ in range(max(1, size // 3)):
            i, j = sorted(rng.choice(len(pop), size=2, replace=False)) if len(pop) > 1 else (0, 0)
            pop.append(crossover(pop[j], pop[i], lengths, rng.uniform(0.2, 0.6), rng))
        pop.append(mutate(pop[0], lengths, rng))
        pop.append(mutate(pop[int(rng.integers(len(pop)))], lengths, rng, 0.15))
        done += 1
    pop.sort(key=Packing.fitness, reverse=True)
    return pop[:size], done, start


def _dump(pop: list[Packing]) -> bytes:
    return np.concatenate([p.bin for p in pop]).astype("<i4").tobytes()


def _load(blob: bytes, lengths, capacity: int) -> list[Packing]:
    n, out = len(lengths), []
    for row in np.frombuffer(blob, "<i4").reshape(-1, n) if n else []:
        p = Packing(n, capacity)
        p.bin = row.copy()
        p.room = [int(r) for r in capacity - np.bincount(row, weights=lengths)]
        out.append(p)
    return out


STATE = "block long, island int, lengths binary, population binary, bins int, generations int, best_fit int"
STATE_COLUMNS = [c.split()[0] for c in STATE.split(", ")]


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")


def evolved_blocks(part: DataFrame, n_blocks: int, capacity: int, islands: int, rounds: int, generations: int, population: int,
                   seed: int) -> DataFrame:
    """The islands of all blocks after the last round."""

    def problem(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = _ordered(pdf)["length"].to_numpy().astype("<i4").tobytes()
        rows = [(key[0], i, lengths, b"", 0, 0, 0) for i in range(islands)]
        return pd.DataFrame(rows, columns=STATE_COLUMNS)

    def step(round_no: int):
        def run(frames):
            for pdf in frames:
                out = []
                for r in pdf.itertuples(index=False):
                    lengths = np.frombuffer(r.lengths, "<i4").astype(np.int64)
                    pop = _load(r.population, lengths, capacity) + _load(r.immigrant or b"", lengths, capacity)
                    own = ((seed * rounds + round_no) << 32) + int(r.block) * islands + int(r.island)
                    pop, done, start = evolve(lengths, pop, capacity, own, generations, population)
                    first = start if round_no == 0 else r.best_fit
                    out.append((r.block, r.island, r.lengths, _dump(pop), len(pop[0].room), r.generations + done, first))
                yield pd.DataFrame(out, columns=STATE_COLUMNS)

        return run

    blocks = part.select("block", "row", "piece", "length").groupBy("block").applyInPandas(problem, STATE)
    state = blocks.withColumn("immigrant", F.lit(None).cast("binary"))
    for r in range(rounds):
        # a number of its own: the rows are small but the work on them is not
        spread = state.repartition(n_blocks * islands // 4 + 1, "block", "island")
        evolved = cut_lineage(spread.mapInPandas(step(r), STATE), "packing_islands")
        # the elite (first packing) of an island moves to the next island
        elite = evolved.select(
            "block",
            ((F.col("island") + 1) % islands).alias("island"),
            F.expr("substring(population, 1, length(lengths))").alias("immigrant"),
        )
        state = evolved.join(elite, ["block", "island"])
    return evolved


def _assign(level: int, capacity: int):
    """Places of a block's pieces in its best packing; ``half_full`` marks
    those in bins with more than a ``LEFT_OVER``-th unused."""

    def assign(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = _ordered(left).reset_index(drop=True)
        bins = np.frombuffer(right["population"].iloc[0], "<i4")[: len(out)].astype(np.int64)
        order = np.argsort(bins, kind="stable")
        length = out["length"].to_numpy()[order]
        before = np.cumsum(length) - length
        first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        fill = np.bincount(bins, weights=out["length"].to_numpy())
        out = out.iloc[order].drop(columns="block")
        out["sequence_id"] = (level << 56) + int(key[0]) * (1 << 24) + bins[order]
        out["offset"] = offset
        out["half_full"] = (capacity - fill[bins[order]]) * LEFT_OVER > capacity
        return out

    return assign


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    block_items: int = BLOCK_ITEMS,
    islands: int = ISLANDS,
    rounds: int = ROUNDS,
    generations: int = GENERATIONS,
    population: int = POPULATION,
    report: list | None = None,
) -> DataFrame:
    """``items`` (the columns of ``pieces``; a table that reads the same
    each time) plus sequence_id and offset. ``report`` gets a dict a level:
    its blocks and pieces, the bins of best-fit and of the search, and the
    generations that ran."""
    whole = items.where(F.col("length") >= capacity)
    out = whole.select("*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = items.where(F.col("length") < capacity)
    placed = [*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    level, n = 0, part.count()
    while n:
        n_blocks = -(-n // block_items)
        part = part.withColumn("block", F.pmod(F.xxhash64("row", "piece", F.lit(level)), F.lit(n_blocks)))
        evolved = evolved_blocks(part, n_blocks, capacity, islands, rounds, generations, population, level)
        best = evolved.groupBy("block").agg(F.max_by(F.struct(*STATE_COLUMNS), F.struct(-F.col("bins"), -F.col("island"))).alias("b"))
        if report is not None:
            sums = [F.sum(c).alias(c) for c in ("best_fit", "bins", "generations")]
            report.append({"level": level, "blocks": n_blocks, "pieces": n} | best.select("b.*").agg(*sums).first().asDict())

        groups = part.groupBy("block").cogroup(best.select("block", "b.population").groupBy("block"))
        packed = groups.applyInPandas(_assign(level, capacity), StructType([*placed, StructField("half_full", BooleanType())]))
        packed = cut_lineage(packed, "packing_level")
        left = packed.where("half_full")
        n_left = left.count() if n_blocks > 1 else 0
        # what the blocks could not fill is packed again, together; a level
        # that leaves more than half of its pieces has long ones, and is final
        if 2 * n_left > n:
            n_left = 0
        out = out.unionByName(packed.where("NOT half_full" if n_left else "true").drop("half_full"))
        part, n, level = left.select(*items.columns), n_left, level + 1
    return out.select(*[f.name for f in placed])


def pack_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = 0,
    capacity: int = CAPACITY,
    row_col: str | None = None,
    added_tokens: bool = False,
    **options,
) -> DataFrame:
    """Tokenize, cut and pack; one row per piece (see ``pieces``)."""
    path = tokenizer_path or default_tokenizer()
    cut = cut_lineage(pieces(documents, id_col, text_col, path, end_id, capacity, row_col, added_tokens), "packing_pieces")
    return pack(cut, capacity, **options)
