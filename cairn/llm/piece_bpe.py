"""SentencePiece BPE in vectorised merge rounds, and its decoding.

``encode`` gives every text the ids that the sentencepiece library gives it
with a BPE model, ``decode`` the text that the library gives back.

1. The texts of a chunk are one flat array of code points; a space becomes
   U+2581 and every text that is not empty gets one in front. Every character
   is a symbol.
2. The array is cut into words wherever two neighbouring characters stand
   together in no piece: no merge can ever cross such a place (with the usual
   models this is before every U+2581 behind another character, and at
   characters outside the vocabulary). Equal words of a chunk, found by hash
   and verified, are merged once.
3. Rounds: the smallest pair rank of every word by a segmented minimum; all its
   places in the word are merged at once, from the left without overlaps; dead
   symbols are compacted away, and words without a known pair leave. The
   library merges one place at a time, so a word stops after the first place
   whose new neighbours make a pair of the same or a smaller rank; that pair is
   the next round's. So the ids are the library's for every model, not only
   for those whose ranks grow with each merge.
4. Symbols outside the vocabulary become byte pieces.

Null and empty texts have no ids but those of begin and end; they decode to
the empty text. Repeated rows are encoded one by one, null ids of rows are
kept, other columns pass through whatever their names, an empty table gives
an empty table. A text is never cut: chunks hold whole texts, so memory is a
chunk or the longest text; a word of n characters takes as many rounds as it
has different merges. Bytes that are not UTF-8 count as U+FFFD.

Models must be BPE with byte pieces and the identity normaliser with a
dummy prefix; others raise ``ValueError``.
"""

from __future__ import annotations

import codecs
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField

from cairn.llm import textbuf as tb

SPACE = 0x2581
NONE = np.int32(2**31 - 1)
POINTS = 0x110000
CHUNK = 1 << 19  # bytes of text that are merged together; a longer text is alone
_MIX = np.uint64(0x9E3779B97F4A7C15)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PairTable:
    """(left symbol, right symbol) -> (rank, merged symbol), open addressing."""

    def __init__(self, left, right, rank, merged, n_symbols: int):
        self.n_symbols = n_symbols
        self.bits = max(4, int(len(left) * 8).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        self.merged = np.full(1 << self.bits, -1, np.int32)
        key = left.astype(np.int64) * n_symbols + right
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.key[slot[todo]] < 0
            claim = slot[todo[free]]
            self.key[claim] = key[todo[free]]  # of several claims the last one holds
            won = self.key[slot[todo]] == key[todo]
            self.rank[slot[todo[won]]], self.merged[slot[todo[won]]] = rank[todo[won]], merged[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key):
        return ((key.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left, right):
        """Slots of the pairs; a free slot stands for no pair."""
        key = left.astype(np.int64) * self.n_symbols + right
        key[(left >= self.n_symbols) | (right >= self.n_symbols)] = -2
        slot = self._slot(key)
        lost = np.flatnonzero((self.key[slot] != key) & (self.key[slot] >= 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & ((1 << self.bits) - 1)
            have = self.key[slot[lost]]
            lost = lost[(have != key[lost]) & (have >= 0)]
        return slot


class Model:
    """What the rounds need of a model file: symbols, pairs and bytes.

    Symbols are piece ids, then characters that stand only inside pieces,
    then (from ``n_symbols``) all other code points.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ab    Aﬁ "
        n = len(sp)
        kinds = np.array(["byte" if sp.is_byte(i) else "none" if sp.is_control(i) or sp.is_unknown(i) else "piece" for i in range(n)])
        as_bytes = {int(sp.id_to_piece(int(i))[3:5], 16): int(i) for i in np.flatnonzero(kinds == "byte")}
        shown = "".join(p for p in sp.encode(probe, out_type=str) if not p.startswith("<0x"))
        plain = "▁" + probe.replace(" ", "▁")
        if len(as_bytes) < 256 or any(sp.is_unused(i) for i in range(n)) or not set(shown) <= set(plain) or not shown.startswith("▁▁a"):
            raise ValueError("not a BPE model with byte pieces, identity normaliser and dummy prefix: " + path)
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.byte_id = np.array([as_bytes[b] for b in range(256)], np.int32)
        self.n_pieces = n
        pieces = {sp.id_to_piece(int(i)): int(i) for i in np.flatnonzero(kinds == "piece")}

        chars = sorted({c for p in pieces for c in p})
        symbol = dict(pieces)
        for c in chars:
            symbol.setdefault(c, n + len(symbol) - len(pieces))
        self.n_symbols = n + len(symbol) - len(pieces)
        self.char_index = np.full(POINTS, -1, np.int32)
        self.char_index[[ord(c) for c in chars]] = np.arange(len(chars))
        self.symbol_of = np.arange(POINTS, dtype=np.int32) + self.n_symbols
        self.symbol_of[[ord(c) for c in chars]] = [symbol[c] for c in chars]
        self.point_of = np.array([ord(c) for c, _ in sorted(((c, s) for c, s in symbol.items() if s >= n), key=lambda x: x[1])], np.int64)
        self.near = np.zeros((len(chars), len(chars)), bool)

        score = {p: sp.get_score(i) for p, i in pieces.items()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = []
        for p, i in pieces.items():
            for k in range(1, len(p)):
                self.near[self.char_index[ord(p[k - 1])], self.char_index[ord(p[k])]] = True
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs.append((left, right, order[score[p]], i))
        self.pairs = PairTable(*np.array(pairs, np.int32).reshape(-1, 4).T, self.n_symbols)

        # for decoding: the bytes of every id
        texts = [b""] * n
        for p, i in pieces.items():
            texts[i] = p.replace("▁", " ").encode()
        for b, i in as_bytes.items():
            texts[i] = bytes([b])
        if 0 <= self.unk < n:
            texts[self.unk] = " ⁇ ".encode()
        self.spaced = np.array([sp.id_to_piece(i).startswith("▁") for i in range(n)]) & (kinds == "piece")
        self.silent = np.array([not t for t in texts])
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(t) for t in texts], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)[:-1]])


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def merge_rounds(pairs: PairTable, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols after all merges, at the place of their first character; -1
    elsewhere. ``first`` marks the first character of every word."""
    out = np.full(len(symbols), -1, np.int32)
    place = np.arange(len(symbols), dtype=np.int64)
    sym, first = symbols.astype(np.int32), first.copy()
    rank = np.full(len(sym), NONE, np.int32)
    inner = np.flatnonzero(~first[1:])
    rank[inner] = pairs.rank[pairs.find(sym[inner], sym[inner + 1])]
    while len(sym):
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        done = least == NONE
        if done.any():
            gone = np.repeat(done, lengths)
            out[place[gone]] = sym[gone]
            sym, rank, place, first = sym[~gone], rank[~gone], place[~gone], first[~gone]
            starts, lengths, least = np.flatnonzero(first), lengths[~done], least[~done]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(least, lengths))
        # of overlapping places every second one, from the left
        step = np.arange(len(hit))
        begins = np.ones(len(hit), bool)
        begins[1:] = np.diff(hit) != 1
        hit = hit[(step - np.maximum.accumulate(np.where(begins, step, 0))) % 2 == 0]
        while True:
            merged = pairs.merged[pairs.find(sym[hit], sym[hit + 1])]
            after, alive = sym.copy(), np.ones(len(sym), bool)
            after[hit], alive[hit + 1] = merged, False
            has_left = ~first[hit]
            left = np.maximum(hit - 1, 0)
            left = np.where(has_left, left - ~alive[left], 0)
            right = np.minimum(hit + 2, len(sym) - 1)
            has_right = (hit + 2 < len(sym)) & ~first[right]
            new_left = np.where(has_left, pairs.rank[pairs.find(after[left], merged)], NONE)
            new_right = np.where(has_right, pairs.rank[pairs.find(merged, sym[right])], NONE)
            early = np.minimum(new_left, new_right) <= rank[hit]
            if early.any():
                word = np.searchsorted(starts, hit, side="right") - 1
                last = np.full(len(starts), len(sym), np.int64)
                np.minimum.at(last, word[early], hit[early])
                stays = hit <= last[word]
                if not stays.all():
                    hit = hit[stays]
                    continue
            break
        rank[hit] = new_right
        rank[left[has_left]] = new_left[has_left]
        sym, rank, place, first = after[alive], rank[alive], place[alive], first[alive]
    return out


def _points(data: np.ndarray, offsets: np.ndarray):
    """Code points of the rows' texts and the rows' offsets among them."""
    raw = data.tobytes()
    try:
        flat = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return flat, starts[offsets]
    except UnicodeDecodeError:
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def _spread(starts: np.ndarray, lengths: np.ndarray):
    """All places of the ranges one after the other, and where each begins."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    return np.repeat(starts - begins, lengths) + np.arange(ends[-1] if len(ends) else 0), begins


def distinct_words(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Numbers of words of which no two are equal, and for every word the
    place of its equal among them. Equal hashes are verified; a word whose
    hash collides stands for itself."""
    if not len(starts):
        return starts, starts
    hashes = tb.PrefixHash(points, points.astype(np.uint64) + np.uint64(1)).ranges(starts, starts + lengths)
    _, chosen, same = np.unique(hashes * np.uint64(2 * 31 + 1) + lengths.astype(np.uint64), return_index=True, return_inverse=True)
    twin = chosen[same]
    fits = lengths[twin] == lengths
    flat, begins = _spread(starts[twin], np.where(fits, lengths, 0))
    own, _ = _spread(starts, np.where(fits, lengths, 0))
    differ = np.concatenate([[0], np.cumsum(points[flat] != points[own])])
    ends = np.append(begins[1:], len(flat))
    odd = np.flatnonzero(~fits | (differ[ends] > differ[begins]))
    same[odd] = len(chosen) + np.arange(len(odd))
    return np.concatenate([chosen, odd]), same


def _to_ids(model: Model, merged: np.ndarray, bounds: np.ndarray):
    """Ids of the merged symbols, flat, and how many every word has."""
    live = np.flatnonzero(merged >= 0)
    ids, word = merged[live].astype(np.int64), np.searchsorted(bounds, live, side="right") - 1
    odd = ids >= model.n_pieces
    if odd.any():
        # characters without a piece: their UTF-8 bytes
        point = np.where(ids >= model.n_symbols, ids - model.n_symbols, 0)
        rare = odd & (ids < model.n_symbols)
        if rare.any():
            point[rare] = model.point_of[ids[rare] - model.n_pieces]
        raw = np.frombuffer(point[odd].astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
        width = np.ones(len(ids), np.int64)
        width[odd] = 1 + (point[odd] > 0x7F) + (point[odd] > 0x7FF) + (point[odd] > 0xFFFF)
        ids, word, odd = np.repeat(ids, width), np.repeat(word, width), np.repeat(odd, width)
        ids[odd] = model.byte_id[raw]
    return ids, np.bincount(word, minlength=len(bounds))


def encode_rows(model: Model, data: np.ndarray, offsets: np.ndarray, begin: bool = True, end: bool = True):
    """Ids of every row's text, flat, and the rows' offsets among them."""
    points, off = _points(data, offsets)
    n_rows = len(off) - 1
    filled = np.flatnonzero(off[1:] > off[:-1])
    points = np.insert(np.where(points == 0x20, SPACE, points).astype(np.int64), off[filled], SPACE)
    off = off + np.concatenate([[0], np.cumsum(off[1:] > off[:-1])])

    kind = model.char_index[points]
    first = np.ones(len(points), bool)
    if len(points):
        first[1:] = (kind[1:] < 0) | (kind[:-1] < 0) | ~model.near[kind[:-1], kind[1:]]
        first[off[filled]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(points)))
    chosen, same = distinct_words(points, starts, lengths)
    taken, bounds = _spread(starts[chosen], lengths[chosen])
    ids = merge_rounds(model.pairs, model.symbol_of[points[taken]], first[taken])
    word_ids, n_ids = _to_ids(model, ids, bounds)

    # every word gets the ids of the one that was merged for it
    size = n_ids[same]
    take, _ = _spread((np.cumsum(n_ids) - n_ids)[same], size)
    row = np.searchsorted(off, starts, side="right") - 1
    extra = int(begin) + int(end)
    out_off = np.concatenate([[0], np.cumsum(np.bincount(row, weights=size, minlength=n_rows).astype(np.int64) + extra)])
    out = np.empty(out_off[-1], np.int32)
    out[np.arange(len(take)) + int(begin) + extra * np.repeat(row, size)] = word_ids[take]
    if begin:
        out[out_off[:-1]] = model.bos
    if end:
        out[out_off[1:] - 1] = model.eos
    return out, out_off


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("cairn_each_byte", _each_byte)


def decode_rows(model: Model, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of the rows' ids: control ids are silent, byte pieces are put
    together, the dummy prefix goes. Unknown ids raise ``IndexError``."""
    if len(ids) and (ids.min() < 0 or ids.max() >= model.n_pieces):
        raise IndexError("an id outside the vocabulary")
    size, at = model.size[ids], model.at[ids]
    # the first id of a row that is not silent loses its leading space
    loud = np.flatnonzero(~model.silent[ids])
    if len(loud):
        row = np.searchsorted(offsets, loud, side="right") - 1
        heads = loud[np.concatenate([[True], row[1:] != row[:-1]])]
        heads = heads[model.spaced[ids[heads]]]
        size[heads] -= 1
        at[heads] += 1
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = model.text[np.repeat(at - ends[:-1], size) + np.arange(ends[-1])].tobytes()
    return [raw[a:b].decode("utf-8", "cairn_each_byte") for a, b in zip(ends[offsets[:-1]], ends[offsets[1:]])]


def encode(
    documents: DataFrame,
    text_col: str = "text",
    model_path: str | None = None,
    ids_col: str = "ids",
    begin: bool = True,
    end: bool = True,
    packed: bool = False,
) -> DataFrame:
    """``documents`` with the ids of every whole text in place of it, as the
    last column ``ids_col``: an array of int, or ``packed`` as token files have
    them, little-endian unsigned 32-bit integers. One pass, no shuffle."""
    path = model_path or default_model()
    rest = [c for c in documents.columns if c != text_col]
    rows = documents.select(*[documents[f"`{c}`"] for c in rest], documents[f"`{text_col}`"])
    k = len(rest)

    def run(batches):
        model = load(path)
        for batch in batches:
            for a, data, off in tb.chunks_of(batch.column(k), CHUNK):
                ids, ends = encode_rows(model, data, off, begin, end)
                part = batch.slice(a, len(off) - 1)
                if packed:
                    lists = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids.astype("<i4"))])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:k], lists], names=[*(f"c{i}" for i in range(k)), "c_ids"])

    plain = rows.toDF(*[f"c{i}" for i in range(k)], "c_text")
    schema = plain.drop("c_text").schema.add(StructField("c_ids", BinaryType() if packed else ArrayType(IntegerType(), True)))
    return plain.mapInArrow(run, schema).toDF(*rest, ids_col)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of arrays or packed ids and the rows' offsets."""
    if pa.types.is_list(column.type):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        size = pc.fill_null(pc.list_value_length(column), 0)
    else:
        whole = b"".join(x.as_py() for x in column if x.is_valid)
        flat = np.frombuffer(whole, "<i4")
        size = pc.divide(pc.fill_null(pc.binary_length(column), 0), 4)
    return flat.astype(np.int64), np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))])


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str | None = None, text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of every id list (an array or packed) as the
    new last column ``text_col``; null lists give the empty text. One pass, no
    shuffle."""
    path = model_path or default_model()
    at = encoded.columns.index(ids_col)

    def run(batches):
        model = load(path)
        for batch in batches:
            ids, off = _lists(batch.column(at))
            texts = []
            for a, b in tb.row_chunks(off, CHUNK // 4):
                texts += decode_rows(model, ids[off[a] : off[b]], off[a : b + 1] - off[a])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "c_text"])

    return tb.map_whole(encoded, run, (StructField(text_col, StringType()),))
