"""Filter audit, SentencePiece encoding and embedding whitening against
brute force, the library itself and a dense eigensolver."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from cairn.llm import filter_audit, piece_bpe, whitening
from cairn.llm import textbuf as tb
from cairn.llm.queries import QUERIES

# ---- filter audit


def audit_by_hand(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = defaultdict(set)
    for i, t, _ in docs:
        if i is not None:
            ids[t or ""].add(i)

    def fails(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = set()
        if len(w) < 200:
            out.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            out.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            out.add("C")
        if re.search(r"[#$%&*|]", t):
            out.add("D")
        if i is not None and min(ids[t]) < i:
            out.add("E")
        return out

    parts = defaultdict(list)
    for i, t, part in docs:
        parts[part or ""].append((fails(i, t), i in good, i in toxic))
    rows = []
    for part, found in parts.items():
        steps = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in found if f in x[0] and not before & x[0]]
                steps.append(
                    (
                        f,
                        ("".join(order), k + 1, sum(not x[0] & (before | {f}) for x in found), len(gone),
                         sum(f in x[0] and bool(before & x[0]) for x in found), sum(x[0] == {f} for x in found),
                         sum(x[1] for x in gone), sum(x[2] for x in gone)),
                    )
                )
        shapley = Counter()
        for f, step in steps:
            shapley[f] += step[3]
        rows += [(part, *step, shapley[f]) for f, step in steps]
    return sorted(rows)


AUDIT_DOCS = [
    (1, "word " * 250, "en"),
    (2, "word " * 250, "de"),
    (2, "word " * 250, "de"),
    (2, "word " * 250, None),
    (3, " ".join(f"w{i}" for i in range(220)), "en"),
    (4, " ".join(f"w{i}" for i in range(220)) + " $", "en"),
    (5, "SHOUTING " * 10, "en"),
    (6, None, ""),
    (7, "", None),
    (None, "", None),
    (None, "word " * 250, "en"),
    (8, "a b\x0bc\x85d", "fr"),
    (9, "é" * 97 + "ABC", "fr"),
    (10, "é" * 96 + "ABCD", "fr"),
    (11, "w " * 100_000, "fr"),
]
AUDIT_LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (5, 1, 1), (None, 1, 1), (6, 0, 0), (99, 1, 1)]


@pytest.mark.parametrize("parts", [1, 5])
def test_audit_equals_brute_force(llm, parts):
    docs = llm.createDataFrame([(*r, "x", 1) for r in AUDIT_DOCS], "doc_id long, text string, lang string, code string, part int").repartition(parts)
    labels = llm.createDataFrame([(*r, "x") for r in AUDIT_LABELS], "doc_id long, quality int, toxic int, id string")
    got = sorted(tuple(r) for r in filter_audit.audit(docs, labels).collect())
    assert got == audit_by_hand(AUDIT_DOCS, AUDIT_LABELS)


def test_audit_of_empty_tables(llm):
    docs = llm.createDataFrame(AUDIT_DOCS, "doc_id long, text string, lang string")
    labels = llm.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    got = sorted(tuple(r) for r in filter_audit.audit(docs, labels.limit(0)).collect())
    assert got == audit_by_hand(AUDIT_DOCS, [])


def test_audit_steps_add_up(llm):
    """The counts of an order's steps partition the documents."""
    import pandas as pd

    rng = np.random.default_rng(3)
    counts = pd.DataFrame({"part": "p", "code": np.arange(32), "n": rng.integers(0, 1 << 40, 32), "good": rng.integers(0, 9, 32), "toxic": 0})
    out = filter_audit.audit_part(counts)
    for _, steps in out.groupby("filter_order"):
        assert steps["removed"].sum() + steps["kept"].iloc[-1] == counts["n"].sum()
        assert steps["kept"].iloc[-1] == counts["n"].iloc[0]
    assert out.groupby(out["filter_order"].str.get(0))["shapley"].first().sum() == 120 * (counts["n"].sum() - counts["n"].iloc[0])


# ---- SentencePiece

ODD_TEXTS = [
    None, "", " ", "   ", "▁", "a▁ b", " lead", "trail ", "\n\t\r\n", "\x00x", "<s> </s> <unk> <0x41>", "é漢字ꦀ😀" * 20, "ﬁ①Ǻ​﻿",
    " " * 4999, "the" * 3000, "a" * 777, " 　 x", "don't WON'T 12345 3.14", "x" * 100_000,
]


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_model())


def random_texts(seed, n):
    rng = random.Random(seed)
    some = ["the ", "ing", " ", "▁", "漢", "é", "ꦀ", "\n", "Th", "a", "b", "c", "on", "0", "12", "<s>", "  ", "ll", "_", "😀"]
    return ["".join(rng.choice(some) for _ in range(rng.randrange(0, 120))) for _ in range(n)]


def rounds(texts):
    model = piece_bpe.load(piece_bpe.default_model())
    ids, back = [], []
    for _, data, off in tb.chunks_of(pa.array(texts, pa.string()), 1 << 12):
        flat, ends = piece_bpe.encode_rows(model, data, off)
        ids += [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
        back += piece_bpe.decode_rows(model, flat, ends)
    return ids, back


def test_rounds_equal_the_library():
    sp = library()
    rng = random.Random(7)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ODD_TEXTS + random_texts(1, 800)
    texts += ["".join(rng.choice(base64) for _ in range(20_000)), "".join(chr(rng.randrange(32, 0xD000)) for _ in range(20_000))]
    ids, back = rounds(texts)
    want = [sp.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    assert ids == want
    assert back == [sp.decode(x) for x in want]


def test_rounds_of_a_table_whose_ranks_do_not_grow():
    """A merged pair may make a pair of smaller rank; then the places after
    it wait. Compared with merging one place at a time."""
    rng = random.Random(5)
    for _ in range(200):
        n = 12
        pairs = [(a, b) for a in range(n) for b in range(n) if rng.random() < 0.4]
        left, right = (np.array(x, np.int32) for x in zip(*pairs))
        rank = np.array([rng.randrange(9) for _ in pairs], np.int32)
        merged = np.array([rng.randrange(n) for _ in pairs], np.int32)
        table = piece_bpe.PairTable(left, right, rank, merged, n)
        by = {p: (r, m) for p, r, m in zip(pairs, rank.tolist(), merged.tolist())}
        words = [[rng.randrange(n + 2) for _ in range(rng.randrange(1, 15))] for _ in range(20)]
        flat = np.array([s for w in words for s in w], np.int32)
        first = np.array([k == 0 for w in words for k in range(len(w))])
        out = piece_bpe.merge_rounds(table, flat, first)
        at = 0
        for w in words:
            got = [int(s) for s in out[at : at + len(w)] if s >= 0]
            at += len(w)
            while True:
                found = [(by[p][0], k) for k, p in enumerate(zip(w, w[1:])) if p in by]
                if not found:
                    break
                _, k = min(found)
                w = w[:k] + [by[w[k], w[k + 1]][1]] + w[k + 2 :]
            assert got == w


def test_words_whose_hashes_collide_are_kept_apart(monkeypatch):
    class Same:
        def __init__(self, *_):
            pass

        def ranges(self, start, end):
            return np.zeros(len(start), np.uint64)

    monkeypatch.setattr(tb, "PrefixHash", Same)
    sp = library()
    texts = random_texts(2, 60)
    assert rounds(texts)[0] == [sp.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_decoding_ids_that_no_text_gives():
    sp, model = library(), piece_bpe.load(piece_bpe.default_model())
    rng = random.Random(3)
    lists = [[], [1], [0], [2, 1, 0, 5], [200, 3], [259, 259]] + [[rng.randrange(len(sp)) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(20)] for _ in range(200)]
    flat = np.array([i for x in lists for i in x], np.int64)
    off = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert piece_bpe.decode_rows(model, flat, off) == [sp.decode(x) for x in lists]
    with pytest.raises(IndexError):
        piece_bpe.decode_rows(model, np.array([32_000]), np.array([0, 1]))


@pytest.mark.parametrize("packed", [False, True])
def test_encode_and_decode_frames(llm, packed):
    sp = library()
    rows = [(i if i % 5 else None, t, "x", 1) for i, t in enumerate(ODD_TEXTS + ODD_TEXTS[:3])]
    df = llm.createDataFrame(rows, "doc_id long, text string, ids string, c0 int").withColumnRenamed("ids", "c_ids")
    encoded = piece_bpe.encode(df, packed=packed)
    assert encoded.columns == ["doc_id", "c_ids", "c0", "ids"]
    out = piece_bpe.decode(encoded).collect()
    got = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4")) if packed else tuple(r.ids), r.decoded, r.c0) for r in out)
    want = [sp.encode(t or "", add_bos=True, add_eos=True) for _, t, _, _ in rows]
    assert got == Counter((r[0], tuple(x), sp.decode(x), 1) for r, x in zip(rows, want))
    assert piece_bpe.decode(piece_bpe.encode(df.limit(0), packed=packed)).count() == 0
    nulls = llm.createDataFrame([(1, None)], "a int, ids array<int>")
    assert piece_bpe.decode(nulls).first().decoded == ""


def test_query_equals_the_library(llm, sf_small):
    sp = library()
    got = {r.doc_id: r for r in QUERIES["op12_sentencepiece"](llm, sf_small).collect()}
    docs = llm.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = sp.encode(d.text or "", add_bos=True, add_eos=True)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


# ---- whitening


def dense(vectors, components=16):
    """By exact integers and a dense eigensolver."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    y = np.array((n * fit - s) / n, dtype=float)
    values, q = np.linalg.eigh(y.T @ y / n)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    z = np.array((n * np.array(x, dtype=object) - s) / n, dtype=float) @ q / np.sqrt(values)
    deviation = [int(((n * np.array(r, dtype=object) - s) ** 2).sum()) for r in x]
    return n, values, values / ((y * y).sum() / n), z, deviation


def check_whitened(df, ids, vectors, components=16):
    n, values, explained, z, deviation = dense(vectors, components)
    rows = df.collect()
    assert len(rows) == len(ids) * len(values)
    got = {(r.id, r.component): r for r in rows}
    sign = {}
    for i, name in enumerate(ids):
        for k in range(len(values)):
            r = got[name, k + 1]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert abs(r.explained - explained[k]) <= 1e-9
            assert r.identity_error <= 1e-9
            if k not in sign and abs(z[i, k]) > 0.1:
                sign[k] = math.copysign(1, r.whitened * z[i, k])
            assert abs(r.whitened * sign.get(k, 1) - z[i, k]) < 1e-6 or (k not in sign and abs(r.whitened) < 0.2)
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def frame(llm, vectors, parts=3):
    return llm.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS).repartition(parts)


@pytest.mark.parametrize("d,n", [(64, 700), (40, 300), (5, 50), (1, 9)])
def test_whitening_equals_a_dense_solver(llm, d, n):
    rng = np.random.default_rng(d)
    base = rng.standard_normal((n, d)) * np.linspace(3, 1, d) + 5
    vectors = [*base.astype(np.float32).tolist(), *base[:10].astype(np.float32).tolist()]
    rows = whitening.integer_rows(frame(llm, vectors))
    model = whitening.fit(rows)
    check_whitened(whitening.whiten(rows, model), range(len(vectors)), vectors)


def test_filter_is_at_work(llm):
    """A flat spectrum needs several filtered rounds; each is certified."""
    rng = np.random.default_rng(1)
    rows = whitening.integer_rows(frame(llm, rng.standard_normal((500, 80)).astype(np.float32).tolist()))
    model = whitening.fit(rows)
    assert model.rounds >= 2 and model.passes > model.rounds + 1
    with pytest.raises(RuntimeError):
        whitening.fit(rows, max_rounds=1)


def test_whitening_leaves_out_bad_vectors(llm):
    rng = np.random.default_rng(2)
    good = rng.standard_normal((30, 4)).astype(np.float32).tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0, 3.0], [nan, 1.0, 1.0, 1.0], [1.0, inf, 1.0, 1.0], [1.0, -inf, 1.0, 1.0], [1.0, 2.0]]
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(100 + i, v, 1) for i, v in enumerate(bad)]
    whole = whitening.integer_rows(llm.createDataFrame(rows, "vec_id long, embedding array<float>, x int"))
    check_whitened(whitening.whiten(whole, whitening.fit(whole)), range(30), good)


def test_whitening_without_spread(llm):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None]):
        rows = whitening.integer_rows(frame(llm, vectors))
        out = whitening.whiten(rows, whitening.fit(rows))
        assert out.count() == 0 and out.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # a dimension without spread gives no component
    rows = whitening.integer_rows(frame(llm, [[float(i), 7.0, -float(i * i)] for i in range(9)]))
    out = whitening.whiten(rows, whitening.fit(rows)).collect()
    assert {r.component for r in out} == {1, 2}
    # null ids stay, a deviation beyond a long is null
    df = llm.createDataFrame([(None, [2.0**40, 0.0]), (1, [0.0, 1.0]), (2, [-(2.0**40), 0.5])], "vec_id long, embedding array<double>")
    out = whitening.whiten(whitening.integer_rows(df), whitening.fit(whitening.integer_rows(df))).collect()
    assert {r.id for r in out} == {None, 1, 2} and any(r.deviation is None for r in out)


def test_whitening_query(llm, sf_small):
    vectors = {r.vec_id: r.embedding for r in llm.read.parquet(f"{sf_small}/embeddings.parquet").collect()}
    out = QUERIES["op13_whitening"](llm, sf_small).withColumnRenamed("vec_id", "id")
    check_whitened(out, list(vectors), list(vectors.values()))
