"""Dedup, packing, joins and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import components, decontam, exact_dedup, jaccard, packing, suffix_dedup, textbuf, toxicity
from cairn.llm.queries import QUERIES
from cairn.sources.tables import read_table

LOWER = {c: c + 32 for c in range(65, 91)}


# ---- helpers over buffers


def test_words_and_hashes_do_not_cross_rows():
    col = pa.array(["ab cd", None, "", "cd  éf", "ab"])
    data, off = textbuf.buffer_of(col)
    start, end, row = textbuf.words(data, off, textbuf.NOT_SPACE)
    got = [(int(r), bytes(data[s:e]).decode()) for s, e, r in zip(start, end, row)]
    assert got == [(0, "ab"), (0, "cd"), (3, "cd"), (3, "éf"), (4, "ab")]
    h = textbuf.PrefixHash(data).ranges(start, end)
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3
    assert (textbuf.fixed_ranges(data, start, 2) == textbuf.PrefixHash(data).ranges(start, start + 2)).all()
    sliced = col.slice(3)
    data, off = textbuf.buffer_of(sliced)
    assert bytes(data) == "cd  éfab".encode() and off.tolist() == [0, 7, 9]


# ---- exact dedup


def test_exact_dedup_edges(edge, empty):
    rows = [(r.doc_id, r.text or "") for r in edge.collect()]
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, (-1, None)), (i if i is not None else -1, i), key=lambda x: x[0])
    size = Counter(t for _, t in rows)
    for heavy, tracked in ((1, 16), (1024, 64)):
        got = exact_dedup.mark_duplicates(edge, heavy=heavy, tracked=tracked).collect()
        assert len(got) == len(rows)
        by = defaultdict(list)
        for r in got:
            by[r.digest].append(r)
        for t, n in size.items():
            group = by[hashlib.sha256(t.encode()).hexdigest()]
            assert [r.group_size for r in group] == [n] * n
            assert {r.keep_id for r in group} == {best[t][1]}
            assert [r.id for r in group if r.kept] == [best[t][1]]
    assert exact_dedup.mark_duplicates(empty).count() == 0


def test_exact_dedup_has_no_python(spark, sf_small):
    import re

    plan = QUERIES["op4_exact_dedup"](spark, sf_small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_rare_grams_equal_the_median_rule():
    rng = np.random.default_rng(1)

    class Some:
        owner = rng.integers(0, 40, 500)

    df = rng.integers(0, 60, 500).astype(float)
    want = [d <= 4.0 * max(1.0, np.median(df[Some.owner == o])) for d, o in zip(df, Some.owner)]
    assert decontam.rare(Some, df, 4.0).tolist() == want


def test_rare_grams_of_many_items_take_one_sort():
    import time

    class Many:
        owner = np.repeat(np.arange(25_000), 40)

    start = time.process_time()
    decontam.rare(Many, np.random.default_rng(2).integers(0, 9, len(Many.owner)).astype(float), 4.0)
    assert time.process_time() - start < 1


# ---- packing


def check_packing(rows, texts, capacity=2048):
    """Pieces cover each document, ids agree, sequences have no gaps."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [(0, len(ids))] if len(ids) <= capacity else [(0, first)] + [(s, capacity) for s in range(first, len(ids), capacity)]
        for k, (s, n) in enumerate(cuts):
            want[(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))] += 1
    assert Counter((r[0], r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), -(-sum(r.length for r in rows) // capacity)


def test_packing_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in read_table(spark, sf, "documents").collect()]
    used, bound = check_packing(QUERIES["op6_best_fit_packing"](spark, sf).collect(), texts)
    assert used <= bound * 1.01 + 1


def test_packing_edges(edge, empty):
    texts = [(r.doc_id, r.text) for r in edge.collect()]
    check_packing(packing.pack_documents(edge, capacity=64, block_items=4).collect(), texts, 64)
    assert packing.pack_documents(empty).count() == 0


def test_special_strings_are_ordinary_text(llm):
    texts = [(1, "a <|endoftext|> b"), (2, "  \n\n x\t\ty 's ’s 12345 ١٢ ½ 😀‍👩 <|endoftext|>")]
    check_packing(packing.pack_documents(llm.createDataFrame(texts, "doc_id long, text string")).collect(), texts)


def test_queries_read_added_tokens_as_the_tokenizer_does(llm, tmp_path, sf_small):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  \n <|endoftext|>  y <|endoftext", "é 😀<|endoftext|>'s", "plain"]
    want = {}
    for i, t in enumerate(texts):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want[i] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert 50256 in tok.encode(texts[0], add_special_tokens=False).ids
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for out in (QUERIES["op6_best_fit_packing"](llm, str(tmp_path)), dict(corpus_pipeline.STAGES)["packing"](llm, docs, sf_small)):
        assert {r[0]: (r.length, r.ids_crc32) for r in out.collect()} == want


def test_genetic_steps_keep_valid_packings_and_do_not_get_worse():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 700, 600))[::-1].astype(np.int64)
    start, none, bins = packing.evolve(lengths, [], 1000, 1, 0, 4)
    assert (none, bins) == (0, len(start[0].room))
    pop, _, _ = packing.evolve(lengths, start, 1000, 1, 12, 4)
    for p in pop + [packing.crossover(pop[0], pop[1], lengths, 0.4, rng), packing.mutate(pop[0], lengths, rng)]:
        load = np.bincount(p.bin, weights=lengths, minlength=len(p.room))
        assert (p.bin >= 0).all() and load.max() <= 1000
        assert (load == 1000 - np.array(p.room)).all() and (load > 0).all()
    assert pop[0].fitness() >= start[0].fitness()
    assert len(pop[0].room) <= -(-lengths.sum() // 1000) * 1.02 + 1


def triplets(k, capacity, rng):
    """Lengths of which every three fill a bin exactly; best-fit misses that."""
    out = []
    for _ in range(k):
        a = int(rng.integers(capacity * 38 // 100, capacity * 49 // 100))
        b = int(rng.integers(capacity // 4 + 1, max((capacity - a) // 2 + 1, capacity // 4 + 2)))
        out += [a, b, capacity - a - b]
    return np.sort(np.array(out, dtype=np.int64))[::-1].copy()


@pytest.mark.parametrize("k", [20, 100, 400])
def test_genetic_search_beats_best_fit(k):
    lengths = triplets(k, 2048, np.random.default_rng(k))
    pop, done, best_fit = packing.evolve(lengths, [], 2048, 1, packing.GENERATIONS, packing.POPULATION)
    assert best_fit >= k * 1.1  # a tenth more than needed
    assert len(pop[0].room) <= k * 1.05 and done > 0
    load = np.bincount(pop[0].bin, weights=lengths)
    assert load.max() <= 2048 and (load == 2048 - np.array(pop[0].room)).all()


def lengths_frame(llm, lengths):
    rows = [(i, i, 0, 0, int(n), 0) for i, n in enumerate(lengths)]
    return llm.createDataFrame(rows, packing.PIECES.format(id_type="long"))


def packed_bins(out, lengths, capacity):
    rows = out.collect()
    assert sorted((r.row, r.length) for r in rows) == [(i, int(n)) for i, n in enumerate(lengths)]
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spots in bins.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_reports_what_the_search_saves(llm):
    lengths = triplets(120, 1000, np.random.default_rng(5))
    report = []
    used = packed_bins(packing.pack(lengths_frame(llm, lengths), 1000, block_items=180, report=report), lengths, 1000)
    assert report[0]["blocks"] == 2 and report[0]["generations"] > 0
    assert report[0]["bins"] < report[0]["best_fit"]
    assert used < len(packing.pack_order(lengths, range(len(lengths)), 1000).room)


def test_blocks_share_what_they_leave(llm):
    """Twenty blocks would each leave a bin half full; together they do not."""
    lengths = np.sort(np.random.default_rng(6).integers(1, 300, 1500))[::-1]
    report = []
    used = packed_bins(packing.pack(lengths_frame(llm, lengths), 1000, block_items=75, report=report), lengths, 1000)
    bound = -(-int(lengths.sum()) // 1000)
    assert len(report) > 1 and report[0]["bins"] > bound + 5
    assert used <= bound + 2


def test_pieces_that_pair_with_nothing_end(llm):
    lengths = np.full(64, 600)
    assert packed_bins(packing.pack(lengths_frame(llm, lengths), 1000, block_items=8), lengths, 1000) == 64


# ---- suffix dedup


def brute_removal(rows, n=100):
    seen, out = set(), defaultdict(list)
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            w = b[s : s + n]
            if w in seen:
                gone[s : s + n] = b"\1" * n
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i].append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def removal_of(frame, **options):
    out = defaultdict(list)
    for r in suffix_dedup.dedup_substrings(frame, **options).collect():
        out[r.id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    return {k: sorted(v) for k, v in out.items()}


def ordered(frame):
    rows = [(r.doc_id, (r.text or "").encode()) for r in frame.collect()]
    return sorted(rows, key=lambda r: -1 if r[0] is None else r[0])


def test_substrings_edges(llm, edge, empty):
    small = edge.where("doc_id <> 8 or doc_id is null")
    assert removal_of(small) == brute_removal(ordered(small))
    rows = [(1, "xy" * 80), (2, "yx" * 60), (3, "a" * 250), (4, "a" * 99), (5, "a" * 100), (6, "q" + "é" * 60), (7, "é" * 60)]
    rows += [(8, "ab" * 50 + "Z" + "ab" * 50), (9, "Z" + "ab" * 51)]
    rows += [(20 + i, f"{i} lead " * (i % 5) + "a common passage of words, " * 5 + f"tail {i * 7919} " * (i % 9)) for i in range(60)]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    assert removal_of(frame) == brute_removal(ordered(frame))
    assert removal_of(empty) == {}


def test_runs_around_frequent_substrings_are_taken_apart(llm, edge):
    # a phrase shorter than a window in all texts, some of which are equal beyond it
    rng = np.random.default_rng(11)
    noise = ["".join(rng.choice(list("abcdefgh "), 90)) for _ in range(40)]
    phrase = "Permission is granted to anyone, provided that this notice stays in."  # 68 bytes
    rows = [(i, noise[i * 7 % 40] + phrase + noise[i * 3 % 40][: 20 + i]) for i in range(60)]
    frame = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_removal(ordered(frame))
    assert any(r[0][1] for r in want.values())
    slim = frame.selectExpr("doc_id AS id", "doc_id AS row", "text")
    some = suffix_dedup.hot_cells(slim, 20)
    assert 0 < some.sum() < 100 and suffix_dedup.hot_cells(slim, -1).all()
    for hot in (20, -1):
        assert removal_of(frame, hot=hot) == want
    small = edge.where("doc_id <> 8 or doc_id is null")
    assert removal_of(small, hot=-1) == brute_removal(ordered(small))


def test_long_texts_are_cut_into_overlapping_segments(llm, monkeypatch):
    rng = np.random.default_rng(5)
    body = "".join(rng.choice(list("abcd"), 3000))
    batch = pa.RecordBatch.from_pydict({"id": [1], "row": [0], "text": [body]})
    whole = {(int(e), int(n)) for _, _, _, d, o in suffix_dedup._chunks(batch) for _, s, n_, *_ in [suffix_dedup.runs_of(d, o)] for e, n in zip(s, n_)}
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 500)
    windows = []
    for _, _, base, d, o in suffix_dedup._chunks(batch):
        _, s, n, *_ = suffix_dedup.runs_of(d, o)
        windows += [base + int(a) + k for a, m in zip(s, n) for k in range(m)]
    assert sorted(windows) == list(range(3000 - 99)) == sorted(s + k for s, n in whole for k in range(n))


def test_suffix_sort_agrees_with_plain_sort_and_verifies():
    rng = np.random.default_rng(8)
    text = np.frombuffer("".join(rng.choice(list("ab"), 4000)).encode(), np.uint8)
    start = rng.integers(0, 3900, 500)
    stop = np.minimum(start + rng.integers(1, 60, 500), 4000)
    group = rng.integers(0, 7, 500)
    s = suffix_dedup.Suffixes(text, start, stop)
    key = lambda i: (group[i], bytes(text[start[i] : stop[i]]), i)
    order = s.sort(group)
    assert order.tolist() == sorted(range(500), key=key)
    near = s.neighbours(order, group)
    for k in range(1, 500):
        a, b = (bytes(text[start[i] : stop[i]]) for i in (order[k - 1], order[k]))
        common = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert near[k] == (common if group[order[k]] == group[order[k - 1]] else -1)
    # a collision is found: extensions that claim too much are cut back
    assert s.verified(np.array([0]), np.array([1]), np.array([50]))[0] == next(n for n in range(50) if text[n] != text[n + 1])


# ---- Jaccard join


def brute_components(rows, size, num, den):
    sets = {}
    for i, t in rows:
        w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (t or "").translate(LOWER)).split(" ") if x]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = sorted(sets)
    for a in items:
        for b in items:
            if a < b and sets[a] and sets[b]:
                c = len(sets[a] & sets[b])
                if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in items}


def test_jaccard_against_brute_force(llm):
    rng = np.random.default_rng(4)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = list(rng.choice(vocab, int(rng.integers(3, 120))))
        for _ in range(int(rng.integers(1, 14))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 6))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(vocab))
            rows.append((len(rows), " ".join(copy) if rng.random() < 0.8 else " ".join(base).upper()))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "ONE"), (1005, "one two")]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    for size, num, den in ((4, 85, 100), (5, 80, 100), (2, 50, 100)):
        want = brute_components(rows, size, num, den)
        got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.find_components(frame, size=size, num=num, den=den).collect()}
        assert got == want


def families(n, rng):
    """Two families of ``n`` near copies that share a passage and do not
    link, and some texts of both kinds in between."""
    passage = [f"p{k}" for k in range(30)]
    texts = []
    for name in "ab":
        body = [f"{name}{k}" for k in range(90)]
        for i in range(n):
            one = list(body)
            one[rng.randrange(90)] = f"{name}x{i}"
            texts.append(" ".join(passage + one))
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [2, 2048])
def test_lists_in_blocks_lose_no_link(llm, block):
    rng = random.Random(block)
    rows = families(25, rng)
    words = [f"w{k}" for k in range(40)]
    for i in range(60):  # overlapping random texts, so that groups are many and lists cross them
        at = rng.randrange(20)
        rows.append((1000 + i, " ".join(words[at : at + rng.randrange(6, 21)])))
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    for num in (60,):
        got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.find_components(frame, size=3, num=num, den=100, block=block).collect()}
        assert got == brute_components(rows, 3, num, 100)


def test_two_families_that_share_a_passage_make_few_pairs(llm, monkeypatch):
    made = []
    plain = jaccard.cross_pairs

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "cross_pairs", counted)
    n = 200
    rows = families(n, random.Random(1))
    got = jaccard.find_components(llm.createDataFrame(rows, "doc_id long, text string"), block=64).collect()
    assert {r.component_id for r in got} == {0, n}
    assert made[0] < 4 * n  # not n * n


def test_sketch_parts_add_up_in_a_tree(llm):
    from cairn.llm.sketches import summed_parts
    from cairn.session import cut_lineage

    rng = np.random.default_rng(1)
    rows = [(p, rng.integers(0, 9, 4).astype("<i8")) for _ in range(50) for p in range(3)]
    table = cut_lineage(llm.createDataFrame([(p, x.tobytes()) for p, x in rows], "part int, counts binary"), "sketch_test")
    got = {r.part: np.frombuffer(bytes(r.counts), "<i8").tolist() for r in summed_parts(table, 3).collect()}
    assert got == {p: sum(x for q, x in rows if q == p).tolist() for p in range(3)}


def test_sums_are_finished_in_their_own_python_step(llm):
    from cairn.llm.jaccard import _classes
    from cairn.llm.sketches import summed_parts

    rows = [(p, np.arange(4, dtype="<i8").tobytes()) for p in range(3) for _ in range(5)]
    table = llm.createDataFrame(rows, "part int, counts binary")
    out = summed_parts(table, 3, _classes, "part int, classes binary")
    # two Python steps, and a shuffle between them: no task has two workers
    steps = re.findall(r"MapInArrow|Exchange", out._jdf.queryExecution().executedPlan().toString())
    assert steps.count("MapInArrow") == 2 and ("MapInArrow", "MapInArrow") not in zip(steps, steps[1:])
    want = np.minimum(255, 8 * np.log2(1 + 5 * np.arange(4))).astype(np.uint8).tolist()
    assert {r.part: list(bytes(r.classes)) for r in out.collect()} == dict.fromkeys(range(3), want)


def test_training_rows_are_read_where_they_are():
    rows = [np.sort(np.random.default_rng(i).choice(1 << 12, 30, replace=False)) for i in range(60)]
    labels = np.arange(60) % 2
    got, want = (toxicity.ftrl([r.astype(kind) for r in rows], labels, bits=12) for kind in (np.int32, np.int64))
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1]) and got[2] == want[2]


def test_jaccard_edges(edge, empty):
    got = jaccard.find_components(edge).collect()
    assert len(got) == 16
    by = {(r.id, r.n_shingles): r.component_id for r in got}
    assert by[(13, 1)] == 12 and by[(5, 1)] == 4 and by[(None, 1)] == 4
    assert by[(1, 0)] == 1 and by[(3, 0)] == 3 and by[(None, 0)] is None
    assert jaccard.find_components(empty).count() == 0


def test_bounds_settle_pairs_from_a_shared_partner(llm):
    known = llm.createDataFrame([(1, 2, 100, 100, 98), (1, 3, 100, 100, 97), (1, 4, 100, 100, 40)], "a long, b long, n long, m long, overlap long")
    pairs = llm.createDataFrame([(2, 3), (2, 4), (5, 6)], "a long, b long")
    got = {(r.a, r.b): (r.low, r.high) for r in jaccard.settle(pairs, known, 85, 100).collect()}
    assert got == {(2, 3): (95, 99), (2, 4): (38, 42), (5, 6): (None, None)}


def test_components_of_chains_and_stars(llm):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


# ---- decontamination


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.integers(0, 6, 15).astype(np.uint64), rng.integers(0, 6, 40).astype(np.uint64)
        h = np.zeros((16, 41), int)
        for i in range(1, 16):
            for j in range(1, 41):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, end = decontam.smith_waterman(a, b)
        assert score == h.max() and h[:, end].max() == score


def test_leaks_equal_the_alignment_of_all_pairs(llm, sf_small):
    """Every document of the table and planted edits against every item."""
    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in read_table(llm, sf_small, "benchmark").collect()]
    docs = [(r.doc_id, r.text) for r in read_table(llm, sf_small, "documents").collect()]
    for k, (_, text) in enumerate(items):
        w = text.split()
        for j in range(rng.randrange(len(w))):
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = f"edit{j}"
        docs.append((10_000 + k, " ".join(["before it"] * 20 + w + ["after it"] * 20)))
    frame = llm.createDataFrame(docs, "doc_id long, text string")
    bench = llm.createDataFrame([(*x, "d", 1) for x in items], "item_id long, text string, doc_id string, row int")
    got = {(r.id, r.item_id): r.score for r in decontam.find_leaks(frame, bench).collect()}

    def hashes(text):
        return decontam.word_hashes(*textbuf.buffer_of(pa.array([text or ""], pa.string())))[0]

    want = {}
    for item, text in items:
        w = hashes(text)
        size = min(decontam.N, len(w))
        grams = decontam.join(w, size)
        for doc, body in docs:
            v = hashes(body)
            if size and np.isin(decontam.join(v, size), grams).any():
                score = decontam.smith_waterman(w, v)[0] / (decontam.MATCH * len(w))
                if score >= decontam.THRESHOLD:
                    want[doc, item] = score
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert sum(d >= 10_000 for d, _ in got) > 20


def test_leaks_planted_and_clean(llm, edge, empty):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 8))))
    prose = lambda n: [word() for _ in range(n)]
    items = {k: prose(int(rng.integers(15, 55))) for k in range(30)}
    docs, want = [], set()
    for k, w in items.items():
        edited = list(w)
        for j in range(4, len(edited), 6):
            edited[j] = word()
        noisy = [x.upper() + "!!" for x in w]
        dropped = [x for j, x in enumerate(w) if j % 7 != 3]
        for variant in (w, edited, noisy, dropped):
            docs.append((len(docs), " ".join(prose(40) + variant + prose(60))))
            want.add((docs[-1][0], k))
    clean = [(1000 + k, " ".join(prose(200) + items[k][:4] + prose(100))) for k in items]
    frame = llm.createDataFrame(docs + clean, "doc_id long, text string")
    bench = llm.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    for block in (1_000_000, 300):
        got = {(r.id, r.item_id) for r in decontam.find_leaks(frame, bench, block_grams=block).collect()}
        assert got == want
    extra = llm.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "tie", "z"), (3, "tie", "z"), (None, "a b c d", "z")], "item_id long, text string, row string")
    got = sorted((str(r.id), str(r.item_id), r.score) for r in decontam.find_leaks(edge, extra).collect())
    assert ("12", "None", 1.0) in got and ("4", "3", 1.0) in got and all(g[2] >= 0.5 for g in got)
    assert decontam.find_leaks(empty, bench).count() == 0
    assert decontam.find_leaks(frame, bench.limit(0)).count() == 0


def test_edited_passages_in_many_documents_are_found(llm):
    # every 4th word replaced: fewer than half of the n-grams are left, and
    # as many documents hold the rest as share the passage
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    prose = lambda n: [word() for _ in range(n)]
    items = {k: prose(40) for k in (5, 1000)}
    bench = llm.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    docs, want = [], set()
    for k, w in items.items():
        edited = " ".join(word() if j % 4 == 3 else x for j, x in enumerate(w))
        for _ in range(k):
            want.add((len(docs), k))
            docs.append((len(docs), f"{word()} {word()} {edited} {word()}"))
    clean = [(10_000 + i, " ".join(prose(20) + items[5][4 * i : 4 * i + 3] + prose(20))) for i in range(9)]
    frame = llm.createDataFrame(docs + clean, "doc_id long, text string")
    assert {(r.id, r.item_id) for r in decontam.find_leaks(frame, bench).collect()} == want
    assert {r.doc_id for r in decontam.without_leaks(frame, bench).collect()} == {i for i, _ in clean}


def test_rarity_does_not_change_the_result(llm):
    docs = read_table(llm, "/root/testdata/sf0.01", "documents")
    bench = read_table(llm, "/root/testdata/sf0.01", "benchmark")
    for threshold in (0.5, 0.2):
        every, none = (sorted(map(tuple, decontam.find_leaks(docs, bench, rarity=r, threshold=threshold).collect())) for r in (1e9, 0.0))
        assert every and every == none


def test_no_alignment_scores_more_than_its_reach():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = rng.integers(0, 12, 15).astype(np.uint64), rng.integers(0, 20, int(rng.integers(1, 60))).astype(np.uint64)
        assert decontam.smith_waterman(a, b)[0] <= decontam.reach(a, b)


def test_repeated_benchmark_rows_do_not_fill_a_block(llm):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(60)]
    bench = llm.createDataFrame(rows + rows[:1] * 3000, "item_id long, text string")
    docs = llm.createDataFrame([(k, t) for k, t in rows], "doc_id long, text string")
    sizes = [len(bc.value.gram) for bc in decontam.seeded_blocks(docs.select("text"), decontam._tests(bench, "item_id", "text"), 3, 4.0, 2000)]
    assert sum(sizes) == 60 * 18 and max(sizes) <= 4000
    assert {(r.id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == {(k, k) for k in range(60)}


def test_query_finds_every_verbatim_copy(spark):
    import re

    sf = "/root/testdata/sf0.01"
    norm = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER))) + " "
    items = [(r.item_id, norm(r.text)) for r in read_table(spark, sf, "benchmark").collect()]
    want = {(d.doc_id, i) for d in read_table(spark, sf, "documents").collect() for i, t in items if t in norm(d.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, sf).collect()}
    assert want and want <= got and len(got) <= len(want) + 3


# ---- pipeline


def test_pipeline_stages_on_edges(llm, edge, empty, sf_small):
    docs = edge
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, sf_small)
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(llm, empty, sf_small).count() == 0
    after = [r.text for r in corpus_pipeline.drop_copies(llm, edge, sf_small).collect()]
    assert sorted(map(str, after)) == sorted({str(t or "") if t else str(t) for t in after}) and len(after) == 11


def test_pipeline_row_keys_and_odd_columns(llm, tmp_path, sf_small):
    # the same keys however files are split, also beside a column called _metadata
    text = "some words that are long enough to be shingled and compared " * 3
    rows = [(i % 40, text + str(i % 50), float(i), "m") for i in range(400)]
    made = llm.createDataFrame(rows, "doc_id long, text string, `odd.name` double, _metadata string")
    made.repartition(7).write.parquet(str(tmp_path / "docs"))
    docs = llm.read.parquet(str(tmp_path / "docs"))
    keys = lambda: {bytes(r[0].file).hex() + str(r[0].at): r[1] for r in corpus_pipeline._numbered(docs).select(corpus_pipeline.ROW, "`odd.name`").collect()}
    first = keys()
    before = llm.conf.get("spark.sql.files.maxPartitionBytes")
    llm.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert keys() == first and len(first) == 400
    finally:
        llm.conf.set("spark.sql.files.maxPartitionBytes", before)
    for frame in (docs, made):
        kept = corpus_pipeline.drop_copies(llm, frame, sf_small)
        assert kept.columns == made.columns and kept.count() == 50
        assert corpus_pipeline.drop_near_copies(llm, frame, sf_small).count() == 1
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_leaks):
            assert stage(llm, frame, sf_small).columns == made.columns


def test_filter_drops_what_the_search_finds(llm, edge, sf_small):
    docs = read_table(llm, "/root/testdata/sf0.01", "documents")
    bench = read_table(llm, "/root/testdata/sf0.01", "benchmark").withColumn("item_id", F.concat(F.lit("item "), "item_id"))
    for block in (1_000_000, 200):
        found = {r.id for r in decontam.find_leaks(docs, bench, block_grams=block).collect()}
        left = {r.doc_id for r in decontam.without_leaks(docs, bench, block_grams=block).select("doc_id").collect()}
        assert found and left == {r.doc_id for r in docs.select("doc_id").collect()} - found
    assert decontam.without_leaks(edge, bench.limit(0)).count() == edge.count()


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = read_table(spark, sf, "documents")
    kept = corpus_pipeline.drop_copies(spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    best = {}
    for i, t in rows:
        best[t or ""] = max(i, best.get(t or "", -1))
    assert {r.doc_id for r in kept.collect()} == set(best.values())
    near = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    groups = defaultdict(set)
    for i, (_, root) in brute_components(rows, 5, 80, 100).items():
        groups[root].add(i)
    assert all(len(g & near) == 1 for g in groups.values()) and len(near) == len(groups)
    out = corpus_pipeline.run(spark, sf).collect()
    texts = {i: t for i, t in rows}
    left = {r.doc_id for r in out}
    assert left < near | set(best.values()) and len(left) > 0.8 * len(near)
    check_packing(out, [(i, texts[i]) for i in left])
