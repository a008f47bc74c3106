"""Secret scan: fixed patterns plus a character convolutional network.

Base findings are the leftmost non-overlapping matches of three patterns
(``assign``, ``access``, ``hex``), those that are too short dropped.

The network judges every other candidate: a run of 16 or more characters of
``[A-Za-z0-9+/_.=-]`` with at least one that is not a letter, dot or hyphen,
or with letters of both cases; and a run of 8 or more that follows a name and
``:`` or ``=``, unless it lies in a longer candidate. It sees the candidate and ``CONTEXT`` characters on both sides; a long
candidate is judged in overlapping segments and takes their largest score.
It is a one-layer convolution over character embeddings with max pooling,
trained in numpy on labelled findings: all different candidates of the corpus
whose label is known, positive when a base finding covers them and negative
when they are uuids, dates, versions, paths, rules or plain words; and
``GENERATED`` ones from public shapes of keys and passwords and of look-alikes,
some of which only the name before them tells apart. Any other candidate of the
corpus may be a key that no pattern knows and is not learnt from. A finding is
learnt with all its segments. Findings of the corpus are dealt by hash to shards
of about ``SHARD`` segments. One shard is trained in one task; of several,
every epoch each learns from its own and the generated findings, starting from
the mean of what all had learnt before, and their scores come back for
calibration as counts of all findings by label and logit (floored to
1 / ``GRID``). Findings are split in three by their own hash: three fifths fit the
weights; one fifth calibrates the scores (a temperature and an offset) and
sets the threshold, the largest that still finds ``min_recall`` of the
generated positives and of the corpus ones, each by themselves, whatever
precision that costs; the last fifth only measures recall and precision, of
either source apart (``Net.measured``). Candidates at or above the threshold
that no base finding overlaps become findings of kind ``cnn``. Only the weights
(a few thousand numbers) are broadcast.

Offsets count code points, ends are exclusive. Null texts count as empty and
have no findings. Rows with equal ids are scanned one by one; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import pickle
import re
import string
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb
from cairn.session import cut_lineage

# fixed patterns of the contract; group 2 of assign is the value
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "cnn")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
TELLING = re.compile(r"[0-9+/_=]")
NAMED = re.compile(r"(?<=[A-Za-z0-9_])[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?([A-Za-z0-9+/_.=-]{8,})")

# what is surely no secret, unless a name says so
LOOKALIKE = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9.:+-]*Z?)?"
    r"|(?:[a-z]{2,12}-){0,2}v?[0-9]{1,3}(?:\.[0-9]{1,3}){1,3}(?:-[a-z]{2,12}){0,2}"
    r"|/{0,2}(?:[a-z]{1,12}[/.-])+[a-z]{1,12}[0-9]{0,3}/?"
    r"|[+/_.=-]+"
    r"|[A-Z]?[a-z]{1,15}\.?"
)
SECRET_NAME = re.compile(r"(?i)pass|pwd|secret|token|key|cred|auth|login|bearer|sign|private|phrase")

CONTEXT = 24
SEGMENT = 48
WIDTH = CONTEXT + SEGMENT + CONTEXT
SHARD = 4000  # segments of corpus findings that one task learns from
GRID = 1024  # steps of a logit in which the shards' scores are counted
GENERATED = 8000
MIN_RECALL = 0.95
EPOCHS, RATE, SEED = 12, 0.01, 7

ALPHABET = string.printable
CODE = np.full(256, len(ALPHABET) + 1, np.int64)
for _i, _c in enumerate(ALPHABET):
    CODE[ord(_c)] = _i + 1
VOCAB = len(ALPHABET) + 2  # 0 pads, the last stands for other characters
EMBED, KERNEL, FILTERS, HIDDEN = 8, 5, 24, 16


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in the contract's order."""
    out = []
    # a cheap look at the text spares most of them the slower patterns
    low = text.translate(_LOWER)
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), 2) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


_LOWER = {c: c + 32 for c in range(65, 91)}
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # runs of HEX of 32 or more


def candidates(text: str) -> list[tuple[int, int]]:
    out = [m.span() for m in CANDIDATE.finditer(text) if TELLING.search(m[0]) or m[0].lower() != m[0] != m[0].upper()]
    starts = [a for a, _ in out]
    named = []
    for m in NAMED.finditer(text):
        a, b = m.span(1)
        i = bisect.bisect_right(starts, a)
        if not (i and out[i - 1][1] >= b):
            named.append((a, b))
    return sorted(out + named)


def is_lookalike(text: str, start: int, end: int) -> bool:
    return bool(LOOKALIKE.fullmatch(text, start, end)) and not SECRET_NAME.search(text, max(0, start - CONTEXT), end)


def segments(text: str, start: int, end: int) -> list[np.ndarray]:
    """Coded windows over a candidate: context, segment, context."""
    out = []
    step = SEGMENT // 2
    for s in range(start, max(start + 1, end - step), step):
        e = min(s + SEGMENT, end)
        left = text[max(0, s - CONTEXT) : s].rjust(CONTEXT, "\0")
        body = text[s:e].ljust(SEGMENT, "\0")
        right = text[e : e + CONTEXT].ljust(CONTEXT, "\0")
        out.append(encode(left + body + right))
        if e == end:
            break
    return out


def encode(s: str) -> np.ndarray:
    points = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    code = CODE[np.minimum(points, 255)]
    code[points > 255] = VOCAB - 1
    code[points == 0] = 0
    return code


@dataclass
class Net:
    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1  # nothing passes before calibration
    measured: dict[str, float] | None = None  # recall and precision of the last fifth, by source

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([_forward(self.weights, x[i : i + 256])[0] for i in range(0, len(x), 256)])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -30, 30)))


def _forward(w, x):
    e = w["embed"][x]  # n, width, embed
    n = len(x)
    steps = WIDTH - KERNEL + 1
    cols = np.lib.stride_tricks.sliding_window_view(e, KERNEL, axis=1).transpose(0, 1, 3, 2).reshape(n, steps, KERNEL * EMBED)
    conv = np.maximum(cols @ w["conv"] + w["conv_b"], 0)
    # context and candidate are pooled apart, so that both count
    mid = conv[:, CONTEXT - 2 : CONTEXT + SEGMENT - 2]
    side = np.concatenate([conv[:, : CONTEXT - 2], conv[:, CONTEXT + SEGMENT - 2 :]], axis=1)
    pooled = np.concatenate([mid.max(axis=1), mid.mean(axis=1), side.max(axis=1)], axis=1)
    hidden = np.maximum(pooled @ w["dense"] + w["dense_b"], 0)
    return hidden @ w["out"] + w["out_b"], (cols, conv, mid, side, pooled, hidden)


def _gradients(w, x, y):
    z, (cols, conv, mid, side, pooled, hidden) = _forward(w, x)
    n = len(x)
    dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
    g = {"out": hidden.T @ dz, "out_b": np.array(dz.sum())}
    dh = np.outer(dz, w["out"]) * (hidden > 0)
    g["dense"], g["dense_b"] = pooled.T @ dh, dh.sum(0)
    dp = dh @ w["dense"].T
    dconv = np.zeros_like(conv)
    at = np.arange(n)[:, None], np.arange(FILTERS)[None]
    np.add.at(dconv, (at[0], CONTEXT - 2 + mid.argmax(1), at[1]), dp[:, :FILTERS])
    dconv[:, CONTEXT - 2 : CONTEXT + SEGMENT - 2] += dp[:, None, FILTERS : 2 * FILTERS] / mid.shape[1]
    place = side.argmax(1)
    place = np.where(place >= CONTEXT - 2, place + SEGMENT, place)
    np.add.at(dconv, (at[0], place, at[1]), dp[:, 2 * FILTERS :])
    dconv *= conv > 0
    g["conv"] = cols.reshape(-1, KERNEL * EMBED).T @ dconv.reshape(-1, FILTERS)
    g["conv_b"] = dconv.sum((0, 1))
    dcols = (dconv @ w["conv"].T).reshape(n, -1, KERNEL, EMBED)
    demb = np.zeros((n, WIDTH, EMBED))
    for k in range(KERNEL):
        demb[:, k : k + dcols.shape[1]] += dcols[:, :, k]
    flat, parts = x.ravel(), demb.reshape(-1, EMBED)
    g["embed"] = np.stack([np.bincount(flat, weights=parts[:, k], minlength=VOCAB) for k in range(EMBED)], axis=1)
    return g


class Findings:
    """Labelled findings: a row per segment, with the finding it belongs to,
    its label, its part (0-2 fit, 3 calibrate, 4 measure) and its source."""

    def __init__(self, codes: list[np.ndarray], labels, corpus: bool):
        """``codes``: the segments of each finding (n, width)."""
        self.x = np.concatenate(codes).astype(np.uint8) if len(codes) else np.zeros((0, WIDTH), np.uint8)
        self.finding = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        self.y = np.array(labels, dtype=bool)
        parts = [zlib.crc32(np.ascontiguousarray(c, np.uint8).tobytes()) % 5 for c in codes]
        self.part = np.array(parts, dtype=np.int64)
        self.corpus = np.full(len(codes), corpus)

    def with_(self, other: Findings) -> Findings:
        out = Findings([], [], False)
        out.x = np.concatenate([self.x, other.x])
        out.finding = np.concatenate([self.finding, other.finding + len(self.y)])
        for name in ("y", "part", "corpus"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name)]))
        return out

    def largest(self, score: np.ndarray) -> np.ndarray:
        """Largest score of each finding's segments."""
        out = np.full(len(self.y), -np.inf)
        np.maximum.at(out, self.finding, score)
        return out


State = tuple[dict[str, np.ndarray], dict[str, np.ndarray], dict[str, np.ndarray]]  # weights and Adam's moments


def start(rng) -> State:
    w = {
        "embed": rng.normal(0, 0.3, (VOCAB, EMBED)),
        "conv": rng.normal(0, 0.3, (KERNEL * EMBED, FILTERS)),
        "conv_b": np.zeros(FILTERS),
        "dense": rng.normal(0, 0.2, (3 * FILTERS, HIDDEN)),
        "dense_b": np.zeros(HIDDEN),
        "out": rng.normal(0, 0.2, HIDDEN),
        "out_b": np.array(0.0),
    }
    return w, {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}


def learn(state: State, data: Findings, rng, first: int, last: int, epochs: int, rate: float) -> State:
    """Epochs ``first`` to ``last`` (exclusive) of ``epochs``, by Adam on three
    fifths of the findings."""
    w, m, v2 = (dict(x) for x in state)
    fits = np.flatnonzero((data.part < 3)[data.finding])
    y = data.y[data.finding].astype(float)
    steps = -(-len(fits) // 64)
    t, steps = first * steps, epochs * steps
    for _ in range(first, last):
        order = rng.permutation(fits)
        for i in range(0, len(order), 64):
            t += 1
            step = rate * (1 - 0.9 * t / max(steps, 1))  # falls to a tenth
            take = order[i : i + 64]
            for k, g in _gradients(w, data.x[take], y[take]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                w[k] = w[k] - step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.999**t)) + 1e-8)
    return w, m, v2


def calibrate(net: Net, z: np.ndarray, y: np.ndarray, part: np.ndarray, corpus: np.ndarray, n: np.ndarray) -> Net:
    """Scores and threshold from one fifth of the findings, measures from
    another; each row is a logit that ``n`` findings have."""
    mid = part == 3
    cz, cy, cn = z[mid], y[mid].astype(float), n[mid]
    for _ in range(200 if len(cz) else 0):  # temperature and offset by gradient descent
        p = 1 / (1 + np.exp(-np.clip(net.scale * cz + net.shift, -30, 30)))
        net.scale -= 0.05 * float(((p - cy) * cz * cn).sum() / cn.sum())
        net.shift -= 0.05 * float(((p - cy) * cn).sum() / cn.sum())
    p = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -30, 30)))
    for source in (False, True):
        at = np.flatnonzero(mid & y & (corpus == source))
        if len(at):
            at = at[np.argsort(-p[at], kind="stable")]
            reached = np.cumsum(n[at])
            last = np.searchsorted(reached, int(np.ceil(MIN_RECALL * reached[-1])))
            net.threshold = min(net.threshold, float(p[at[last]]))
    passes = p >= net.threshold
    share = lambda what, among: float(n[what & among].sum() / n[among].sum())
    for name, source in (("generated", False), ("corpus", True)):
        last = (part == 4) & (corpus == source)
        if (last & y).any():
            net.measured[f"{name}_recall"] = share(passes, last & y)
        if (last & passes).any():
            net.measured[f"{name}_precision"] = share(y, last & passes)
        if (last & ~y).any():
            net.measured[f"{name}_false_alarms"] = share(passes, last & ~y)
    return net


def train(data: Findings, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Net:
    """Fit, calibrate and measure with findings that one task holds."""
    rng = np.random.default_rng(seed)
    net = Net(learn(start(rng), data, rng, 0, epochs, epochs, rate)[0], measured={})
    if not len(data.x):
        return net
    z = data.largest(net.logits(data.x))
    return calibrate(net, z, data.y, data.part, data.corpus, np.ones(len(z), np.int64))


def generated_findings(n: int, seed: int = 11) -> Findings:
    """Labelled findings made from public shapes: keys and look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, k: "".join(rng.choice(list(chars), size=k))
    alnum, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    word = lambda: pick(string.ascii_lowercase, int(rng.integers(2, 9)))
    keys = [
        lambda: pick(alnum, 40),
        lambda: "ghp_" + pick(alnum, 36),
        lambda: "sk_live_" + pick(alnum, 24),
        lambda: "xoxb-" + pick(string.digits, 12) + "-" + pick(alnum, 24),
        lambda: "AIza" + pick(alnum + "_-", 35),
        lambda: "AIzaSy" + pick(alnum, 1) + "-" + pick(alnum + "_-", 31),
        lambda: "eyJ" + pick(alnum, 20) + "." + pick(alnum, 40) + "." + pick(alnum + "_-", 43),
        lambda: pick(alnum + "+/", 43) + "=",
        lambda: pick(hexa, 40),
        lambda: pick(string.ascii_letters, int(rng.integers(16, 41))),
        lambda: "-".join(pick(alnum, 5) for _ in range(5)),
    ]
    leet = str.maketrans("aeiost", "431057")
    some = lambda k: "".join(word() for _ in range(k))
    # passwords that people make up; only the name before them tells
    made_up = [
        lambda: pick(alnum + "_-", int(rng.integers(8, 16))),
        lambda: pick(string.ascii_lowercase, int(rng.integers(5, 9))) + str(rng.integers(0, 10)) + pick(string.ascii_lowercase, int(rng.integers(2, 5))),
        lambda: pick(string.ascii_lowercase, int(rng.integers(6, 11))).capitalize().translate(leet) + pick(string.digits, 2),
        lambda: some(4)[:24].ljust(10, "e"),
        lambda: "-".join(word() for _ in range(4)),
        lambda: pick(string.ascii_lowercase, 8) + pick(string.digits, int(rng.integers(1, 5))),
    ]
    others = [
        lambda: "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: "/".join(word() for _ in range(5)) + "." + word()[:3],
        lambda: "_".join(word() for _ in range(4)) + str(rng.integers(0, 99)),
        lambda: f"{word()}-{rng.integers(0, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}-{word()}-{word()}",
        lambda: f"20{rng.integers(10, 30)}-0{rng.integers(1, 9)}-1{rng.integers(0, 9)}T1{rng.integers(0, 9)}-22-33.456",
        lambda: str(rng.integers(10**15, 10**17)),
        lambda: f"{word()}.{word()}.example.com/{word()}/{word()}{rng.integers(0, 999)}",
        lambda: "=" * int(rng.integers(16, 40)),
        lambda: "-".join(word().capitalize() for _ in range(4)),
        lambda: "".join(word().capitalize() for _ in range(4)),
    ]
    plain = [
        lambda: pick(string.ascii_lowercase, int(rng.integers(8, 15))),
        lambda: pick(string.ascii_lowercase, int(rng.integers(8, 15))).capitalize() + ".",
        lambda: f"//{word()}.{word()}.com/{word()}",
        lambda: f"20{rng.integers(10, 30)}-0{rng.integers(1, 9)}-1{rng.integers(0, 9)}",
        lambda: f"{word()}/{word()}.{word()[:3]}.{word()}",
    ]
    short_names = ["pwd", "passphrase", "auth", "pass", "login_key", "credentials", "passwort", "pin_pass"]
    names = ["key", "credential", "auth", "access_key", "client_secret", "bearer", "signing_key"]
    before_other = ["id", "file", "path", "build", "see", "version", "sha256", "commit", "at", "host"]
    codes, labels = [], []
    for i in range(n):
        secret = i % 2 == 0
        brief = rng.random() < 0.35  # values that follow a name and : or =
        if brief and not secret and rng.random() < 0.5:
            shapes = made_up[1:]  # the same kind of value behind a harmless name
        else:
            shapes = (made_up if secret else plain) if brief else (keys if secret else others)
        value = shapes[int(rng.integers(0, len(shapes)))]()
        named = brief or rng.random() < 0.6
        about = (short_names if brief else names) if secret else before_other + ["note", "color", "https", "title", "user", "theme"] * brief
        name = str(rng.choice(about)) if named else word()
        join = str(rng.choice([" = ", ": ", "=", ' = "'])) if (secret or brief) and named else " "
        left = f"{word()} {word()} {word()} {name}{join}"
        text = f"{left}{value} {word()} {word()} {word()}"
        codes.append(np.array(segments(text, len(left), len(left) + len(value))))
        labels.append(secret)
    return Findings(codes, labels, False)


def labelled_findings(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(label, code, shard) of all different candidates of the corpus that the
    base patterns or look-alikes label. A code is the finding's segments;
    shards are dealt by its hash and have about ``shard`` segments each."""

    def run(batches):
        for batch in batches:
            label, code = [], []
            for _, s in _telling_rows(tb.column(batch, "text")):
                base = base_findings(s)
                for a, b in candidates(s):
                    covered = _covered(base, a, b)
                    if covered or is_lookalike(s, a, b):
                        label.append(covered)
                        code.append(np.array(segments(s, a, b), np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.bool_()), pa.array(code, pa.binary())], names=["label", "code"])

    found = docs.mapInArrow(run, "label boolean, code binary").groupBy("code").agg(F.max("label").alias("label"))
    found = cut_lineage(found, "secret_candidates")
    size = found.agg(F.sum(F.length("code"))).first()[0] or 0
    n_shards = max(1, -(-size // (WIDTH * shard)))
    return found.select("label", "code", F.pmod(F.xxhash64("code"), F.lit(n_shards)).cast("int").alias("shard"))


def _covered(base, a, b) -> bool:
    return any(s < b and e > a for s, e, _ in base)


_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in string.ascii_letters + string.digits + "+/_.=-"]] = True
_TELL = np.zeros(256, bool)
_TELL[[ord(c) for c in string.digits + "+/_="]] = True
_LOW, _HIGH, _JOIN = (np.isin(np.arange(256), [ord(c) for c in x]) for x in (string.ascii_lowercase, string.ascii_uppercase, ":="))


def _telling_rows(texts: pa.Array):
    """(row, text) of rows that may hold a candidate or a base finding:
    vectorised over the bytes, so that plain prose is not decoded."""
    for first, data, off in tb.chunks_of(texts):
        start, end, row = tb.words(data, off, _RUN)
        tells, lows, highs, joins = (np.concatenate([[0], np.cumsum(kind[data])]) for kind in (_TELL, _LOW, _HIGH, _JOIN))
        long = end - start >= 16
        may = row[long & ((tells[end] > tells[start]) | ((lows[end] > lows[start]) & (highs[end] > highs[start])))]
        # a value of 8 or more stands behind : or =, at most 3 bytes apart
        may = np.union1d(may, row[(end - start >= 8) & (joins[end] > joins[np.maximum(start - 4, 0)])])
        may = np.union1d(may, row[end - start >= 32])  # hex may be letters only
        raw = data.tobytes()
        low = raw.translate(bytes(tb.LOWER.tolist()))
        for name in (b"passw", b"secret", b"token", b"api", b"akia"):
            at = low.find(name)
            places = []
            while at >= 0:
                places.append(at)
                at = low.find(name, at + 1)
            if places:
                may = np.union1d(may, np.searchsorted(off, places, side="right") - 1)
        for r in may:
            yield first + int(r), raw[off[r] : off[r + 1]].decode("utf-8", "replace")


def _of_corpus(rows: list[tuple[bytes, bool]]) -> Findings:
    codes = [np.frombuffer(c, np.uint8).reshape(-1, WIDTH) for c, _ in rows]
    return Findings(codes, [y for _, y in rows], True)


def _flat(state: State) -> np.ndarray:
    return np.concatenate([x[k].ravel() for x in state for k in sorted(x)])


def _shaped(flat: np.ndarray, like: State) -> State:
    out, at = [], 0
    for x in like:
        out.append({})
        for k in sorted(x):
            out[-1][k] = flat[at : at + x[k].size].reshape(x[k].shape)
            at += x[k].size
    return tuple(out)


def _sum_states(batches):
    got: dict[int, list] = {}
    for batch in batches:
        for group, shard, blob in zip(*(c.to_pylist() for c in batch.columns)):
            got.setdefault(group, []).append((shard, blob))
    for group, states in got.items():
        # in the order of the shards, so that sums are the same each time
        total = sum(np.frombuffer(blob, "<f8") for _, blob in sorted(states))
        yield pa.RecordBatch.from_arrays(
            [pa.array([group], pa.int32()), pa.array([len(states)], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["group", "n", "state"]
        )


def epoch_of_shards(found: DataFrame, n_shards: int, made, state: State, epoch: int) -> State:
    """The mean of what all shards have learnt after one more epoch. Sums
    are made in groups of shards, whose number is about the square root."""
    bc = found.sparkSession.sparkContext.broadcast(state)

    def run(batches):
        rows: dict[int, list] = {}
        for batch in batches:
            for shard, code, label in zip(*(c.to_pylist() for c in batch.columns)):
                rows.setdefault(shard, []).append((code, label))
        for shard in sorted(rows):
            data = made.value.with_(_of_corpus(sorted(rows.pop(shard))))
            rng = np.random.default_rng((SEED, epoch, shard))
            blob = _flat(learn(bc.value, data, rng, epoch, epoch + 1, EPOCHS, RATE)).astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([blob], pa.binary())], names=["shard", "state"])

    learnt = found.select("shard", "code", "label").repartition(n_shards, "shard").mapInArrow(run, "shard int, state binary")
    groups = max(1, math.isqrt(n_shards))
    near = learnt.select((F.col("shard") % groups).alias("group"), "shard", "state").repartition(groups, "group")
    sums = sorted(near.mapInArrow(_sum_states, "group int, n int, state binary").collect())
    bc.unpersist()
    return _shaped(sum(np.frombuffer(bytes(r["state"]), "<f8") for r in sums) / sum(r["n"] for r in sums), state)


def counted_logits(found: DataFrame, net: Net):
    """label, part, logit and count of all findings that do not fit weights;
    the number of cells is bounded, whatever the number of findings."""
    bc = found.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            data = _of_corpus(list(zip(*(c.to_pylist() for c in batch.columns))))
            z = data.largest(bc.value.logits(data.x)) if len(data.x) else np.zeros(0)
            cell = np.floor(np.clip(z, -64, 64) * GRID).astype(np.int32)
            rest = data.part >= 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(data.y[rest]), pa.array(data.part[rest]), pa.array(cell[rest])], names=["label", "part", "cell"]
            )

    scored = found.select("code", "label").mapInArrow(run, "label boolean, part long, cell int")
    rows = sorted(scored.groupBy("label", "part", "cell").count().collect())
    bc.unpersist()
    y, part, cell, n = (np.array([r[i] for r in rows], kind) for i, kind in enumerate((bool, np.int64, float, np.int64)))
    return y, part, cell / GRID, n


def fit_shards(found: DataFrame, n_shards: int) -> Net:
    """A net from all findings of all shards and the generated ones."""
    generated = generated_findings(GENERATED)
    made = found.sparkSession.sparkContext.broadcast(generated)
    state = start(np.random.default_rng(SEED))
    for epoch in range(EPOCHS):
        state = epoch_of_shards(found, n_shards, made, state, epoch)
    made.unpersist()
    net = Net(state[0], measured={})
    y, part, z, n = counted_logits(found, net)
    join = lambda a, b: np.concatenate([a, b])
    own = generated.largest(net.logits(generated.x))
    ones = np.ones(len(own), np.int64)
    return calibrate(net, join(own, z), join(generated.y, y), join(generated.part, part), join(generated.corpus, np.ones(len(z), bool)), join(ones, n))


def fit(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> Net:
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        rows = sorted((c, y) for b in batches for y, c in zip(*(col.to_pylist() for col in b.columns)))
        net = train(generated_findings(GENERATED).with_(_of_corpus(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["net"])

    found = labelled_findings(docs, shard)
    n_shards = (found.agg(F.max("shard")).first()[0] or 0) + 1
    if n_shards > 1:
        return fit_shards(found, n_shards)
    # one shard, one task; an empty corpus has a task of its own too
    got = found.select("label", "code").repartition(1).mapInArrow(run, "net binary").first()
    return pickle.loads(bytes(got["net"])) if got else train(generated_findings(GENERATED))


def findings(text: str, net: Net) -> list[tuple[int, int, int]]:
    base = base_findings(text)
    starts, reach = [b[0] for b in base], np.maximum.accumulate([b[1] for b in base]) if base else []
    rest = []
    for a, b in candidates(text):
        i = bisect.bisect_left(starts, b)  # base findings that start before b
        if not (i and reach[i - 1] > a):
            rest.append((a, b))
    if not rest:
        return base
    parts = [segments(text, a, b) for a, b in rest]
    p = net.probabilities(np.array([s for part in parts for s in part]))
    at = np.cumsum([0] + [len(part) for part in parts])
    extra = [(a, b, 3) for (a, b), i, j in zip(rest, at[:-1], at[1:]) if p[i:j].max() >= net.threshold]
    return sorted(base + extra)


def scan(documents: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and findings (array of kind, start, end)."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bc = documents.sparkSession.sparkContext.broadcast(net)
    kind = docs.schema["id"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(batch.num_rows)]
            for i, s in _telling_rows(tb.column(batch, "text")):
                out[i] = [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in findings(s, bc.value)]
            yield pa.RecordBatch.from_arrays([tb.column(batch, "id"), pa.array(out, pa.list_(item))], names=["id", "findings"])

    return docs.mapInArrow(run, f"id {kind}, findings array<struct<kind: string, start: bigint, end: bigint>>")
