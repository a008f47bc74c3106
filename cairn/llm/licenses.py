"""License scan: ordered signature rules over normalised words.

A-Z are lower-cased; words are runs of 0-9, a-z and non-ASCII characters.
A text is scanned as its words joined by single spaces, so a rule does not
depend on punctuation or line breaks ("CC-BY-SA 4.0" is ``cc by sa 4 0``).

Each rule is a hand-written regex with a keyword: the regex runs only in
texts that contain its keyword. Rules for families (license x version) are
made from a phrase and its versions. Detections are ordered by priority,
then length; one that lies within an accepted detection's span is
suppressed, so "GNU Lesser General Public License version 2.1" is one
detection, not three; a sweep over sorted spans decides this, so a text with
millions of detections takes seconds. The three base phrases are counted wherever their
words stand consecutively and are never suppressed.

Null and empty texts have no words, no detections and score 0; very long
texts are scanned whole. Rows with equal ids are scanned one by one; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm import textbuf as tb

# fixed values of the contract: phrase -> label
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

FOLD = bytes(c if tb.ALNUM[c] else 0x20 for c in tb.LOWER.tolist())


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int  # higher wins overlaps
    keyword: bytes
    pattern: bytes
    weight: float  # how surely a match is a license statement


def _versions(label, priority, keyword, phrase, versions, weight=0.95):
    """A rule per version, which may follow the phrase in usual ways."""
    for v in versions:
        spaced = v.replace(".", " ")
        tail = rf" (?:license )?(?:license v|v|version |ver )?{spaced}"
        short = rf"(?: 0)?(?! [0-9])" if "." not in v else r"(?! [0-9])"
        yield Rule(f"{label}-{v}", priority, keyword, f"(?:{phrase}){tail}{short}".encode(), weight)


def _cc():
    parts = {
        "by": "by|attribution",
        "by-sa": "by sa|attribution share ?alike",
        "by-nc": "by nc|attribution non ?commercial",
        "by-nd": "by nd|attribution no ?deriv(?:s|atives|ative works)",
        "by-nc-sa": "by nc sa|attribution non ?commercial share ?alike",
        "by-nc-nd": "by nc nd|attribution non ?commercial no ?deriv(?:s|atives|ative works)",
    }
    for kind, words in parts.items():
        rank = 50 + 2 * kind.count("-")
        name = rf"(?:cc|creative commons) (?:{words})"
        for key in (b"cc", b"creative commons"):
            port = r"(?: international| unported| generic| [a-z]{2,12})?(?: public)?(?: licen[cs]e)?"
            yield Rule(f"cc-{kind}", rank, key, (name + r"(?: licen[cs]e)?").encode(), 0.7)
            for v in ("1.0", "2.0", "2.1", "2.5", "3.0", "4.0"):
                yield Rule(f"cc-{kind}-{v}", rank + 20, key, f"{name} {v.replace('.', ' ')}{port}".encode(), 0.95)
    yield Rule("cc0-1.0", 75, b"cc0", rb"cc0(?: 1 0)?(?: universal)?", 0.95)
    yield Rule("cc0-1.0", 75, b"creative commons", rb"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?", 0.95)
    yield Rule("cc-pdm-1.0", 70, b"public domain", rb"(?:creative commons )?public domain mark(?: 1 0)?", 0.9)


def _gnu():
    names = {
        "agpl": ("gnu affero general public licen[cs]e|affero general public licen[cs]e|gnu agpl|agpl", b"a"),
        "lgpl": ("gnu (?:lesser|library) general public licen[cs]e|(?:lesser|library) general public licen[cs]e|gnu lgpl|lgpl", b"l"),
        "gpl": ("gnu general public licen[cs]e|general public licen[cs]e|gnu gpl|gpl", b"g"),
        "gfdl": ("gnu free documentation licen[cs]e|free documentation licen[cs]e|gnu fdl|gfdl", b"d"),
    }
    versions = {"agpl": ("1", "3"), "lgpl": ("2", "2.1", "3"), "gpl": ("1", "2", "3"), "gfdl": ("1.1", "1.2", "1.3")}
    later = r"(?: (?:of the licen[cs]e )?or (?:at your option )?any later(?: version)?| or later)"
    for kind, (phrase, _) in names.items():
        rank = 60 + 10 * (kind != "gpl")
        keys = (b"public licen",) if kind != "gfdl" else (b"documentation licen",)
        keys += {"agpl": (b"agpl",), "lgpl": (b"lgpl",), "gpl": (b"gpl",), "gfdl": (b"gfdl", b"gnu fdl")}[kind]
        for key in keys:
            yield Rule(kind, rank, key, f"(?:{phrase})".encode(), 0.8)
            for v in versions[kind]:
                s = v.replace(".", " ")
                number = rf" ?(?:as published by the free software foundation )?(?:either )?(?:version |ver |v)?{s}(?: 0)?(?! [0-9])"
                yield Rule(f"{kind}-{v}", rank + 20, key, f"(?:{phrase}){number}".encode(), 0.97)
                yield Rule(f"{kind}-{v}-or-later", rank + 25, key, f"(?:{phrase}){number}{later}".encode(), 0.97)
                yield Rule(f"{kind}-{v}-only", rank + 25, key, f"(?:{phrase}){number} only".encode(), 0.97)


def _plain():
    """Single statements: label, priority, keyword, pattern, weight."""
    return [
        # Apache, MIT, BSD, ISC and their notices
        Rule("apache", 50, b"apache", rb"apache (?:software )?licen[cs]e", 0.85),
        Rule("apache-2.0", 60, b"apache", rb"apache 2(?: 0)?(?: licen[cs]e)?", 0.9),
        Rule("apache-2.0", 72, b"www apache org", rb"(?:http|https) www apache org licenses license 2 0", 0.97),
        Rule("mit", 60, b"mit", rb"(?:the )?mit(?: x11)? licen[cs]e", 0.92),
        Rule("mit", 65, b"permission is hereby granted", rb"permission is hereby granted free of charge to any person obtaining a copy", 0.97),
        Rule("mit-0", 66, b"mit no attribution", rb"mit no attribution", 0.95),
        Rule("expat", 60, b"expat", rb"expat licen[cs]e", 0.9),
        Rule("bsd", 50, b"bsd", rb"bsd (?:style )?licen[cs]e", 0.85),
        Rule("bsd-2-clause", 62, b"bsd", rb"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: licen[cs]e)?", 0.95),
        Rule("bsd-2-clause", 62, b"freebsd", rb"freebsd licen[cs]e", 0.95),
        Rule("bsd-3-clause", 62, b"bsd", rb"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", 0.95),
        Rule("bsd-4-clause", 62, b"bsd", rb"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: licen[cs]e)?", 0.95),
        Rule("0bsd", 62, b"0bsd", rb"0bsd", 0.95),
        Rule("0bsd", 62, b"zero clause bsd", rb"zero clause bsd", 0.95),
        Rule("bsd", 55, b"redistribution and use", rb"redistribution and use in source and binary forms with or without modification are permitted", 0.95),
        Rule("isc", 60, b"isc", rb"(?:the )?isc licen[cs]e", 0.92),
        Rule("isc", 55, b"permission to use copy", rb"permission to use copy modify and or distribute this software for any purpose", 0.95),
        Rule("zlib", 60, b"zlib", rb"zlib(?: libpng)? licen[cs]e", 0.92),
        Rule("libpng", 58, b"libpng", rb"libpng licen[cs]e", 0.92),
        Rule("libpng", 58, b"png reference library", rb"png reference library licen[cs]e", 0.92),
        Rule("unlicense", 60, b"unlicense", rb"(?:the )?unlicense", 0.92),
        Rule("unlicense", 58, b"public domain", rb"free and unencumbered software released into the public domain", 0.97),
        Rule("wtfpl", 60, b"wtfpl", rb"wtfpl(?: version 2| 2 0)?", 0.92),
        Rule("beerware", 60, b"beer", rb"beer ?ware licen[cs]e", 0.9),
        Rule("postgresql", 60, b"postgresql", rb"postgresql licen[cs]e", 0.92),
        Rule("openssl", 60, b"openssl", rb"openssl licen[cs]e", 0.92),
        Rule("php-3.01", 60, b"php", rb"php licen[cs]e(?: version)?(?: 3 01)?", 0.9),
        Rule("python-2.0", 60, b"python", rb"python (?:software foundation )?licen[cs]e(?: version 2)?", 0.9),
        Rule("ruby", 58, b"ruby", rb"ruby licen[cs]e", 0.85),
        Rule("ncsa", 60, b"ncsa", rb"(?:university of illinois )?ncsa open source licen[cs]e", 0.92),
        Rule("x11", 55, b"x11", rb"x11 licen[cs]e", 0.9),
        Rule("curl", 55, b"curl", rb"curl licen[cs]e", 0.9),
        Rule("w3c", 58, b"w3c", rb"w3c (?:software (?:notice and )?|document )licen[cs]e", 0.92),
        Rule("vim", 55, b"vim", rb"vim licen[cs]e", 0.9),
        Rule("json", 55, b"shall be used for good", rb"shall be used for good not evil", 0.97),
        Rule("intel", 50, b"intel", rb"intel open source licen[cs]e", 0.9),
        Rule("ibm-public", 55, b"ibm", rb"ibm public licen[cs]e(?: version 1 0)?", 0.92),
        Rule("sleepycat", 55, b"sleepycat", rb"sleepycat licen[cs]e", 0.92),
        Rule("ms-pl", 60, b"microsoft", rb"microsoft public licen[cs]e", 0.92),
        Rule("ms-rl", 60, b"microsoft", rb"microsoft reciprocal licen[cs]e", 0.92),
        Rule("upl-1.0", 60, b"universal permissive", rb"universal permissive licen[cs]e(?: (?:version |v)?1 0)?", 0.92),
        Rule("bsl-1.0", 60, b"boost", rb"boost software licen[cs]e(?: version)?(?: 1 0)?", 0.95),
        Rule("busl-1.1", 60, b"business source", rb"business source licen[cs]e(?: version)?(?: 1 1)?", 0.95),
        Rule("elastic-2.0", 60, b"elastic licen", rb"elastic licen[cs]e(?: version)?(?: 2 0)?", 0.95),
        Rule("sspl-1.0", 60, b"server side public", rb"server side public licen[cs]e(?: (?:version |v)?1)?", 0.95),
        Rule("blueoak-1.0.0", 60, b"blue oak", rb"blue oak model licen[cs]e(?: 1 0 0)?", 0.95),
        Rule("commons-clause", 60, b"commons clause", rb"commons clause(?: licen[cs]e condition)?", 0.9),
        Rule("polyform", 60, b"polyform", rb"polyform (?:noncommercial|small business|shield|strict|perimeter) licen[cs]e(?: 1 0 0)?", 0.95),
        Rule("ofl", 55, b"open font", rb"(?:sil )?open font licen[cs]e", 0.9),
        Rule("odbl-1.0", 60, b"open database", rb"open database licen[cs]e(?: (?:version |v)?1 0)?|odbl(?: 1 0)?", 0.95),
        Rule("odbl-1.0", 60, b"odbl", rb"odbl(?: 1 0)?", 0.9),
        Rule("odc-by-1.0", 60, b"open data commons", rb"open data commons attribution licen[cs]e(?: (?:version |v)?1 0)?", 0.95),
        Rule("pddl-1.0", 60, b"open data commons", rb"open data commons public domain dedication(?: and licen[cs]e)?", 0.95),
        Rule("cdla-permissive", 60, b"community data license", rb"community data license agreement permissive(?: version)?(?: [12] 0)?", 0.95),
        Rule("cdla-sharing", 60, b"community data license", rb"community data license agreement sharing(?: version)?(?: 1 0)?", 0.95),
        Rule("ogl-uk", 60, b"open government", rb"open government licen[cs]e(?: (?:version |v)?[123] 0)?", 0.92),
        Rule("openrail", 60, b"openrail", rb"(?:creativeml |bigscience )?openrail(?: m| s| d)?(?: licen[cs]e)?", 0.92),
        Rule("llama", 58, b"community license agreement", rb"llama [23](?: [0-9])? community license agreement", 0.95),
        # statements of rights without a named license
        Rule("public-domain", 45, b"public domain", rb"(?:in|into|to|as) the public domain", 0.6),
        Rule("copyright", 20, b"copyright", rb"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", 0.4),
        Rule("copyright", 18, b"copyright", rb"copyright (?:holder|owner|notice)s?", 0.3),
        Rule("proprietary", 30, b"proprietary", rb"(?:proprietary and confidential|confidential and proprietary)", 0.6),
        Rule("proprietary", 30, b"permission", rb"(?:may not|no part of this [a-z]+ may) be (?:reproduced|copied|distributed)(?: [a-z]+){0,8} without (?:the )?(?:prior )?(?:written )?permission", 0.7),
        Rule("noncommercial", 32, b"commercial", rb"(?:for )?non commercial use only|not for commercial use", 0.6),
        Rule("noncommercial", 32, b"noncommercial", rb"(?:for )?noncommercial use only", 0.6),
        Rule("see-license", 10, b"licen", rb"(?:see|refer to) (?:the )?licen[cs]e(?: file)?(?: for (?:more )?(?:details|information))?", 0.3),
        Rule("spdx-tag", 15, b"spdx", rb"spdx license identifier", 0.6),
        Rule("eula", 30, b"end user", rb"end user licen[cs]e agreement", 0.7),
        Rule("licensed-under", 5, b"licensed under", rb"licensed under(?: the)?(?: terms of)?(?: the)?", 0.3),
    ]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    out = [*_plain(), *_cc(), *_gnu()]
    family = [
        ("apache", 65, b"apache", "apache (?:software )?licen[cs]e", ("1.0", "1.1", "2.0")),
        ("mpl", 65, b"mozilla", "mozilla public licen[cs]e", ("1.0", "1.1", "2.0")),
        ("mpl", 65, b"mpl", "mpl", ("1.0", "1.1", "2.0")),
        ("epl", 65, b"eclipse", "eclipse public licen[cs]e", ("1.0", "2.0")),
        ("epl", 65, b"epl", "epl", ("1.0", "2.0")),
        ("edl", 65, b"eclipse", "eclipse distribution licen[cs]e", ("1.0",)),
        ("cddl", 65, b"common development", "common development and distribution licen[cs]e", ("1.0", "1.1")),
        ("cddl", 65, b"cddl", "cddl", ("1.0", "1.1")),
        ("cpl", 65, b"common public", "common public licen[cs]e", ("1.0",)),
        ("cpal", 65, b"common public attribution", "common public attribution licen[cs]e", ("1.0",)),
        ("eupl", 65, b"european union", "european union public licen[cs]e", ("1.0", "1.1", "1.2")),
        ("eupl", 65, b"eupl", "eupl", ("1.0", "1.1", "1.2")),
        ("afl", 65, b"academic free", "academic free licen[cs]e", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        ("osl", 65, b"open software", "open software licen[cs]e", ("1.0", "2.0", "2.1", "3.0")),
        ("artistic", 65, b"artistic", "artistic licen[cs]e", ("1.0", "2.0")),
        ("ofl", 65, b"open font", "(?:sil )?open font licen[cs]e", ("1.0", "1.1")),
        ("lppl", 65, b"latex project", "latex project public licen[cs]e", ("1.0", "1.1", "1.2", "1.3")),
        ("zpl", 65, b"zope", "zope public licen[cs]e", ("1.1", "2.0", "2.1")),
        ("qpl", 65, b"q public", "q public licen[cs]e", ("1.0",)),
        ("rpl", 65, b"reciprocal public", "reciprocal public licen[cs]e", ("1.1", "1.5")),
        ("apsl", 65, b"apple public", "apple public source licen[cs]e", ("1.0", "1.1", "1.2", "2.0")),
        ("cecill", 65, b"cecill", "cecill", ("1.0", "1.1", "2.0", "2.1")),
        ("npl", 65, b"netscape", "netscape public licen[cs]e", ("1.0", "1.1")),
        ("sgi-b", 65, b"sgi", "sgi free software licen[cs]e b", ("1.0", "1.1", "2.0")),
        ("mulan", 65, b"mulan", "mulan permissive software licen[cs]e", ("1", "2")),
        ("nposl", 65, b"non profit open", "non profit open software licen[cs]e", ("3.0",)),
        ("osset", 65, b"osset", "osset public licen[cs]e", ("2.1",)),
        ("ecl", 65, b"educational community", "educational community licen[cs]e", ("1.0", "2.0")),
        ("cal", 65, b"cryptographic autonomy", "cryptographic autonomy licen[cs]e", ("1.0",)),
        ("ogc", 65, b"open gaming", "open gaming licen[cs]e", ("1.0",)),
    ]
    for label, priority, keyword, phrase, versions in family:
        out.append(Rule(label, priority - 15, keyword, f"(?:{phrase})(?: licen[cs]e)?".encode() if " " in phrase else f"{phrase} licen[cs]e".encode(), 0.8))
        out += _versions(label, priority, keyword, phrase, versions)
    return tuple(out)


@lru_cache(maxsize=1)
def _by_keyword() -> dict[bytes, list[tuple[Rule, re.Pattern]]]:
    out: dict[bytes, list] = {}
    for r in rules():
        out.setdefault(b" " + r.keyword, []).append((r, re.compile(rb"(?<= )(?:" + r.pattern + rb")(?= )")))
    return out


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """(word index, label) of every place of a base phrase, overlaps too;
    ``norm`` has a space at both ends."""
    out = []
    for phrase, label in BASE.items():
        need = f" {phrase} ".encode()
        at, word, seen = norm.find(need), 0, 0
        while at >= 0:
            word += norm.count(b" ", seen, at)
            seen = at
            out.append((word, label))
            at = norm.find(need, at + 1)
    return sorted(out)


def uncontained(start: np.ndarray, end: np.ndarray, level: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Which detections stand in no other that goes before them: of a higher
    level, or of the same level and longer, or on the same place with a
    smaller ``tie``. As containment is transitive, a detection that a rejected
    one contains stands in an accepted one too; so a sweep per level over
    sorted starts decides, without comparing pairs."""
    keep = np.ones(len(start), bool)
    places = np.unique(start)
    at = np.searchsorted(places, start)
    reach = np.full(len(places), -1, np.int64)  # largest end of higher levels from each start
    for value in np.unique(level)[::-1]:
        here = np.flatnonzero(level == value)
        here = here[np.lexsort((tie[here], -end[here], start[here]))]
        higher = np.maximum.accumulate(reach)[at[here]]
        same = np.concatenate([[-1], np.maximum.accumulate(end[here])[:-1]])
        keep[here] = np.maximum(higher, same) < end[here]
        np.maximum.at(reach, at[here], end[here])
    return keep


def detect(norm: bytes) -> list[tuple[int, int, Rule]]:
    """Accepted detections (start, end, rule) after suppression."""
    found = []
    for keyword, group in _by_keyword().items():
        if keyword in norm:
            for rule, pattern in group:
                found += [(m.start(), m.end(), rule) for m in pattern.finditer(norm)]
    if not found:
        return []
    found.sort(key=lambda d: (d[0], d[1]))
    names = {label: i for i, label in enumerate(sorted({r.label for _, _, r in found}))}
    start, end, level, tie = np.array([(s, e, r.priority, names[r.label]) for s, e, r in found], dtype=np.int64).T
    return [d for d, on in zip(found, uncontained(start, end, level, tie)) if on]


def scan_text(raw: bytes):
    words = raw.translate(FOLD).split()
    norm = b" " + b" ".join(words) + b" "
    base = base_places(norm)
    found = detect(norm) if words else []
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(r.label for _, _, r in found)})
    doubt = 1.0
    for w in [0.5] * len(base_labels) + [r.weight for r in {r.label: r for _, _, r in found}.values()]:
        doubt *= 1.0 - w
    first, last = (base[0][0], base[-1][0]) if base else (None, None)
    return len(words), len(base), first, last, ",".join(base_labels), ",".join(labels), 1.0 - doubt


SCHEMA = "id {}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; one pass, no shuffle."""
    docs = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))

    def run(batches):
        for batch in batches:
            data, off = tb.buffer_of(tb.column(batch, "text"))
            raw = data.tobytes()
            rows = [scan_text(raw[a:b]) for a, b in zip(off[:-1], off[1:])]
            c = list(zip(*rows)) if rows else [[]] * 7
            longs = [pa.array(x, pa.int64()) for x in c[:4]]
            yield pa.RecordBatch.from_arrays(
                [tb.column(batch, "id"), *longs, pa.array(c[4], pa.string()), pa.array(c[5], pa.string()), pa.array(c[6], pa.float64())],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return docs.mapInArrow(run, SCHEMA.format(docs.schema["id"].dataType.simpleString()))
