"""License scan: ordered signature rules over whole texts.

A text is normalised to its words (``ALNUM``, lower-cased) with single spaces. A rule has a priority, a label, keywords
of which a text must hold one for the rule to run, a regex over the normalised text and a confidence. Rules are the
product of license names and the contexts in which a name is granted, identified, pointed to or only mentioned,
and rules of their own; the products make hundreds of regexes. Detections are resolved in order: by priority, then
length, then start; one whose interval lies within the interval of a detection kept before is suppressed.

The base phrases are found apart from the rules at all their places and their labels always stay.

Defined cases: null and empty texts have no words, no labels (empty strings), null places and score 0; equal
detections count once; repeated rows are each scanned; a text is scanned whole, whatever its length; an empty table
gives an empty result; other columns are ignored, and none can clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, steps
from .words import ALNUM

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

LIC = "licen[cs]e"
VERSION = r"(?: v| version)?"
#: label, keywords of which every form of the name holds one as a word, the name in normalised words.
NAMES = (
    ("apache-1.0", "apache", rf"apache(?: software)?(?: {LIC})?{VERSION} 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)?(?: {LIC})?{VERSION} 1 1"),
    ("apache-2.0", "apache", rf"apache(?: software)?(?: {LIC})?{VERSION} 2(?: 0)?"),
    ("mit", "mit", rf"(?:mit x11|mit expat|mit) {LIC}"),
    ("mit-0", "mit", rf"mit no attribution(?: {LIC})?"),
    ("x11", "x11", rf"x11 {LIC}"),
    ("isc", "isc", rf"isc(?: {LIC})"),
    ("bsd-2-clause", "bsd freebsd", rf"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: {LIC})?"),
    ("bsd-3-clause", "bsd", rf"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: {LIC})?"),
    ("bsd-4-clause", "bsd", rf"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: {LIC})?"),
    ("0bsd", "0bsd", rf"0bsd(?: {LIC})?"),
    ("bsd", "bsd", rf"bsd(?: style)? {LIC}"),
    ("gpl-1.0", "general", rf"(?:gnu )?general public {LIC}{VERSION} 1(?: 0)?"),
    ("gpl-2.0", "general", rf"(?:gnu )?general public {LIC}{VERSION} 2(?: 0)?"),
    ("gpl-3.0", "general", rf"(?:gnu )?general public {LIC}{VERSION} 3(?: 0)?"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl-2.0", "gpl", rf"(?:gnu )?gpl{VERSION} 2(?: 0)?"),
    ("gpl-3.0", "gpl", rf"(?:gnu )?gpl{VERSION} 3(?: 0)?"),
    ("gpl", "general", rf"gnu general public {LIC}"),
    ("gpl", "gpl", rf"gnu gpl(?: {LIC})?"),
    ("lgpl-2.0", "library", rf"(?:gnu )?library general public {LIC}(?:{VERSION} 2(?: 0)?)?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public {LIC}{VERSION} 2 1"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public {LIC}{VERSION} 3(?: 0)?"),
    ("lgpl", "lesser", rf"(?:gnu )?lesser general public {LIC}"),
    ("lgpl", "lgpl", rf"(?:gnu )?lgpl(?:{VERSION} [23](?: [01])?)?"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public {LIC}(?:{VERSION} 3(?: 0)?)?"),
    ("agpl-3.0", "agpl", rf"(?:gnu )?agpl(?:{VERSION} 3(?: 0)?)?"),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {LIC}(?:{VERSION} 1 [123])?"),
    ("mpl-1.1", "mozilla", rf"mozilla public {LIC}{VERSION} 1 [01]"),
    ("mpl-2.0", "mozilla", rf"mozilla public {LIC}(?:{VERSION} 2(?: 0)?)?"),
    ("epl-1.0", "eclipse", rf"eclipse public {LIC}{VERSION} 1(?: 0)?"),
    ("epl-2.0", "eclipse", rf"eclipse public {LIC}(?:{VERSION} 2(?: 0)?)?"),
    ("cddl-1.0", "distribution", rf"common development and distribution {LIC}(?:{VERSION} 1 [01])?"),
    ("cpl-1.0", "common", rf"common public {LIC}(?:{VERSION} 1(?: 0)?)?"),
    ("eupl", "european", rf"european union public {LIC}(?:{VERSION} 1 [012])?"),
    ("osl-3.0", "open", rf"open software {LIC}(?:{VERSION} [123] [01])?"),
    ("afl-3.0", "academic", rf"academic free {LIC}(?:{VERSION} [123] [012])?"),
    ("artistic-1.0", "artistic", rf"artistic {LIC}{VERSION} 1(?: 0)?"),
    ("artistic-2.0", "artistic", rf"artistic {LIC}(?:{VERSION} 2(?: 0)?)?"),
    ("zlib", "zlib", rf"zlib(?: libpng)?(?: {LIC})"),
    ("boost-1.0", "boost", rf"boost software {LIC}(?:{VERSION} 1(?: 0)?)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?: {LIC})?"),
    ("python-2.0", "python", rf"python(?: software foundation)? {LIC}(?:{VERSION} 2(?: 0)?)?"),
    ("openssl", "openssl", rf"openssl {LIC}"),
    ("postgresql", "postgresql", rf"postgresql {LIC}"),
    ("ms-pl", "microsoft", rf"microsoft public {LIC}"),
    ("odbl-1.0", "database", rf"open database {LIC}(?:{VERSION} 1 0)?"),
    ("odc-by", "commons", rf"open data commons attribution {LIC}"),
    ("ofl-1.1", "font", rf"(?:sil )?open font {LIC}(?:{VERSION} 1 [01])?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "zero", rf"creative commons zero(?: {LIC})?(?:{VERSION} 1 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc-by-nc-sa", "creative", rf"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc-by-nc", "creative", rf"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc-by-nd", "creative", rf"creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc-by-sa", "creative", rf"creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc-by", "creative", rf"creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: {LIC})?"),
    ("cc", "creative", rf"creative commons {LIC}"),
)
#: priority, what surrounds the name, confidence.
CONTEXTS = (
    (50, r"(?:dual )?(?:licensed|licenced|released|distributed|published|available|provided|covered|shared|redistributed) (?:to you )?(?:under|with|by) (?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the )?{}", 0.95),
    (45, r"(?:subject to|governed by|in accordance with|in compliance with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{}", 0.9),
    (40, rf"(?:spdx )?{LIC}(?: identifier)? {{}}", 0.9),
    (30, r"(?:see|read|a copy of|refer to|consult) (?:the )?(?:file )?(?:the )?{}", 0.75),
    (20, r"under (?:the )?(?:terms of )?(?:the )?{}", 0.7),
    (10, r"{}", 0.5),
)
#: priority, label, keywords as above, regex, confidence.
SINGLE = (
    (60, "permissive-grant", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    (60, "permissive-grant", "permission", r"permission to use copy modify and or distribute this software", 0.95),
    (60, "permissive-grant", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 0.95),
    (58, "gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 0.95),
    (35, "public-domain", "domain", r"(?:dedicated to|released into|placed in|in) the public domain", 0.8),
    (35, "public-domain", "domain", r"public domain dedication", 0.8),
    (34, "proprietary", "proprietary", r"proprietary and confidential", 0.85),
    (34, "proprietary", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution)", 0.7),
    (34, "proprietary", "copied reproduced redistributed", r"may not be (?:copied|reproduced|redistributed)", 0.6),
    (32, "no-derivatives", "derivative", r"no derivative works (?:are )?(?:allowed|permitted)", 0.6),
    (32, "non-commercial", "commercial noncommercial", r"(?:non ?commercial use only|for non ?commercial (?:use|purposes)|not for commercial use)", 0.7),
    (30, "warranty-disclaimer", "warranty warranties", r"(?:provided )?as is without warrant(?:y|ies) of any kind", 0.5),
    (28, "end-user-agreement", "eula user", r"end user licen[cs]e agreement(?: eula)?|eula", 0.5),
    (26, "reserved", "reserved", r"(?:copyright(?: c)? (?:[0-9]{4} )?(?:[^ ]+ ){0,6})?(?:all|some|no) rights reserved", 0.6),
    (24, "copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 0.4),
    (22, "contributor-agreement", "contributor", r"contributor licen[cs]e agreement", 0.4),
    (15, "gpl", "general", r"general public licen[cs]e", 0.5),
    (8, "license-mention", "licensed licenced", r"licen[cs]ed under", 0.2),
)


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    confidence: float


def _rule(priority: int, label: str, keywords: str, pattern: str, confidence: float) -> Rule:
    return Rule(priority, label, tuple(keywords.encode().split()), re.compile(f"(?<= )(?:{pattern})(?= )".encode()), confidence)


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules, in the order of their priority."""
    out = [_rule(p, label, key, context.format(f"(?:{name})"), c) for p, context, c in CONTEXTS for label, key, name in NAMES]
    out += [_rule(*r) for r in SINGLE]
    return tuple(sorted(out, key=lambda r: -r.priority))


_TO_WORDS = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if ALNUM[b] else 0x20 for b in range(256))
_GAPS = re.compile(rb"  +")


def normalised(text: bytes) -> bytes:
    """The words of ``text``, lower-cased, each with a space before and after; one space for none."""
    return _GAPS.sub(b" ", b" " + text.translate(_TO_WORDS) + b" ")


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """Byte place in the normalised text and label of every base phrase."""
    out = []
    for phrase, label in BASE:
        wanted = f" {phrase} ".encode()
        at = norm.find(wanted)
        while at >= 0:
            out.append((at, label))
            at = norm.find(wanted, at + 1)
    return out


@lru_cache(1)
def by_keywords() -> tuple[tuple[tuple[bytes, ...], tuple[Rule, ...]], ...]:
    found: dict[tuple[bytes, ...], list[Rule]] = {}
    for r in rules():
        found.setdefault(r.keywords, []).append(r)
    return tuple((k, tuple(v)) for k, v in found.items())


def detections(norm: bytes) -> list[tuple[int, int, Rule]]:
    """Start, end and rule of what stays after suppression, in the order of the rules."""
    found = []
    for keywords, own in by_keywords():
        if any(b" " + k + b" " in norm for k in keywords):
            for rule in own:
                found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(norm)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of kept intervals that lie in no other, sorted; so are their ends
    ends: list[int] = []
    for start, end, rule in found:
        k = bisect_left(starts, start + 1) - 1
        if k >= 0 and ends[k] >= end:
            continue
        kept.append((start, end, rule))
        k = bisect_left(starts, start)
        while k < len(starts) and ends[k] <= end:  # those are within this one
            del starts[k], ends[k]
        starts.insert(k, start)
        ends.insert(k, end)
    return kept


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
    norm = normalised(text)
    n_words = norm.count(b" ") - 1
    places = base_places(norm)
    kept = detections(norm)
    first = last = None
    if places:
        first, last = (norm.count(b" ", 0, f(at for at, _ in places)) for f in (min, max))
    base = sorted({label for _, label in places})
    labels = sorted({r.label for _, _, r in kept} | set(base))
    doubt = 1.0
    for confidence in {r.label: r.confidence for _, _, r in reversed(kept)}.values():  # the first detection of a label counts
        doubt *= 1 - confidence
    if places:
        doubt = min(doubt, 0.5)
    return n_words, len(places), first, last, ",".join(base), ",".join(labels), 1 - doubt


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, n_base, first_word, last_word, base_labels, labels and score of every text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = [scan(t or b"") for t in step.column("text").cast(pa.binary()).to_pylist()]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            yield pa.RecordBatch.from_arrays([step.column("id"), *columns], names=["id", *schema.names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(
        rows, run, f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    ).withColumnRenamed("id", id_col)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """The licenses of every whole document."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
