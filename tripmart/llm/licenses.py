"""Licence notices: ordered signature rules behind a keyword prefilter.

A text is reduced to its words, lower-cased A-Z, joined by one space. Documents without any gate keyword stop there, which
is nearly all of them; the others run the rules whose own keyword they hold. Of overlapping detections the one that contains
the other stays, unless the inner one has the better priority; equal places go to the better priority, then to the earlier rule.

Rows stay where they are: no shuffle, one Arrow pass, whole texts. A null text counts as empty and has no words; repeated
rows and null ids give a row each. Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.llm.common import narrow_batches, read

# Bytes that are no word: ASCII other than letters and digits. Letters lose their case.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

# Phrases every scan reports wherever their words stand in a row.
BASE = {
    b"gnu general public license": "gpl",
    b"apache license": "apache",
    b"cc by": "cc-by",
    b"mit license": "mit",
}

L = "licen[cs]e"
# label, identifier (words), full name (a pattern over words), versions, keyword every text with the name holds
FAMILIES = (
    ("gpl", "gpl", f"gnu (?:general public {L}|gpl)", ("1.0", "2.0", "3.0"), "gnu"),
    ("lgpl", "lgpl", f"gnu (?:lesser|library) (?:general public {L}|gpl)", ("2.0", "2.1", "3.0"), "gnu"),
    ("agpl", "agpl", f"gnu affero (?:general public {L}|gpl)", ("1.0", "3.0"), "affero"),
    ("gfdl", "gfdl", f"gnu free documentation {L}", ("1.1", "1.2", "1.3"), "documentation"),
    ("apache", "apache", f"apache (?:software )?{L}", ("1.0", "1.1", "2.0"), "apache"),
    ("mit", "mit", f"(?:mit|expat|x11) {L}", (), "licen"),
    ("mit-0", "mit 0", f"mit no attribution {L}", (), "attribution"),
    ("bsd-2-clause", "bsd 2 clause", f"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) {L}", (), "bsd"),
    ("bsd-3-clause", "bsd 3 clause", f"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) {L}", (), "bsd"),
    ("bsd-4-clause", "bsd 4 clause", f"(?:bsd 4 clause|4 clause bsd|original bsd) {L}", (), "bsd"),
    ("bsd", "0bsd", f"(?:zero clause bsd|bsd zero clause|bsd) {L}", (), "bsd"),
    ("isc", "isc", f"isc {L}", (), "isc"),
    ("mpl", "mpl", f"mozilla public {L}", ("1.0", "1.1", "2.0"), "mozilla"),
    ("epl", "epl", f"eclipse public {L}", ("1.0", "2.0"), "eclipse"),
    ("edl", "edl", f"eclipse distribution {L}", ("1.0",), "eclipse"),
    ("cddl", "cddl", f"common development and distribution {L}", ("1.0", "1.1"), "distribution"),
    ("cpl", "cpl", f"common public {L}", ("1.0",), "common public"),
    ("eupl", "eupl", f"european union public {L}", ("1.0", "1.1", "1.2"), "european"),
    ("ofl", "ofl", f"sil open font {L}", ("1.0", "1.1"), "font"),
    ("bsl", "bsl", f"boost software {L}", ("1.0",), "boost"),
    ("busl", "busl", f"business source {L}", ("1.0", "1.1"), "business"),
    ("sspl", "sspl", f"server side public {L}", ("1.0",), "server side"),
    ("elastic", "elastic", f"elastic {L}", ("2.0",), "elastic"),
    ("artistic", "artistic", f"artistic {L}", ("1.0", "2.0"), "artistic"),
    ("afl", "afl", f"academic free {L}", ("1.1", "2.0", "2.1", "3.0"), "academic"),
    ("osl", "osl", f"open software {L}", ("1.0", "2.0", "2.1", "3.0"), "open software"),
    ("zlib", "zlib", f"zlib(?: libpng)? {L}", (), "zlib"),
    ("libpng", "libpng", f"libpng {L}", ("2.0",), "libpng"),
    ("unlicense", "unlicense", f"the unlicense|unlicense {L}|unlicense org", (), "unlicense"),
    ("wtfpl", "wtfpl", f"do what the fuck you want to public {L}|wtfpl", (), "wtf|fuck"),
    ("psf", "psf", f"(?:python software foundation|psf) {L}", ("2.0",), "licen"),
    ("python", "python", f"python {L}", ("2.0",), "python"),
    ("php", "php", f"php {L}", ("3.0", "3.01"), "php"),
    ("ruby", "ruby", f"ruby {L}", (), "ruby"),
    ("ncsa", "ncsa", f"(?:ncsa|university of illinois ncsa) (?:open source )?{L}", (), "ncsa"),
    ("ms-pl", "ms pl", f"microsoft public {L}", (), "microsoft"),
    ("ms-rl", "ms rl", f"microsoft reciprocal {L}", (), "microsoft"),
    ("cecill", "cecill", f"cecill(?: free software)? {L}(?: agreement)?", ("1.0", "2.0", "2.1"), "cecill"),
    ("openssl", "openssl", f"openssl {L}", (), "openssl"),
    ("postgresql", "postgresql", f"postgresql {L}", (), "postgresql"),
    ("vim", "vim", f"vim {L}", (), "vim"),
    ("w3c", "w3c", f"w3c software (?:notice and )?{L}", (), "w3c"),
    ("unicode", "unicode dfs", f"unicode {L}", ("2015", "2016"), "unicode"),
    ("upl", "upl", f"universal permissive {L}", ("1.0",), "permissive"),
    ("odbl", "odbl", f"open database {L}", ("1.0",), "database"),
    ("odc-by", "odc by", f"open data commons attribution {L}", ("1.0",), "data commons"),
    ("pddl", "pddl", f"open data commons public domain dedication and {L}", ("1.0",), "data commons"),
    ("openrail", "openrail", f"(?:creativeml )?open rail m? ?{L}", (), "rail"),
    ("llama", "llama", f"llama [0-9] community {L}(?: agreement)?", (), "llama"),
    ("cc0", "cc0", "(?:creative commons zero|cc0)", ("1.0",), "cc0|zero"),
    ("cc-by", "cc by", f"(?:creative commons attribution(?: (?:international|generic|unported))?(?: {L})?|cc by)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
    ("cc-by-sa", "cc by sa", f"(?:creative commons attribution share ?alike(?: {L})?|cc by sa)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
    ("cc-by-nd", "cc by nd", f"(?:creative commons attribution no ?deriv(?:ative)?s?(?: {L})?|cc by nd)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
    ("cc-by-nc", "cc by nc", f"(?:creative commons attribution non ?commercial(?: {L})?|cc by nc)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
    ("cc-by-nc-sa", "cc by nc sa", f"(?:creative commons attribution non ?commercial share ?alike(?: {L})?|cc by nc sa)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
    ("cc-by-nc-nd", "cc by nc nd", f"(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: {L})?|cc by nc nd)", ("1.0", "2.0", "2.5", "3.0", "4.0"), "cc by|commons"),
)
# label, pattern, keyword, score: sentences and addresses that name no family by its title
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 0.9),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use", 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution", 0.9),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "as is", 0.9),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining", "hereby granted", 0.9),
    ("mit", "opensource org licenses mit", "opensource", 0.95),
    ("bsd", "opensource org licenses bsd", "opensource", 0.95),
    ("apache-2.0", "apache org licenses license 2 0", "apache org", 0.95),
    ("gpl", "gnu org licenses gpl", "gnu org", 0.9),
    ("lgpl", "gnu org licenses lgpl", "gnu org", 0.9),
    ("agpl", "gnu org licenses agpl", "gnu org", 0.9),
    ("mpl-2.0", "mozilla org mpl 2 0", "mozilla org", 0.95),
    ("cc-by", "creativecommons org licenses by", "creativecommons", 0.9),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons", 0.95),
    ("cc-by-nc", "creativecommons org licenses by nc", "creativecommons", 0.95),
    ("cc-by-nd", "creativecommons org licenses by nd", "creativecommons", 0.95),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", "creativecommons", 0.97),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", "creativecommons", 0.97),
    ("cc0", "creativecommons org publicdomain zero", "creativecommons", 0.95),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain", "public domain", 0.8),
    ("proprietary", f"all rights reserved (?:no|without) {L}", "all rights reserved", 0.6),
)
# A text without any of these has no detection: each pattern above holds one.
GATES = (b"licen", b"cc by", b"cc0", b"gnu gpl", b"gnu affero gpl", b"lesser gpl", b"library gpl", b"spdx", b"commons",
         b"wtfpl", b"public domain", b"hereby granted", b"permission to use", b"redistribution", b"as is without", b"mozilla org")


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    priority: int  # the smaller wins
    score: float


def version(v: str) -> str:
    """A version as words: 2.0 also as 2, with or without the word version or a v."""
    whole, _, part = v.partition(".")
    number = f"{whole} {part}" if part != "0" else f"{whole}(?: 0)?"
    return f"(?:version |v )?(?:v)?{number}"


def make_rules() -> list[Rule]:
    """Every family by every version and way of naming it, then the notices."""
    rules: list[Rule] = []

    def add(label: str, pattern: str, keyword: str, priority: int, score: float) -> None:
        rules.append(Rule(label, tuple(k.encode() for k in keyword.split("|")),
                          re.compile(f" (?:{pattern})(?= )".encode()), priority, score))

    tail = "(?: only| or (?:any )?later(?: version)?)?"
    under = "(?:released|licen[cs]ed|distributed|available) under (?:the )?(?:terms of the )?"
    for label, short, name, versions, keyword in FAMILIES:
        tag = "spdx license identifier "
        for v in versions:
            add(f"{label}-{v}", f"{tag}{short} {version(v)}{tail}", "spdx", 0, 1.0)
            add(f"{label}-{v}", f"(?:{under})?(?:{name}) {version(v)}{tail}", keyword, 1, 0.95)
            add(f"{label}-{v}", f"licen[cs]ed under (?:the )?{short} ?{version(v)}{tail}", "licen", 1, 0.9)
        add(label, f"{tag}{short}{tail}", "spdx", 2, 0.95)
        add(label, f"{under}(?:{name})", keyword, 2, 0.85)
        add(label, name, keyword, 3, 0.7)
    for label, pattern, keyword, score in NOTICES:
        add(label, pattern, keyword, 2, score)
    return rules


def resolve(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of (start, end, priority, rule) those no better detection contains, in one pass over their order.

    Better means a longer place with at least as good a priority, or the same place with the better priority or earlier rule.
    """
    kept: list[tuple[int, int, int, int]] = []
    reach: dict[int, int] = {}  # the furthest end so far of each priority
    # Whatever contains a detection comes before it in this order.
    for d in sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3])):
        if not any(end >= d[1] for priority, end in reach.items() if priority <= d[2]):
            kept.append(d)
        reach[d[2]] = max(reach.get(d[2], 0), d[1])
    return sorted(kept)


def word_places(padded: bytes, at: list[int]) -> list[int]:
    """How many words stand before each place: one pass over the text, however many places."""
    if not at:
        return []
    return np.searchsorted(np.flatnonzero(np.frombuffer(padded, np.uint8) == 32), at).tolist()


def scan(padded: bytes, rules: list[Rule]) -> list[tuple[int, int, str, float]]:
    """(first word, word after the last, label, score) of each detection that stays; ``padded`` is " word word ... "."""
    if not any(g in padded for g in GATES):
        return []
    found = []
    for i, rule in enumerate(rules):
        if any(k in padded for k in rule.keywords):
            for m in rule.pattern.finditer(padded):
                found.append((m.start(), m.end(), rule.priority, i))
    out = resolve(found)
    first, after = (word_places(padded, [d[k] for d in out]) for k in (0, 1))
    return [(a, b, rules[d[3]].label, rules[d[3]].score) for a, b, d in zip(first, after, out)]


def base_places(padded: bytes) -> list[tuple[int, str]]:
    """(first word, label) of each place where a base phrase stands."""
    places, labels = [], []
    for phrase, label in BASE.items():
        at = padded.find(b" " + phrase + b" ")
        while at >= 0:
            places.append(at)
            labels.append(label)
            at = padded.find(b" " + phrase + b" ", at + 1)
    return sorted(zip(word_places(padded, places), labels))


DETECTIONS = "array<struct<first:long,after:long,label:string,score:double>>"
PLACES = "array<struct<first:long,label:string>>"


def find_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, base places, detections) of each row."""
    narrow_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = StructType.fromDDL(f"n_words long, base {PLACES}, detections {DETECTIONS}")
    schema = StructType([rows.schema["id"], *found.fields])
    kinds = [pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())])),
             pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = make_rules()
        for batch in batches:
            counts, base, found = [], [], []
            for t in pc.cast(batch.column(1), pa.binary()).to_pylist():
                w = (t or b"").translate(WORDS).split()
                padded = b" " + b" ".join(w) + b" "
                counts.append(len(w))
                base.append([{"first": a, "label": x} for a, x in base_places(padded)])
                found.append([{"first": a, "after": b, "label": x, "score": s} for a, b, x, s in scan(padded, rules)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(base, kinds[0]), pa.array(found, kinds[1])],
                names=["id", "n_words", "base", "detections"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc_id)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.transform("base", lambda b: b["first"])
    base = F.transform("base", lambda b: b["label"])
    both = F.concat(base, F.transform("detections", lambda d: d["label"]))
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.greatest(F.array_max(F.transform("detections", lambda d: d["score"])), F.when(F.size("base") > 0, F.lit(0.5)), F.lit(0.0))
    return find_licenses(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), listed(base).alias("base_labels"), listed(both).alias("labels"), score.alias("score"))
