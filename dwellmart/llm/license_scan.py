"""License scans by ordered signature rules: regular expressions behind a keyword gate.

A text is read as its words, lower-cased and parted by single spaces; rules look at that form. A rule has
a label, a priority, a weight (how sure it is) and keywords: it is tried only on texts in which all of its
keywords stand, which one Aho-Corasick pass over the text finds for all rules. Detections overlap, as
"gnu lesser general public license version 3" holds two names; of two detections one of which lies
within the other, the one of higher priority stays, and among equals the longer, then the earlier.

What licenses say is written out rule by rule in ``license_signatures``. What they are called comes from two tables
here, the licenses with their spellings and versions and the phrases that licenses are named in. The
base phrases are rules too, but their labels and places are never suppressed.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from dwellmart.llm.license_signatures import SIGNATURES
from dwellmart.llm.stored import text_bytes

#: Phrases whose every place counts, and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: ASCII that is no letter or digit parts words; A-Z become a-z; bytes of other scripts stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class License:
    """A label, the spellings of its name, its SPDX stems and its versions, as words."""

    label: str
    names: tuple[str, ...]
    ids: tuple[str, ...] = ()
    versions: tuple[str, ...] = ()


LICENSES = (
    License("agpl", ("gnu affero general public licen[cs]e", "affero gpl"), ("agpl",), ("1 0", "3 0", "3")),
    License("lgpl", ("gnu (?:lesser|library) general public licen[cs]e", "gnu lgpl"), ("lgpl",), ("2 0", "2 1", "2", "3 0", "3")),
    License("gfdl", ("gnu free documentation licen[cs]e",), ("gfdl",), ("1 1", "1 2", "1 3")),
    License("gpl", ("(?:gnu )?general public licen[cs]e", "gnu gpl"), ("gpl",), ("1 0", "2 0", "2", "3 0", "3")),
    License("apache", ("apache (?:software )?licen[cs]e",), ("apache",), ("1 0", "1 1", "2 0", "2")),
    License("mit", ("mit licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e"), ("mit", "x11")),
    License("bsd-4-clause", ("bsd 4 clause", "(?:four|4) clause bsd", "original bsd licen[cs]e"), ("bsd 4 clause",)),
    License("bsd-3-clause", ("bsd 3 clause", "(?:three|3) clause bsd", "(?:new|modified|revised) bsd licen[cs]e"), ("bsd 3 clause",)),
    License("bsd-2-clause", ("bsd 2 clause", "(?:two|2) clause bsd", "(?:simplified|freebsd) (?:bsd )?licen[cs]e"), ("bsd 2 clause",)),
    License("bsd", ("bsd (?:style )?licen[cs]e",), ("bsd",)),
    License("mpl", ("mozilla public licen[cs]e",), ("mpl",), ("1 0", "1 1", "2 0", "2")),
    License("epl", ("eclipse public licen[cs]e",), ("epl",), ("1 0", "2 0")),
    License("cddl", ("common development and distribution licen[cs]e",), ("cddl",), ("1 0", "1 1")),
    License("cpl", ("common public licen[cs]e",), ("cpl",), ("1 0",)),
    License("eupl", ("european union public licen[cs]e",), ("eupl",), ("1 0", "1 1", "1 2")),
    License("artistic", ("(?:perl )?artistic licen[cs]e",), ("artistic",), ("1 0", "2 0")),
    License("isc", ("isc licen[cs]e", "internet systems consortium licen[cs]e"), ("isc",)),
    License("zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e"), ("zlib",)),
    License("boost", ("boost software licen[cs]e",), ("bsl",), ("1 0",)),
    License("unlicense", ("the unlicense",), ("unlicense",)),
    License("wtfpl", ("do what the fuck you want to public licen[cs]e",), ("wtfpl",)),
    License("python", ("python software foundation licen[cs]e", "psf licen[cs]e"), ("psf",), ("2 0", "2")),
    License("php", ("php licen[cs]e",), ("php",), ("3 0", "3 01")),
    License("openssl", ("openssl licen[cs]e",), ("openssl",)),
    License("ofl", ("sil open font licen[cs]e", "open font licen[cs]e"), ("ofl",), ("1 0", "1 1")),
    License("odbl", ("open database licen[cs]e",), ("odbl",), ("1 0",)),
    License("ms-pl", ("microsoft public licen[cs]e",), ("ms pl",)),
    License("cc0", ("cc0", "creative commons zero"), ("cc0",), ("1 0",)),
    License("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution non ?commercial share ?alike"), ("cc by nc sa",), ("2 0", "2 5", "3 0", "4 0")),
    License("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?"), ("cc by nc nd",), ("2 0", "2 5", "3 0", "4 0")),
    License("cc-by-nc", ("cc by nc", "creative commons attribution non ?commercial"), ("cc by nc",), ("2 0", "2 5", "3 0", "4 0")),
    License("cc-by-nd", ("cc by nd", "creative commons attribution no ?deriv(?:ative)?s?"), ("cc by nd",), ("2 0", "2 5", "3 0", "4 0")),
    License("cc-by-sa", ("cc by sa", "creative commons attribution share ?alike"), ("cc by sa",), ("2 0", "2 5", "3 0", "4 0")),
    License("cc-by", ("cc by", "creative commons attribution"), ("cc by",), ("2 0", "2 5", "3 0", "4 0")),
)
#: Notices without a license's name, with the label of what they say.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("public-domain", "(?:released|placed|dedicated) (?:in ?to|in|to) the public domain"),
    ("all-rights-reserved", "all rights reserved"),
)
_OR_LATER = r"(?: or (?:\(?at your option\)? )?(?:any )?(?:later|newer)(?: version)?)?"
#: Phrase around a name or id, what it is filled with, its priority and its weight.
_NAMED = (
    ("(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}", 4, 0.95),
    ("(?:covered|governed) by (?:the )?(?:terms of )?(?:the )?{name}", 4, 0.9),
    ("{name}", 2, 0.8),
)
_TAGGED = (
    ("spdx licen[cs]e identifier {id}", 6, 1.0),
    ("licen[cs]e {id}", 3, 0.7),
    ("licensed under (?:the )?{id}", 3, 0.8),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    weight: float


def _keywords(text: str) -> tuple[str, ...]:
    """The longest run of plain letters and digits of a pattern: what any match holds."""
    plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)\??|\[[^]]*\]|.\?", "\n", text)
    return (max((part.strip() for part in plain.split("\n")), key=len),)


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, by descending priority, then in the order of the tables."""
    made = []
    for lic in LICENSES:
        versions = [rf" (?:version |v ?)?{v}{_OR_LATER}" for v in lic.versions]
        for frame, priority, weight in _NAMED:
            for name in lic.names:
                for tail in versions:
                    made.append(Rule(lic.label, frame.format(name=name) + tail, _keywords(name), priority + 1, weight))
                made.append(Rule(lic.label, frame.format(name=name), _keywords(name), priority, weight))
        for frame, priority, weight in _TAGGED:
            for stem in lic.ids:
                for v in lic.versions:
                    tagged = rf"{stem} ?(?:v ?)?{v}(?: only| or later)?"
                    made.append(Rule(lic.label, frame.format(id=tagged), _keywords(stem), priority + 1, weight))
                made.append(Rule(lic.label, frame.format(id=stem), _keywords(stem), priority, weight))
    made += [Rule(label, pattern, _keywords(pattern), 5, 0.9) for label, pattern in NOTICES]
    made += [Rule(label, pattern, keywords, priority, weight) for label, priority, weight, keywords, pattern in SIGNATURES]
    return tuple(sorted(made, key=lambda rule: -rule.priority))


@dataclass(frozen=True)
class Found:
    """A detection: characters [start, end) of the normal form of the text."""

    label: str
    start: int
    end: int
    priority: int
    weight: float


class Scanner:
    """Compiled rules and the automaton of their keywords."""

    def __init__(self):
        self.rules = [(rule, re.compile(rf"(?<![^ ]){rule.pattern}(?![^ ])".encode())) for rule in rules()]
        self.gate = ahocorasick.Automaton()
        keywords = sorted({word for rule, _ in self.rules for word in rule.keywords})
        number = {word: i for i, word in enumerate(keywords)}
        #: The rules by the first of their keywords, with the others.
        self.by_word: list[list[tuple[int, frozenset[int]]]] = [[] for _ in keywords]
        for i, (rule, _) in enumerate(self.rules):
            first, *others = (number[word] for word in rule.keywords)
            self.by_word[first].append((i, frozenset(others)))
        for word, i in number.items():
            self.gate.add_word(word, i)
        self.gate.make_automaton()

    def detections(self, form: bytes) -> list[Found]:
        """What is left after suppression, by place."""
        held = {word for _, word in self.gate.iter(form.decode("latin-1"))}
        due = [i for word in held for i, others in self.by_word[word] if others <= held]
        found = [
            Found(rule.label, match.start(), match.end(), rule.priority, rule.weight)
            for i in sorted(due)
            for rule, pattern in (self.rules[i],)
            for match in pattern.finditer(form)
        ]
        return suppressed(found)


def suppressed(found: list[Found]) -> list[Found]:
    """Without detections that lie within one of higher rank or within which one of higher rank lies."""
    ranked = sorted(found, key=lambda f: (-f.priority, f.start - f.end, f.start, f.label))
    stays: list[Found] = []
    starts = _Intervals()
    for one in ranked:
        if not starts.contains_or_within(one.start, one.end):
            starts.add(one.start, one.end)
            stays.append(one)
    return sorted(stays, key=lambda f: (f.start, f.end))


class _Intervals:
    """Intervals none of which holds another, so both of their ends ascend together."""

    def __init__(self):
        self.start: list[int] = []
        self.end: list[int] = []

    def contains_or_within(self, start: int, end: int) -> bool:
        before = bisect_right(self.start, start)
        if before and self.end[before - 1] >= end:
            return True
        after = bisect_left(self.start, start)
        return after < len(self.start) and self.end[after] <= end

    def add(self, start: int, end: int) -> None:
        at = bisect_left(self.start, start)
        self.start.insert(at, start)
        self.end.insert(at, end)


@cache
def _scanner() -> Scanner:
    return Scanner()


_BASE = tuple((f" {phrase} ".encode(), label) for phrase, label in BASE_PHRASES)


def base_places(form: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase, by word; places may overlap."""
    padded, places = b" " + form + b" ", []
    for phrase, label in _BASE:
        at = padded.find(phrase)
        while at >= 0:
            places.append((at, label))
            at = padded.find(phrase, at + 1)
    words, last, result = 0, 0, []
    for at, label in sorted(places):
        words += padded.count(b" ", last, at)
        last = at
        result.append((words, label))
    return result


_ROWS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:long,n_words:long,weight:double>>"
)


def scan_text(text: bytes) -> dict:
    words = text.translate(WORD_BYTES).split()
    form = b" ".join(words)
    places = base_places(form)
    found = _scanner().detections(form)
    base = {label for _, label in places}
    weights = [f.weight for f in found] + [0.8] * bool(places)
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": places[0][0] if places else None,
        "last_word": places[-1][0] if places else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {f.label for f in found})),
        "score": max(weights, default=0.0),
        "spans": _spans(form, found),
    }


def _spans(form: bytes, found: list[Found]) -> list[dict]:
    """Detections, given by place, as words. The text before them is gone through once for all of them."""
    spans, first_word, last = [], 0, 0
    for f in found:
        first_word += form.count(b" ", last, f.start)
        last = f.start
        n_words = form.count(b" ", f.start, f.end) + 1
        spans.append({"label": f.label, "first_word": first_word, "n_words": n_words, "weight": f.weight})
    return spans


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("weight", pa.float64())])
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
    kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(span))
    for batch in batches:
        rows = [scan_text(text) for text in batch.column("text").to_pylist()]
        columns = [pa.array([row[name] for row in rows], kind) for name, kind in zip(names, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])


def scanned(docs: DataFrame) -> DataFrame:
    """Documents -> one row each: words, base places, labels, score and the detections that stay (spans).

    ``score`` is the weight of the surest detection, 0 without any. NULL and empty texts have no words and
    empty label strings. Repeated rows are scanned each. An empty table gives no rows. Extra columns are
    not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_bytes(docs["text"]).alias("text"))
    return rows.mapInArrow(_scan, f"doc_id {kind}, {_ROWS}")
