"""License scan: notice phrases and identifier tags found by Aho-Corasick, and
licence expressions (``(MIT OR Apache-2.0) AND GPL-2.0 WITH x``) evaluated by a
shunting-yard parser.

A text is read twice by automata, whatever the number of phrases: once as its
words, one blank between them, for the notices (their words must stand
consecutively, with any separators), and once as it stands, for the tags that
an expression follows to the end of its line. An expression has a value, the
terms it leaves its reader: of ``or`` the freer side, of ``and`` the stricter
one, and ``with`` an exception makes a copyleft licence a weak one. All work is
per row: one scan, no shuffle.

Defined results: a null or empty text has no words, no labels (empty strings)
and score 0; an empty table gives an empty table; repeated rows each get their
own row; overlapping places all count; a broken expression is read up to the
token that breaks it; other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import python_ready, table

# The notices of the contract, words and label.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Further notices, words and label.
PHRASES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("common development and distribution license", "cddl"),
    ("boost software license", "bsl"),
    ("artistic license", "artistic"),
    ("open font license", "ofl"),
    ("open database license", "odbl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc by nc sa", "cc-by-nc-sa"),
    ("cc by nc nd", "cc-by-nc-nd"),
    ("cc0", "cc0"),
    ("all rights reserved", "proprietary"),
)

#: Terms from the strictest to the freest; ``unknown`` where no licence is known.
TERMS = ("restricted", "copyleft", "weak-copyleft", "permissive")

# Families of licence identifiers and their terms (a place in TERMS).
FAMILIES = {
    "0bsd": 3, "afl": 3, "agpl": 1, "apache": 3, "artistic": 2, "blueoak": 3, "bsd": 3,
    "bsl": 3, "busl": 0, "cc-by": 3, "cc-by-nc": 0, "cc-by-nc-nd": 0, "cc-by-nc-sa": 0,
    "cc-by-nd": 0, "cc-by-sa": 1, "cc0": 3, "cddl": 2, "cecill": 1, "epl": 2, "eupl": 1,
    "gfdl": 1, "gpl": 1, "isc": 3, "lgpl": 2, "mit": 3, "mpl": 2, "ms-pl": 2, "ncsa": 3,
    "odbl": 1, "ofl": 2, "openssl": 3, "postgresql": 3, "proprietary": 0, "psf": 3,
    "python": 3, "sspl": 0, "unlicense": 3, "wtfpl": 3, "x11": 3, "zlib": 3,
}

#: Tags that an expression follows; behind a ``loose`` one it must start with a known licence.
TAGS = (("spdx-license-identifier:", "strict"), ("license-expression:", "strict"),
        ("license:", "loose"), ("licence:", "loose"))

#: How sure a finding is: a parsed tag, a notice of four words or more, a shorter one.
TAG_EVIDENCE, LONG_EVIDENCE, SHORT_EVIDENCE = 0.95, 0.9, 0.6

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of lower-cased bytes
_TO_BLANKS = bytes(32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c
                   for c in range(256))
_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9](?:[A-Za-z0-9.:_-]*[A-Za-z0-9])?\+?)")
_BINDING = {"or": 1, "and": 2, "with": 3}

SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, terms string, expressions array<string>, "
          "found array<struct<label: string, kind: string, first: long, last: long>>")


def family(identifier: str) -> str | None:
    """The family of a licence identifier (``GPL-2.0-or-later`` is of ``gpl``):
    the longest known name that it is, or that it begins with before a hyphen."""
    parts = identifier.lower().rstrip("+").split("-")
    return next((name for n in range(len(parts), 0, -1)
                 if (name := "-".join(parts[:n])) in FAMILIES), None)


@dataclass(frozen=True)
class Value:
    """What an expression comes to: its text with all brackets that matter, the
    families in it, and its terms (a place in TERMS, None if unknown)."""
    text: str
    labels: frozenset[str]
    terms: int | None
    binding: int = 9

    def inside(self, binding: int) -> str:
        return f"({self.text})" if self.binding < binding else self.text


def _licence(identifier: str) -> Value:
    name = family(identifier)
    return Value(identifier, frozenset([name] if name else []), FAMILIES.get(name))


def _apply(operator: str, left: Value, right: Value) -> Value:
    binding = _BINDING[operator]
    text = f"{left.inside(binding)} {operator.upper()} {right.inside(binding)}"
    if operator == "with":
        terms = 2 if left.terms == 1 else left.terms
        return Value(text, left.labels, terms, binding)
    known = [v.terms for v in (left, right) if v.terms is not None]
    if operator == "or":
        terms = max(known, default=None)
    else:
        terms = min(known) if len(known) == 2 else None
    return Value(text, left.labels | right.labels, terms, binding)


def evaluate(text: str) -> Value | None:
    """The value of the licence expression at the start of ``text``, None if
    there is none. Operators bind as ``with``, ``and``, ``or``, each from the
    left. Reading ends at the line's end or at the first token that cannot
    follow; what is open then is closed, an operator without a right side goes."""
    values: list[Value] = []
    operators: list[str] = []

    def reduce() -> None:
        right = values.pop()
        values.append(_apply(operators.pop(), values.pop(), right))

    place, operand_next = 0, True
    while (token := _TOKEN.match(text, place)) is not None:
        word = token[1]
        kind = word if word in "()" else word.lower() if word.lower() in _BINDING else "id"
        if operand_next != (kind in ("(", "id")):
            break
        if kind == "(":
            operators.append("(")
        elif kind == "id":
            values.append(_licence(word))
            operand_next = False
        elif kind == ")":
            if "(" not in operators:
                break
            while operators[-1] != "(":
                reduce()
            operators.pop()
        else:
            while operators and operators[-1] != "(" and _BINDING[operators[-1]] >= _BINDING[kind]:
                reduce()
            operators.append(kind)
            operand_next = True
        place = token.end()
    if operand_next:  # the last operator, or bracket, has nothing behind it
        while operators and (operators[-1] == "(" or len(values) < 1 + sum(
                o != "(" for o in operators)):
            operators.pop()
    if not values:
        return None
    while operators:
        if operators[-1] == "(":
            operators.pop()
        else:
            reduce()
    return values[0]


@dataclass(frozen=True)
class Catalogue:
    """What is searched for. Base phrases are counted and placed; the others
    only give labels."""
    base: tuple[tuple[str, str], ...] = BASE_PHRASES
    phrases: tuple[tuple[str, str], ...] = PHRASES
    tags: tuple[tuple[str, str], ...] = TAGS

    @cached_property
    def notices(self):
        """Automaton of blank-bounded phrases; values (words, labels, is base)."""
        import ahocorasick
        by_phrase: dict[str, tuple[list[str], bool]] = {}
        for phrases, base in ((self.base, True), (self.phrases, False)):
            for phrase, label in phrases:
                labels, is_base = by_phrase.get(phrase, ([], False))
                by_phrase[phrase] = ([*labels, (label, base)], is_base or base)
        machine = ahocorasick.Automaton()
        for phrase, (labels, _) in by_phrase.items():
            # Latin-1 stands for bytes: one character each.
            machine.add_word(f" {phrase} ".encode().decode("latin-1"),
                             (len(phrase.split()), tuple(labels)))
        machine.make_automaton()
        return machine

    @cached_property
    def tagged(self):
        import ahocorasick
        machine = ahocorasick.Automaton()
        for tag, kind in self.tags:
            machine.add_word(tag, (len(tag), kind))
        machine.make_automaton()
        return machine

    def __getstate__(self):  # automata are built where they run
        return {k: v for k, v in self.__dict__.items() if k in self.__dataclass_fields__}


def _expressions(lowered: bytes, raw: bytes, catalogue: Catalogue):
    """(value, first byte of the tag, last byte) of each expression, in order.
    A tag counts once, by its longest form (``license:`` ends longer tags)."""
    seen = 0
    hits = sorted((end - size + 1, -size, kind)
                  for end, (size, kind) in catalogue.tagged.iter(lowered.decode("latin-1")))
    for start, size, kind in hits:
        behind = start - size
        if start < seen or (start and chr(lowered[start - 1]).isalnum()):
            continue
        end = raw.find(b"\n", behind)
        line = raw[behind:end if end >= 0 else len(raw)].decode(errors="replace")
        first = _TOKEN.match(line.lstrip(" \t\"'("))
        if kind == "loose" and (first is None or family(first[1]) is None):
            continue
        value = evaluate(line.lstrip(" \t\"'"))
        if value is not None:
            seen = behind
            yield value, start, behind


def scan(text: str | None, catalogue: Catalogue) -> tuple:
    """The columns of SCHEMA for one text."""
    raw = (text or "").encode()
    lowered = raw.lower()  # of bytes: A-Z only
    words = lowered.translate(_TO_BLANKS).split()
    joined = b" " + b" ".join(words) + b" "
    base_labels: set[str] = set()
    evidence: dict[str, float] = {}
    places: list[int] = []
    notices: list[tuple[int, int, str]] = []
    blanks = None
    for end, (size, labels) in catalogue.notices.iter(joined.decode("latin-1")):
        if blanks is None:
            blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
        word = int(np.searchsorted(blanks, end)) - size
        weight = LONG_EVIDENCE if size >= 4 else SHORT_EVIDENCE
        for label, is_base in labels:
            if is_base:
                places.append(word)
                base_labels.add(label)
            evidence[label] = max(evidence.get(label, 0.0), weight)
            notices.append((word, word + size, label))
    terms = [FAMILIES.get(x) for x in evidence]
    texts, spans = [], []
    for value, first, last in _expressions(lowered, raw, catalogue):
        texts.append(value.text)
        terms.append(value.terms)
        spans += [(first, last, label, "tag") for label in sorted(value.labels)]
        for label in value.labels:
            evidence[label] = max(evidence.get(label, 0.0), TAG_EVIDENCE)
    known = [t for t in terms if t is not None]
    if notices:
        at = [m.span() for m in _WORD.finditer(lowered)]
        spans += [(at[a][0], at[z - 1][1], label, "notice") for a, z, label in notices]
    doubt = 1.0
    for weight in evidence.values():
        doubt *= 1.0 - weight
    chars = _characters(raw, [x for span in spans for x in span[:2]])
    found = [{"label": label, "kind": kind, "first": chars[a], "last": chars[z]}
             for a, z, label, kind in sorted(spans)]
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(evidence)), 1.0 - doubt,
            TERMS[min(known)] if known else "unknown" if terms else None, texts, found)


def _characters(raw: bytes, places: list[int]) -> dict[int, int]:
    """Characters before each of some byte places of a text."""
    out, done, n = {}, 0, 0
    for place in sorted(set(places)):
        n += len(raw[done:place].decode(errors="replace"))
        out[place], done = n, place
    return out


def licences(text: Column | str, catalogue: Catalogue = Catalogue()) -> Column:
    """Struct column of SCHEMA's fields for a text column."""
    names = [c.split()[0] for c in re.split(r", (?=\w+ (?:long|string|double|array))", SCHEMA)]

    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [scan(t, catalogue) for t in texts]
        out = pd.DataFrame(rows, columns=names)
        for name in ("first_word", "last_word"):
            out[name] = out[name].astype("Int64")
        return out
    return run.asNondeterministic()(text)


def license_scan(docs: DataFrame, catalogue: Catalogue = Catalogue()) -> DataFrame:
    """One row per row of ``docs``: doc_id, words, places and labels of the base
    notices, all labels, a score (how sure it is that the text states a
    licence), the strictest terms stated, the expressions, and every finding
    with the characters [first, last) it takes up."""
    python_ready(docs)
    return docs.select("doc_id", licences("text", catalogue).alias("m")).select("doc_id", "m.*")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of ``documents``; without the list of findings."""
    return license_scan(table(spark, sf_dir, "documents")).drop("found")
