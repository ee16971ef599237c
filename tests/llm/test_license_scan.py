"""License scan against a plain count, and expressions against their meaning."""

import re

import pytest

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm.common import table
from tramline.llm.license_scan import (
    BASE_PHRASES, Catalogue, evaluate, family, license_scan, op12_license_scan, scan,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(UPPER))
    places, labels = [], set()
    for phrase, label in BASE_PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def base_of(row):
    return (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels)


def test_whole_table_equals_plain_count(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = op12_license_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert base_of(row) == plain(texts[row.doc_id])
        assert 0 <= row.score <= 1 and (row.score > 0) == (row.labels != "")
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert sum(r.n_base for r in rows) > 0


def test_edge_rows(spark, frame, edge_rows):
    more = [(20, "MIT\n  License, mit license MIT-LICENSE"), (21, "CC BY CC-BY cc_by"),
            (22, "The GNU General\tPublic (License) émit license"),
            (23, "İmit license; apache license2"), (24, "mit licensé"),
            (25, "MIT license " * 20_000)]
    rows = license_scan(frame(edge_rows + more)).collect()
    want = sorted(map(str, ((i, *plain(t)) for i, t in edge_rows + more)))
    assert sorted(str((r.doc_id, *base_of(r))) for r in rows) == want
    assert license_scan(frame([])).count() == 0
    nothing = next(r for r in rows if r.doc_id == 1)
    assert (nothing.labels, nothing.score, nothing.terms, nothing.found) == ("", 0.0, None, [])


@pytest.mark.parametrize("text, value, terms, labels", [
    ("MIT", "MIT", 3, {"mit"}),
    ("MIT OR GPL-2.0-only AND Apache-2.0", "MIT OR GPL-2.0-only AND Apache-2.0", 3,
     {"mit", "gpl", "apache"}),
    ("(MIT OR GPL-2.0-only) AND Apache-2.0", "(MIT OR GPL-2.0-only) AND Apache-2.0", 3,
     {"mit", "gpl", "apache"}),
    ("GPL-3.0+ and MIT", "GPL-3.0+ AND MIT", 1, {"gpl", "mit"}),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only WITH Classpath-exception-2.0",
     2, {"gpl"}),
    ("MIT WITH x OR GPL-2.0 WITH y AND AGPL-3.0", "MIT WITH x OR GPL-2.0 WITH y AND AGPL-3.0",
     3, {"mit", "gpl", "agpl"}),
    ("LicenseRef-own AND MIT", "LicenseRef-own AND MIT", None, {"mit"}),
    ("LicenseRef-own OR MIT", "LicenseRef-own OR MIT", 3, {"mit"}),
    ("((MIT", "MIT", 3, {"mit"}),
    ("MIT OR", "MIT", 3, {"mit"}),
    ("MIT OR (", "MIT", 3, {"mit"}),
    ("MIT) OR GPL-2.0", "MIT", 3, {"mit"}),
    ("MIT License", "MIT", 3, {"mit"}),
    ("Apache-2.0 */", "Apache-2.0", 3, {"apache"}),
    ("MIT OR (GPL-2.0 AND (BSD-3-Clause OR CC-BY-NC-4.0", None, 3,
     {"mit", "gpl", "bsd", "cc-by-nc"}),
])
def test_expressions(text, value, terms, labels):
    got = evaluate(text)
    assert (got.terms, got.labels) == (terms, labels)
    assert value is None or got.text == value


def test_no_expression():
    for text in ("", "OR", "AND MIT", ")", "(", "( )", "\nMIT", "*"):
        assert evaluate(text) is None


def test_precedence_against_all_bracketings(rng):
    """Random expressions against Python's own: and binds before or."""
    names = {"MIT": 3, "GPL-2.0": 1, "LGPL-3.0": 2, "BUSL-1.1": 0}

    def grow(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(list(names))
            return name, f"N({names[name]})"
        (a, x), (b, y) = grow(depth - 1), grow(depth - 1)
        op, sign = rng.choice([("AND", "&"), ("or", "|")])
        if rng.random() < 0.5:
            return f"({a} {op} {b})", f"({x} {sign} {y})"
        return f"{a} {op} {b}", f"{x} {sign} {y}"

    class N(int):
        def __and__(self, other):
            return N(min(int(self), int(other)))

        def __or__(self, other):
            return N(max(int(self), int(other)))

    for _ in range(300):
        text, twin = grow(5)
        got = evaluate(text)
        assert got.terms == eval(twin, {"N": N})
        assert evaluate(got.text).text == got.text  # what is printed reads back the same


def test_families():
    assert family("GPL-2.0-or-later") == "gpl" and family("cc-by-nc-sa-4.0") == "cc-by-nc-sa"
    assert family("CC-BY-4.0") == "cc-by" and family("MITx") is None and family("x-mit") is None


def test_tags_and_spans():
    text = ("# SPDX-License-Identifier: (MIT OR GPL-2.0) AND BSD-3-Clause # end\n"
            "é License: unknown words\nLicense: ISC\nReleased under the MIT License.")
    row = dict(zip(("n_words", "n_base", "first", "last", "base", "labels", "score", "terms",
                    "expressions", "found"), scan(text, Catalogue())))
    assert row["expressions"] == ["(MIT OR GPL-2.0) AND BSD-3-Clause", "ISC"]
    assert row["labels"] == "bsd,gpl,isc,mit" and row["base"] == "mit"
    assert row["terms"] == "permissive"
    cut = {(f["label"], f["kind"]): text[f["first"]:f["last"]] for f in row["found"]}
    assert cut["mit", "notice"] == "MIT License"
    assert cut["isc", "tag"] == "License:"
    assert cut["gpl", "tag"] == "SPDX-License-Identifier:"
    assert row["score"] > 0.99


def test_own_catalogue(spark, frame):
    own = Catalogue(base=(("own words", "own"),), phrases=(("own words", "second"),), tags=TAGS_OF)
    rows = {r.doc_id: r for r in license_scan(frame([(1, "my Own, words"), (2, "use: MIT")]),
                                              own).collect()}
    assert (rows[1].n_base, rows[1].labels, rows[1].base_labels) == (1, "own,second", "own")
    assert rows[2].labels == "mit" and rows[2].expressions == ["MIT"]


TAGS_OF = (("use:", "loose"),)
