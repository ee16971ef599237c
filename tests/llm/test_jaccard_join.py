"""Jaccard components against all pairs, at settings that reach every path."""

import random
import re

import pytest

from llm_helpers import edge_rows, frame  # noqa: F401

from tramline.llm import jaccard_join as J
from tramline.llm.components import components
from tramline.llm.shingles import shingle_sets


def sets_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 4]) for i in range(len(words) - 3))


def all_pairs(rows, percent=85):
    sets = [sets_of(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    boiler = " ".join(rnd.choice(words) for _ in range(25))
    texts = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 1, 3, 30])):
            near = list(base)
            for _ in range(rnd.randint(0, 4)):
                near[rnd.randrange(len(near))] = rnd.choice(words)
            texts.append(" ".join(near).upper() if rnd.random() < 0.1 else " ".join(near))
    texts += [boiler + " " + " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
              for _ in range(20)]
    texts += [texts[0]] * 5 + ["a b c", "A  B\tc", "a b", ""]
    rnd.shuffle(texts)
    return list(enumerate(texts))


SETTINGS = {
    "as shipped": J.Settings(),
    "small batches": J.Settings(gather=500, batch_least=2),
    "all in cells": J.Settings(small_block=1, tile=4, columns=16, gather=800, bitmap_tile=5),
    "all frequent": J.Settings(batch_least=1, frequent=1 << 20),
    "few frequent": J.Settings(batch_least=1, least_bits=8, frequent=40, small_block=3, tile=8, columns=7),
}


@pytest.mark.parametrize("name", SETTINGS)
def test_equals_all_pairs(frame, edge_rows, name):
    rows = corpus(list(SETTINGS).index(name)) + [(1000 + (r[0] or 0) if r[0] is not None else None,
                                                  r[1]) for r in edge_rows]
    got = J.jaccard_components(frame(rows), SETTINGS[name]).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) \
        == all_pairs(rows)


def test_shingles_are_sets_of_words():
    texts = ["One two THREE four five", "one  two\tthree\nfour five", "x", "x y", "y x", None, "",
             "a b c d a b c d a b c d", "\xa0a b c d e"]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets] == [len(sets_of(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and sets[3][0] != sets[4][0]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 100), (7, 300)],
                                  "a long, b long")
    got = {r.node: r.root for r in components(edges, "test-path").collect()}
    assert got == {i: 0 for i in [*range(61), 300]}


def test_stage_keeps_one_of_each(spark, frame, edge_rows):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(9, text), (4, text + " end"), (96, text), (30, text + " other words at the end of it"),
            *[r for r in edge_rows if r[0] != 4]]
    out = J.keep_first(spark, frame(rows), "")
    assert out.columns == frame(rows).columns
    ids = [r.doc_id for r in out.collect()]
    assert 4 in ids and not {9, 96} & set(ids)
    assert {1, 2, 3, None} <= set(ids) and ids.count(5) == 2  # equal rows are one document


def test_stage_takes_five_words_and_80_percent(spark, frame):
    """Copies whose 5-word Jaccard lies between 0.80 and 0.85, and one below."""
    def words(name, n=100):
        return [f"{name}{i}" for i in range(n)]

    changed = words("b")
    changed[30], changed[60] = "x", "y"
    rows = [(1, words("b")), (2, changed),                     # 86 / 106 = 0.811
            (3, words("c")), (4, words("c") + words("d", 22)),  # 96 / 118 = 0.814
            (5, words("e")), (6, words("e", 82)),              # 78 / 96 = 0.8125
            (7, words("f")), (8, words("f") + words("g", 25))]  # 96 / 121 = 0.793
    docs = frame([(i, " ".join(w)) for i, w in rows])
    assert {r.doc_id for r in J.keep_first(spark, docs, "").collect()} == {1, 3, 5, 7, 8}
    assert len({r.component_id for r in J.jaccard_components(docs).collect()}) == 8  # op8: 4 / 85


def test_empty_table(frame):
    assert J.jaccard_components(frame([])).count() == 0
