"""Ranked search against a plain scoring of every document, and what it skips."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm import ranked_search as rs
from tramline.llm.common import table
from tramline.llm.ranked_search import (
    PostingList, Settings, best_of, build_index, impact, length_part, op11_ranked_search,
    ranked_search, search, terms_of, top_places,
)

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, k=10):
    """{item: [(doc_id, score), ...]} by scoring every document."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, tokens = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = {}
    for item, terms in wanted.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                  for t in terms if t in df}
        rows = []
        for i, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // tokens
            score = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, w in weight.items() if t in c)
            if score > 0:
                rows.append((i, score))
        rows.sort(key=lambda r: (-r[1], r[0] is not None, r[0] or 0))
        if rows:
            out[item] = rows[:k]
    return out


def told(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r.rank)):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows],
                                 "item_id long, text string, score string")


def words(rng, n, size=60):
    """Words of uneven frequency."""
    return " ".join(f"w{int(size * rng.random() ** 3)}" for _ in range(n))


SMALL = Settings(block=4, shard_bytes=3000, items_bytes=200)


def test_random_texts_over_many_shards_and_blocks(spark, frame, rng):
    docs = [(i, words(rng, rng.choice([1, 5, 30, 120]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(15)]  # ties, in reverse order of place
    items = [(i, words(rng, rng.choice([1, 3, 12]))) for i in range(25)] + [(90, docs[7][1])]
    got = told(ranked_search(frame(docs), items_frame(spark, items), SMALL))
    assert got == plain(docs, items)
    assert got[90][0][0] == 7 and [d for d, _ in got[90][1:]] == list(range(1000, 1009))


def test_edge_rows(spark, frame, edge_rows):
    items = [(None, "a text words"), (1, None), (2, ""), (3, "LONG été 😀"), (4, "nothing known"),
             (5, "same"), (5, "words rows"), (6, "x"), (7, "one one ONE")]
    got = told(ranked_search(frame(edge_rows), items_frame(spark, items)))
    want = plain(edge_rows, items)
    assert got == want and {1, 2, 4} & set(got) == set() and None in got
    # Two rows of one id are two documents.
    assert [d for d, _ in got[5][:2]] == [5, 5]


def test_empty_tables(spark, frame):
    one = items_frame(spark, [(1, "a")])
    assert ranked_search(frame([]), one).count() == 0
    assert ranked_search(frame([(1, None)]), one).count() == 0
    assert ranked_search(frame([(1, "a")]), items_frame(spark, [])).count() == 0


def test_index_of_all_terms_answers_any_item(spark, frame, rng):
    docs = [(i, words(rng, 40)) for i in range(200)]
    items = [(i, words(rng, 4)) for i in range(5)]
    index = build_index(frame(docs), settings=SMALL)
    assert told(search(index, items_frame(spark, items), SMALL)) == plain(docs, items)
    # Beyond ``most_terms`` the index holds all lists, with the same answers.
    few = Settings(most_terms=2)
    assert told(ranked_search(frame(docs), items_frame(spark, items), few)) == plain(docs, items)
    held = {r.term for r in index.select("term").distinct().collect()}
    assert held == {""} | {w for _, t in docs for w in t.split()}


def test_terms():
    text = "Été MAÑANA_x1-2 İI \x7f\x00a b"
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def lists_of(texts, block):
    counts = [Counter(t.split()) for t in texts]
    sizes = np.array([sum(c.values()) for c in counts], dtype=np.int64)
    m = length_part(sizes, len(texts), int(sizes.sum()))
    out = {}
    for term in sorted({t for c in counts for t in c}):
        docs = np.array([i for i, c in enumerate(counts) if term in c], dtype=np.int64)
        tfs = np.array([c[term] for c in counts if term in c], dtype=np.int64)
        row = rs._list_row(0, term, docs, tfs, sizes, block)
        out[term] = PostingList(SimpleNamespace(**dict(zip(rs._COLUMNS, row))), m, len(texts),
                                int(sizes.sum()), block)
    return out, counts, m


def test_blocks_are_bounded_and_unpack(rng):
    texts = [words(rng, rng.randint(1, 60), 12) + " big" * rng.choice([0, 1, 300]) for _ in range(700)]
    lists, counts, m = lists_of(texts, 16)
    for term, postings in lists.items():
        docs = np.array([i for i, c in enumerate(counts) if term in c])
        want = impact(np.array([counts[d][term] for d in docs]), m[docs])
        assert (np.diff(postings.docs) >= 0).all()
        blocks, bounds = postings.bounds(docs)
        assert (bounds >= want).all()
        # The bound is reached in each block.
        assert all(want[blocks == b].max() == postings.best[b] for b in set(blocks.tolist()))
        postings.unpack(np.unique(blocks))
        assert (postings.docs == docs).all() and (postings.impacts_of(docs, blocks) == want).all()


@pytest.mark.parametrize("k", [1, 3, 10])
def test_rejects_before_unpacking(k):
    rng = random.Random(5)
    # A rare term decides; the common one is in all documents.
    texts = ["common " * rng.randint(1, 4) + "rare " * 3 * (i % 997 == 5) + words(rng, 20)
             for i in range(6000)]
    lists, counts, m = lists_of(texts, 64)
    weights = {"rare": 9000, "common": 5, "w3": 700, "w40": 2500}
    query = [(w, lists[t]) for t, w in weights.items()]
    got = best_of(*top_places(query, len(texts), k), list(range(len(texts))), k)
    scores = [(d, int(sum(w * impact(np.int64(c[t]), m[d]) for t, w in weights.items() if t in c)))
              for d, c in enumerate(counts)]
    assert got == sorted(scores, key=lambda r: (-r[1], r[0]))[:k]
    if k <= 3:
        assert lists["common"].ready.sum() < len(lists["common"].ready) / 10


def test_counts_of_every_width():
    counts = [1, 255, 256, 65_535, 65_536, 3]
    texts = [f"{'t ' * n}" for n in counts]
    lists, _, m = lists_of(texts, 2)
    postings = lists["t"]
    postings.unpack(np.arange(3))
    assert (postings.impacts == impact(np.array(counts), m)).all()


def test_query_spreads(spark):
    """The merge sorts ten rows of an item and part, cut before the exchange."""
    heaps = spark.createDataFrame([(1, 2, 3, 4)], "item_id long, shard long, doc_id long, score long")
    plan = rs.merged(heaps, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    assert told(op11_ranked_search(spark, sf)) == plain(docs, items)
