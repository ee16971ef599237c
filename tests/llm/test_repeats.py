"""Suffix-array dedup against a count of all strings, at small settings that
reach every path (blocks of 8, 2 and 1 starts included)."""

import hashlib
import random
from collections import Counter

import pytest

from llm_helpers import edge_rows, frame  # noqa: F401

from tramline.llm import repeats as P


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if counts[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone)))
        out.append((len(r), len(r) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed, cell", [(0, 2), (1, 1), (2, 64)])
def test_equals_a_plain_count(frame, edge_rows, seed, cell):
    rnd = random.Random(seed)
    letters = "ab é\x00" if seed % 2 else "abcdefgh éü"
    passages = ["".join(rnd.choice(letters) for _ in range(rnd.randint(30, 120)))
                for _ in range(6)]
    texts = []
    for _ in range(50):
        t = ""
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            p = p[rnd.randint(0, 10) if rnd.random() < 0.5 else 0:]
            p = p[:rnd.randint(5, len(p)) if rnd.random() < 0.4 else len(p)]
            if rnd.random() < 0.3:
                at = rnd.randrange(len(p))
                p = p[:at] + "Z" + p[at + 1:]
            t += "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) + p
        texts.append(t)
    texts += ["ab" * 100, "c" * 300, texts[3], texts[3], "x" + texts[5], texts[7] + "yyy"]
    rows = [(i if i % 13 else None, t) for i, t in enumerate(texts)]
    rows += [(r[0], r[1]) for r in edge_rows if r[0] != 7]
    s = P.Settings(length=40, gram=20, cell=cell, blocks=(8, 2, 1), batch_bytes=700)
    got = P.without_repeats(frame(rows), s).collect()

    def key(x):
        return str(x)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got),
                  key=key) == sorted(((r[0], *x) for r, x in
                                      zip(rows, plain([t for _, t in rows], 40))), key=key)


def test_passage_in_many_surroundings(frame):
    """One passage of a hundred documents: more classes than a cell takes."""
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefghij ") for _ in range(500))
    own = ["".join(rnd.choice("klmnopqrst ") for _ in range(300)) for _ in range(200)]
    rows = [(i, own[i] + passage + own[100 + i]) for i in range(100)]
    for r in P.without_repeats(frame(rows), P.Settings(cell=16)).collect():
        # Bytes beside it may agree by chance.
        assert 500 <= r.n_removed < 510 and r.n_spans == 1 and r.spans[0]["first"] <= 300


def test_passages_of_over_50_words(frame):
    """Passages that stand in two documents go whole from 400 bytes on; of
    shorter ones, whatever their number of words, nothing goes."""
    rnd = random.Random(11)

    def words(n, letters):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9)))
                        for _ in range(n))

    rows, planted = [], []
    for n in range(51, 91):
        p = words(n, "abcdefgh é")
        for _ in range(2):
            planted.append(len(p.encode()))
            rows.append((len(rows), f"{words(40, 'klmnopqr')}\n{p}\n{words(40, 'stuvwxyz')}"))
    # The line breaks on both sides agree too.
    short = [n + 2 < 400 for n in planted]
    assert 10 < sum(short) < len(short) - 10
    clean = [(len(rows) + i, words(120, "ijklmnop")) for i in range(20)]
    got = sorted(P.without_repeats(frame(rows + clean)).collect())
    for r, size, brief in zip(got, planted, short):
        assert r.n_removed == 0 if brief else size + 2 <= r.n_removed < size + 10
    assert all(r.n_removed == 0 for r in got[len(rows):])
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == plain(
        [t for _, t in rows + clean], 400)


def test_maximal_repeats_have_all_occurrences():
    bodies = [b"xxabcdefyy", b"zzabcdefyw", b"qqabcdefgg"]
    import numpy as np
    found = P.maximal_repeats(bodies, np.array([5, 5, 5]), 6)
    sets = {(n, frozenset(zip(o.tolist(), f.tolist()))) for n, o, f in found}
    assert (6, frozenset({(0, 2), (1, 2), (2, 2)})) in sets
    assert (7, frozenset({(0, 2), (1, 2)})) in sets and len(sets) == 2


def test_empty_table(frame):
    assert P.without_repeats(frame([])).count() == 0
