"""Boosted trees: held-out accuracy, flat traversal, edge cases."""

import math

import numpy as np
import pytest

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm import quality_trees as Q
from tramline.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = Q.score(docs, Q.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert len(got) > 40
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert np.mean([r.predicted for r in got if r.quality == 1]) > 0.97


def test_flat_traversal_equals_a_walk(rng):
    x = np.array([[rng.random() for _ in range(5)] for _ in range(400)])
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    t = Q.grow(x, y, Q.Settings(trees=30, depth=3, bins=16))
    s = t.score(x)
    assert np.mean((s > 0.5) == y) > 0.95
    for row in range(0, 400, 37):
        total = t.base
        for root in t.roots:
            node = root
            for _ in range(t.depth):
                node = t.right[node] if x[row, t.feature[node]] > t.cut[node] else t.left[node]
            total += t.value[node]
        assert abs(s[row] - 1 / (1 + np.exp(-total))) < 1e-12


def plain_trees(x, y, s):
    """The same trees by trying every cut of every statistic on every node's
    rows, one by one: (margins, cuts in the order of a walk, left before right)."""
    share = (sum(y) + 1) / (len(y) + 2)
    margin = [math.log(share / (1 - share))] * len(y)
    cuts = [sorted(set(np.quantile(x[:, j], [i / s.bins for i in range(1, s.bins)]).tolist()))
            for j in range(x.shape[1])]
    told = []

    def part(rows, grad, hess, depth):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-9, None, None)
        for j in range(x.shape[1]) if depth else ():
            for cut in cuts[j]:
                low = [i for i in rows if x[i, j] <= cut]
                high = [i for i in rows if x[i, j] > cut]
                if len(low) < s.least_rows or len(high) < s.least_rows:
                    continue
                gl, hl = sum(grad[i] for i in low), sum(hess[i] for i in low)
                gain = (gl ** 2 / (hl + s.ridge) + (g - gl) ** 2 / (h - hl + s.ridge)
                        - g ** 2 / (h + s.ridge))
                if gain > best[0] + 1e-12:
                    best = (gain, j, cut)
        if best[1] is None:
            told.append(None)
            return {i: -s.rate * g / (h + s.ridge) for i in rows}
        told.append(best[1:])
        return {**part([i for i in rows if x[i, best[1]] <= best[2]], grad, hess, depth - 1),
                **part([i for i in rows if x[i, best[1]] > best[2]], grad, hess, depth - 1)}

    for _ in range(s.trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        step = part(list(range(len(y))), [a - b for a, b in zip(p, y)],
                    [a * (1 - a) for a in p], s.depth)
        margin = [m + step[i] for i, m in enumerate(margin)]
    return margin, told


def walked(t, node):
    """Cuts of a flat tree in the order of a walk; None for a leaf."""
    if t.left[node] == node:
        return [None]
    return [(t.feature[node], t.cut[node]), *walked(t, t.left[node]), *walked(t, t.right[node])]


@pytest.mark.parametrize("seed, trees, depth, bins, least", [
    (1, 1, 1, 4, 1), (2, 1, 3, 8, 2), (3, 4, 2, 5, 3), (4, 3, 3, 16, 8)])
def test_fit_equals_every_cut_tried(seed, trees, depth, bins, least):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(90, 4))
    x[:, 2] = rnd.integers(0, 3, 90)      # few values: equal quantiles
    x[:, 3] = 1.0                         # nothing to cut at
    y = ((x[:, 0] + 0.5 * x[:, 2] + 0.3 * rnd.normal(size=90)) > 0.4).astype(float)
    s = Q.Settings(trees=trees, depth=depth, bins=bins, least_rows=least)
    t = Q.grow(x, y, s)
    margin, told = plain_trees(x, y.tolist(), s)
    assert np.allclose(t.score(x), 1 / (1 + np.exp(-np.array(margin))), atol=1e-9)
    flat = [c for root in t.roots for c in walked(t, root)]
    assert len(flat) == len(told)
    for a, b in zip(flat, told):
        assert (a is None) == (b is None)
        assert a is None or (a[0] == b[0] and abs(a[1] - b[1]) < 1e-9)


def test_empty_tables_ties_and_clashing_names(spark, frame, edge_rows):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)],
                                   "doc_id long, quality int, toxic int")
    trees = Q.fit(frame(edge_rows), labels)
    assert Q.score(frame([]), trees).count() == 0
    assert len(Q.fit(frame([]), labels).roots) == 1
    clash = frame(edge_rows).selectExpr("*", "1 AS quality", "2 AS score", "true AS held_out")
    got = Q.score(clash, trees).collect()
    assert got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert len({r.score for r in got if r.doc_id == 5}) == 1 and len(got) == len(edge_rows)


def test_labels_of_one_class_or_none(spark, frame, edge_rows):
    docs = frame(edge_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.score(docs, Q.fit(docs, none)).collect()
    assert len(got) == len(edge_rows) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)] + [(None, 0, 0)],
                                "doc_id long, quality int, toxic int")
    scores = {r.score for r in Q.score(docs, Q.fit(docs, one)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5


def test_sample_is_bounded(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    trees = Q.fit(docs, labels, Q.Settings(sample=60, trees=5))
    assert len(trees.roots) == 5


def test_statistics_of_odd_texts():
    for t in (None, "", "  ", "\n", "x", "a b", "\U0001F600 é", "word " * 30_000):
        row = Q.statistics(t)
        assert len(row) == len(Q.STATISTICS) and np.isfinite(row).all()
