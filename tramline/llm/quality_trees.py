"""Quality classifier: histogram gradient-boosted trees over statistics of a
document.

Every statistic is computed from the whole text, per row, in an Arrow batch.
Trees are grown level by level from histograms of binned statistics, on a
bounded sample of the labelled documents (``Settings.sample`` rows, chosen by
a hash of the id); scoring walks all trees at once over flat arrays.

Defined results: a null text counts as empty; empty texts get the score of
their (all-zero) statistics; without labels, or with one class only, every
score is the smoothed share of label 1. A document labelled twice counts
twice. Labels, lang, source and doc_id are no inputs of a score; repeated rows
each get their own row; an empty table of documents gives an empty table; equal
statistics get equal scores; columns other than those named are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import held_out, python_ready, table

STATISTICS = (
    "log_chars", "log_words", "chars_per_word", "long_word_share", "short_word_share",
    "upper_share", "upper_word_share", "title_word_share", "letter_share", "digit_share",
    "blank_share", "punctuation_share", "symbol_share", "bar_word_share", "end_mark_share",
    "exclaim_share", "symbol_word_share", "log_lines", "words_per_line", "dup_line_share",
    "distinct_word_share", "top_word_share", "same_neighbour_share", "dup_trigram_share",
    "word_entropy", "char_entropy", "non_ascii_share", "digit_word_share")


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000
    trees: int = 120
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least_rows: int = 20
    ridge: float = 1.0
    threshold: float = 0.3


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text."""
    t = text or ""
    words = t.split()
    n, w = len(t), len(words)
    if not w:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    small = np.bincount(np.minimum(codes, 256), minlength=257)
    letters = small[65:91].sum() + small[97:123].sum() + (codes >= 0xC0).sum()
    digits = small[48:58].sum()
    blanks = small[[32, 9, 10, 11, 12, 13]].sum()
    symbols = sum(small[ord(c)] for c in "#*$%&|<>@^~=+_\\{}[]")
    marks = sum(small[ord(c)] for c in ".,;:!?")
    lengths = np.array([len(x) for x in words])
    counts = Counter(words)
    shares = np.array(list(counts.values())) / w
    lines = [x for x in t.split("\n") if x and not x.isspace()]
    grams = Counter(zip(words, words[1:], words[2:]))
    n_grams = max(1, w - 2)
    chars = small[small > 0] / n
    return [
        np.log1p(n), np.log1p(w), lengths.mean(), (lengths > 12).mean(), (lengths < 3).mean(),
        small[65:91].sum() / n, sum(x.isupper() for x in words) / w,
        sum(x[0].isupper() for x in words) / w, letters / n, digits / n,
        blanks / n, marks / n, symbols / n, counts.get("|", 0) / w,
        sum(x[-1] in ".!?" for x in words) / w, small[33] / n,
        sum(not x[-1].isalnum() and x[-1] not in ".,;:!?" for x in words) / w,
        np.log1p(len(lines)), w / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), len(counts) / w, shares.max(),
        sum(a == b for a, b in zip(words, words[1:])) / w,
        1 - len(grams) / n_grams if w > 2 else 0.0, -(shares * np.log(shares)).sum(),
        -(chars * np.log(chars)).sum(), (codes >= 128).mean(),
        sum(any(c.isdigit() for c in x) for x in words) / w]


@dataclass(frozen=True)
class Trees:
    """Trees as flat arrays. Node i of tree t sends a row right if its
    statistic ``feature`` exceeds ``cut``; leaves point at themselves."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for a in range(0, len(x), 8192):
            part = x[a:a + 8192]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                right = part[rows, self.feature[node]] > self.cut[node]
                node = np.where(right, self.right[node], self.left[node])
            total[a:a + 8192] += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Trees:
    """Fit trees for the logistic loss to rows ``x`` with labels ``y`` (0/1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, v in ((feature, 0), (cut, np.inf), (left, len(left)), (right, len(right)),
                          (value, 0.0)):
            column.append(v)
        return len(feature) - 1

    if len(set(y.tolist())) < 2:
        roots.append(node())
    else:
        n, f = x.shape
        grid = np.linspace(0, 1, s.bins + 1)[1:-1]
        edges = [np.unique(np.quantile(x[:, j], grid)) for j in range(f)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], 1)
        slot = binned + np.arange(f) * s.bins
        valid = np.zeros((f, s.bins), dtype=bool)  # bins with an edge to cut at
        for j in range(f):
            valid[j, :len(edges[j])] = True
        margin = np.full(n, base)
        for _ in range(s.trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            at = np.zeros(n, dtype=np.int64)  # place of each row's node in this level
            level = [node()]
            roots.append(level[0])
            ids = np.array(level)
            for depth in range(s.depth):
                k, size = len(level), f * s.bins
                key = (slot + at[:, None] * size)[at >= 0].ravel()
                live = at >= 0
                hist = [np.bincount(key, np.repeat(v[live], f), k * size).reshape(k, f, s.bins)
                        for v in (grad, hess, np.ones(n))]
                g, h, c = (v.cumsum(axis=2) for v in hist)
                gt, ht, ct = (v[:, :1, -1:] for v in (g, h, c))
                gain = (g ** 2 / (h + s.ridge) + (gt - g) ** 2 / (ht - h + s.ridge)
                        - gt ** 2 / (ht + s.ridge))
                gain[~(valid & (c >= s.least_rows) & (ct - c >= s.least_rows))] = 0
                best = gain.reshape(k, -1).argmax(axis=1)
                good = gain.reshape(k, -1)[np.arange(k), best] > 1e-9
                following, child = [], np.full((k, 2), -1)
                for i in np.flatnonzero(good):
                    j, b = divmod(int(best[i]), s.bins)
                    feature[level[i]], cut[level[i]] = j, edges[j][b]
                    child[i] = len(following), len(following) + 1
                    following += [node(), node()]
                    left[level[i]], right[level[i]] = following[-2:]
                if not following:
                    break
                j, b = best // s.bins, best % s.bins
                where = np.flatnonzero(live)
                own = at[where]
                goes = (binned[where, j[own]] > b[own]).astype(int)
                at[where] = child[own, goes]
                moved = at >= 0
                ids = np.where(moved, np.array(following)[np.maximum(at, 0)],
                               ids if len(ids) == n else np.full(n, level[0]))
                level = following
            ids = ids if len(ids) == n else np.full(n, level[0])
            m = len(feature)
            step = (-s.rate * np.bincount(ids, grad, m) / (np.bincount(ids, hess, m) + s.ridge))
            for i in np.unique(ids):
                value[i] = float(step[i])
            margin = margin + step[ids]
    return Trees(np.array(feature), np.array(cut, dtype=float), np.array(left), np.array(right),
                 np.array(value), np.array(roots), s.depth, base)


def _measured(text: Column | str) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(t), dtype=float) for t in texts], dtype=object)
    return run(text)


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Trees:
    """Grow trees on a sample of at most about ``s.sample`` labelled rows that
    are not held out."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()
                          & ~held_out()).select("doc_id", "quality")
    n = marked.count()
    if n > s.sample:
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
        marked = marked.where(place < s.sample / n)
    # The sample is bounded by the setting, so it may be broadcast.
    rows = (docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
            .select(_measured("text").alias("x"), "quality").toPandas())
    if not len(rows):
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0), s)
    return grow(np.stack(rows["x"]), rows["quality"].to_numpy().astype(float), s)


def score(docs: DataFrame, trees: Trees, s: Settings = Settings()) -> DataFrame:
    spark = python_ready(docs)
    shared = spark.sparkContext.broadcast(trees)  # settings bound its size

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
        return pd.Series(shared.value.score(x))

    return (docs.select("doc_id", held_out().alias("held_out"),
                        run.asNondeterministic()("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= s.threshold).cast("int")))


def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    python_ready(docs)
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
