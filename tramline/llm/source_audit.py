"""Source divergence audit: how the word counts of a language's sources differ,
priced over hash-consed segment trees.

Each language numbers its kept terms from the most to the least frequent. A
source is then an array of counts, held as a segment tree: a leaf has a count,
an inner node its two halves. Nodes are hash-consed, so that equal stretches of
counts, of whatever source, are one node; as rare terms stand together, long
stretches of zeros and ones are shared. Two sources are compared by walking
both trees at once, with a memo: a pair of nodes is priced once however often
it is met, the bottom pairs by the divergence of their two counts.

The numbers are cut into segments of 4096 terms, each the root of a subtree,
and the sources of a language into blocks of about 48. A task has one segment
and two blocks (its rows are bounded), builds their trees and prices all pairs
between them; sums over segments are sums of longs. Counting is combined in
each task, so a source with a third of the documents sends no more rows than
it has terms. Of the divergence from the language itself, each segment gives
its ten best terms, and a window picks from these.

Defined results: null text, lang and source are ``''``; a source without terms
is compared like any other; a language without kept terms has distance 0
between its sources and no terms; repeated rows are documents of their own;
ties go by item; an empty table gives an empty table; other columns are not
looked at. Counts may pass what a double holds: all arithmetic is on integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, python_ready, stored, table, width

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_IN_TERM = re.compile(TERM)
_TO_BLANKS = bytes(c if c > 0x7F or _IN_TERM.match(chr(c)) else 32 for c in range(256))

UNIT = 1_000_000_000
#: Counts from which a product with UNIT may leave 64 bits.
_LARGE = (1 << 63) // UNIT - 2


@dataclass(frozen=True)
class Settings:
    #: Documents of its language that a kept term is in, at least.
    least_docs: int = 10
    #: Terms told for each source.
    top: int = 10
    #: Terms of a segment, as a power of two.
    segment_bits: int = 12
    #: Sources of a block, on average.
    block: int = 48
    #: Distinct terms that a task gathers before it passes their counts on.
    held_terms: int = 500_000
    #: Leaves of the pairs priced at a time.
    leaves: int = 1 << 20


# ---------------------------------------------------------------- counts

def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: only A-Z lower-cased."""
    return text.lower().translate(_TO_BLANKS).split()


def count_terms(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have it.
    Each group has a row of the term ``''`` besides."""
    python_ready(docs)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        fresh = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                pair = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(pair[0])
                terms = terms_of(text)
                pair[0].update(terms)
                pair[1].update(set(terms))
                fresh += len(pair[0]) - before
                if fresh >= settings.held_terms:
                    yield from _rows(held)
                    held, fresh = {}, 0
        yield from _rows(held)

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")])
    counted = named.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        partial, "lang string, source string, term string, n long, docs long")
    # Tasks have combined their own rows: another map-side pass would find little.
    return counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _rows(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        size = len(n) + 1
        terms = pa.array([b"", *n], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(lang, size), pa.repeat(source, size), terms, pa.array([0, *n.values()], pa.int64()),
             pa.array([0, *map(docs.__getitem__, n)], pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def kept_terms(counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, term, n, segment, place): the kept terms of each language, numbered
    from the most frequent down. The numbers of a language lie in few ranges;
    what they are does not matter to any result."""
    kept = stored(counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= settings.least_docs).select("lang", "term", "n"), "audit-kept")
    ranges = max(1, min(width(kept.sparkSession), kept.count() >> (settings.segment_bits + 2)))
    order = ["lang", F.desc("n"), "term"]
    number = F.monotonically_increasing_id()
    numbered = kept.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(
        "number", number)
    return stored(numbered.select(
        "lang", "term", "n", F.shiftright("number", settings.segment_bits).alias("segment"),
        F.col("number").bitwiseAND((1 << settings.segment_bits) - 1).cast("int").alias("place")),
        "audit-terms")


# ---------------------------------------------------------------- trees

class Forest:
    """Hash-consed segment trees over the rows of ``leaves`` (a power of two
    wide): ``roots`` are node numbers, ``levels`` the two children of every node
    from the bottom up, ``values`` the counts of the bottom nodes."""

    def __init__(self, leaves: np.ndarray):
        self.values, nodes = np.unique(leaves, return_inverse=True)
        self.leaves = nodes = nodes.reshape(leaves.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.values)
        while nodes.shape[1] > 1:
            both = nodes[:, ::2] * size + nodes[:, 1::2]
            made, nodes = np.unique(both, return_inverse=True)
            nodes = nodes.reshape(both.shape)
            self.levels.append((made // size, made % size))
            size = len(made)
        self.roots = nodes[:, 0]

    def sizes(self) -> list[int]:
        return [len(self.values), *[len(left) for left, _ in self.levels]]


def share(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """p of the contract: 1 + floor(UNIT * (count + 2) / whole)."""
    if len(counts) and counts.max() >= _LARGE:
        return np.array([1 + UNIT * (c + 2) // w for c, w in zip(counts.tolist(), whole.tolist())],
                        dtype=np.int64)
    return 1 + UNIT * (counts + 2) // whole


class Prices:
    """Sums of f over all places for pairs of trees of a forest.

    ``a`` and ``b`` are tree numbers, ``whole`` what each tree's counts are
    shares of; a place whose count is -1 is no term and costs nothing. A pair
    of nodes is priced once for each pair of wholes: from the roots down the
    distinct pairs of each level are found, then priced from the bottom up."""

    def __init__(self, forest: Forest, a: np.ndarray, b: np.ndarray, whole: np.ndarray):
        self.forest, self.sizes = forest, forest.sizes()
        wholes, which = np.unique(whole, return_inverse=True)
        self.kinds, self.kind = np.unique(which[a] * len(wholes) + which[b], return_inverse=True)
        level = len(self.sizes) - 1
        pairs, seen = self._distinct(level, self.kind, forest.roots[a], forest.roots[b])
        met = [seen]
        for left, right in reversed(forest.levels):
            level -= 1
            kind, x, y = pairs
            pairs, seen = self._distinct(
                level, np.tile(kind, 2), np.append(left[x], right[x]), np.append(left[y], right[y]))
            met.append(seen)
        kind, x, y = pairs
        self.keys = self._key(0, kind, x, y)
        known = (forest.values[x] >= 0) & (forest.values[y] >= 0)
        kinds = self.kinds[kind]
        p = share(forest.values[x], wholes[kinds // len(wholes)])
        q = share(forest.values[y], wholes[kinds % len(wholes)])
        self.price = np.where(known, (p - q) ** 2 // (p + q), 0)
        self.above = known & (p > q)
        self.priced = sum(map(len, met[1:])) // 2 + len(self.keys)
        value = self.price
        for seen in reversed(met[1:]):
            value = value[seen[:len(seen) // 2]] + value[seen[len(seen) // 2:]]
        self.total = value[met[0]]

    def _key(self, level: int, kind, x, y) -> np.ndarray:
        return (kind * self.sizes[level] + x) * self.sizes[level] + y

    def _distinct(self, level: int, kind, x, y):
        keys, seen = np.unique(self._key(level, kind, x, y), return_inverse=True)
        size = self.sizes[level]
        return (keys // (size * size), keys // size % size, keys % size), seen

    def places(self, pair: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """f of each place of a pair, and whether its count in ``a`` is a
        positive one with the higher share."""
        x, y = self.forest.leaves[a], self.forest.leaves[b]
        at = np.searchsorted(self.keys, self._key(0, self.kind[pair], x, y))
        return self.price[at], self.above[at] & (self.forest.values[x] > 0)


# ---------------------------------------------------------------- cells

CELL = ["lang", "segment", "block_a", "block_b"]
CELL_SCHEMA = "lang string, source string, item string, part string, value long"


def price_cell(rows: pd.DataFrame, settings: Settings) -> list[tuple]:
    """(source, item, part, value) of one segment and two blocks of sources.

    ``rows`` have source (null: the language itself), block, place, term and n;
    place -1 has what the source's counts are shares of. Of two different blocks
    each source is paired with those of the other; a block with itself gives
    each pair once, source before item, and the best terms of its sources."""
    lang = rows["lang"].iloc[0]
    heads = rows[rows["place"] < 0]
    own = heads[heads["source"].isna()]
    heads = heads[heads["source"].notna()].sort_values("source")
    sources = heads["source"].tolist()
    number = {s: i for i, s in enumerate(sources)}
    body = rows[rows["place"] >= 0]
    terms = body[body["source"].isna()]
    counts = body[body["source"].notna()]
    leaves = np.full((len(sources) + 1, 1 << settings.segment_bits), -1, dtype=np.int64)
    there = terms["place"].to_numpy()
    leaves[:, there] = 0
    leaves[-1, there] = terms["n"].to_numpy()
    leaves[counts["source"].map(number).to_numpy(dtype=np.int64), counts["place"].to_numpy()] = \
        counts["n"].to_numpy()
    whole = np.append(heads["n"].to_numpy(), own["n"].to_numpy()[:1]).astype(np.int64)
    forest = Forest(leaves)
    block = heads["block"].to_numpy()
    alone = rows["block_a"].iloc[0] == rows["block_b"].iloc[0]
    a, b = np.triu_indices(len(sources), 1)
    if not alone:
        apart = block[a] != block[b]
        a, b = a[apart], b[apart]
    out: list[tuple] = []
    step = max(1, settings.leaves >> settings.segment_bits)
    for i in range(0, len(a), step):
        x, y = a[i:i + step], b[i:i + step]
        totals = Prices(forest, x, y, whole).total
        out += [(lang, sources[m], sources[n], "pair", v)
                for m, n, v in zip(x.tolist(), y.tolist(), totals.tolist())]
    if alone:
        names = dict(zip(there.tolist(), terms["term"]))
        lang_tree = len(sources)
        for i in range(0, len(sources), step):
            x = np.arange(i, min(i + step, len(sources)))
            prices = Prices(forest, x, np.full(len(x), lang_tree), whole)
            for pair, m in enumerate(x.tolist()):
                f, high = prices.places(pair, m, lang_tree)
                at = np.flatnonzero(high)
                if len(at) > settings.top:
                    least = np.partition(f[at], len(at) - settings.top)[len(at) - settings.top]
                    at = at[f[at] >= least]
                best = sorted((-int(f[k]), names[k].encode()) for k in at.tolist())[:settings.top]
                out += [(lang, sources[m], t.decode(), "term", -v) for v, t in best]
    return out


def _cells(counts: DataFrame, kept: DataFrame, groups: DataFrame, langs: DataFrame,
           settings: Settings) -> DataFrame:
    """All rows that segments and pairs of blocks are priced from."""
    few = broadcast_if_small(langs)
    nothing = F.lit(None).cast("string")

    def to_cells(rows: DataFrame) -> DataFrame:
        """Rows of a source, to every pair with its block."""
        block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
        ends = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
        return rows.withColumn("block", block).withColumn("other", ends).select(
            "lang", "segment", F.least("block", "other").alias("block_a"),
            F.greatest("block", "other").alias("block_b"), "source", "block", "place", "term", "n")

    def to_all(rows: DataFrame) -> DataFrame:
        """Rows of a language, to every pair of blocks."""
        last = (F.col("blocks") - 1).cast("int")
        return rows.withColumn("block_a", F.explode(F.sequence(F.lit(0), last))).withColumn(
            "block_b", F.explode(F.sequence(F.col("block_a"), last))).select(
            "lang", "segment", "block_a", "block_b", nothing.alias("source"),
            F.lit(-1).alias("block"), "place", "term", "n")

    segments = kept.select("lang", "segment").distinct()
    places = kept.join(few.select("lang", "blocks"), "lang")
    body = counts.join(few.select("lang", "blocks"), "lang").select(
        "lang", "blocks", "source", "segment", "place", nothing.alias("term"), "n")
    heads = segments.join(broadcast_if_small(groups), "lang").select(
        "lang", "blocks", "source", "segment", F.lit(-1).alias("place"), nothing.alias("term"),
        F.col("whole").alias("n"))
    own = segments.join(few, "lang").select(
        "lang", "blocks", "segment", F.lit(-1).alias("place"), nothing.alias("term"),
        F.col("whole").alias("n"))
    return to_cells(body).unionByName(to_cells(heads)).unionByName(to_all(places)).unionByName(
        to_all(own))


def source_audit(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of ``docs``
    (text, lang, source): part ``pair`` has the distance to each other source of
    the language, part ``term`` the terms that set a source off most."""
    counts = stored(count_terms(docs, settings), "audit-counts")
    kept = kept_terms(counts, settings)
    placed = stored(counts.where("n > 0").select("lang", "source", "term", "n").join(
        kept.select("lang", "term", "segment", "place"), ["lang", "term"]), "audit-placed")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all"))
    every = counts.where("term = ''").select("lang", "source")
    langs = stored(every.groupBy("lang").agg(F.count("*").alias("sources")).join(
        vocabulary, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"),
        (F.coalesce("all", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("whole"),
        F.ceil(F.col("sources") / settings.block).alias("blocks")), "audit-langs")
    sums = placed.groupBy("lang", "source").agg(F.sum("n").alias("known"))
    groups = stored(every.join(sums, ["lang", "source"], "left").join(
        langs.drop("whole"), "lang").select(
        "lang", "source", "v", "blocks",
        (F.coalesce("known", F.lit(0)) + 2 * F.col("v")).alias("whole")), "audit-groups")

    def price(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(price_cell(rows, settings),
                            columns=["lang", "source", "item", "part", "value"])

    cells = _cells(placed, kept, groups.where("v > 0"), langs.where("v > 0"), settings)
    priced = stored(cells.groupBy(*CELL).applyInPandas(price, CELL_SCHEMA), "audit-priced")
    once = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))
    # Languages without kept terms have no segment: their pairs are 0.
    bare = groups.where("v = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").where(
        "source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = once.unionByName(once.select("lang", F.col("item").alias("source"),
                                         F.col("source").alias("item"), "value")).unionByName(zero)
    terms = priced.where("part = 'term'").select("lang", "source", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)

    def told(rows: DataFrame, part: str, keep: Column | None = None) -> DataFrame:
        ranked = rows.withColumn("rank", rank)
        return (ranked if keep is None else ranked.where(keep)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return told(pairs, "pair").unionByName(
        told(terms, "term", F.col("rank") <= settings.top))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH named AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang,
                      coalesce(source, '') AS source,
                      translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text
               FROM documents),
tokens AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM named),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term
         HAVING count(DISTINCT row) >= 10),
groups AS (SELECT DISTINCT lang, source FROM named),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY lang, source, term),
counts AS (SELECT lang, source, term, coalesce(found.n, 0) AS n
           FROM groups JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
shares AS (SELECT lang, source, term, c.n,
                  1 + (1000000000::HUGEINT * (c.n + 2)) // (t.n + 2 * v) AS p
           FROM counts c JOIN totals t USING (lang, source) JOIN langs USING (lang)),
of_lang AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * v) AS q
            FROM kept k JOIN langs l USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item,
                sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term
                                    AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sums.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
          FROM shares JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', item, value FROM terms))
WHERE part = 'pair' OR rank <= 10"""
