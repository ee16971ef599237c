"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

**Index.** Documents are read once, where they lie: a task gathers its rows into
shards of a bounded number of text bytes and writes, for each shard and term, a
list of postings in blocks of 128. A block is packed in as few bytes as its
documents and counts need, and beside it stand the pairs (count, document
length) of which no other has a count as high in a document as short. Such
pairs bound what the block can add to a score whatever the collection's
statistics are, so the statistics are sums over the lists, not a second pass
over texts. A first row of the shard (term ``""``) has its documents.

**Search.** Each shard answers each item on its own. Lists are read from the
highest bound down (weight times the best pair of the list) until the bounds of
those left cannot lift a new document to the present k-th score: the lists read
are the essential ones. The rest only add to documents seen. For these, block
maxima of all remaining lists are summed first, and a document that cannot
reach the k-th score is rejected before a block is unpacked; blocks without a
candidate never are. Nothing that could tie with the k-th score is rejected, so
results are exact. The heaps of the shards, k rows each, are merged.

A shard is one group of rows of bounded size, items are dealt into blocks of 4
MB of text which are searched one after another, and a merge reads k rows from
each shard: no task holds what grows with the collection.

Defined results: a null text, or one without a term, is no document; a document
is a row, so repeated rows are ranked each; rows of one item id are one item
with the terms of all; an item without a known term has no rows; equal scores
go by ascending doc_id, nulls first, then stand in any order; empty tables give
an empty table; other columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, python_ready, scratch_name, stored, table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_IN_TERM = re.compile(TERM)
_TO_BLANKS = bytes(c if c > 0x7F or _IN_TERM.match(chr(c)) else 32 for c in range(256))

INDEX_SCHEMA = ("shard long, term string, n int, tokens long, base array<int>, last array<int>, "
                "pair_tf array<long>, pair_size array<long>, pair_end array<int>, postings binary, "
                "ids array<long>, no_id array<int>, sizes array<long>")
_COLUMNS = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Postings of a block.
    block: int = 128
    #: Bytes of text of a shard, at most (a longer text is a shard of its own).
    shard_bytes: int = 32 << 20
    #: Bytes of items that are searched at a time.
    items_bytes: int = 4 << 20
    #: Terms of all items up to which the index holds lists for these only.
    most_terms: int = 200_000


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text: UTF-8 bytes, only A-Z lower-cased."""
    return (text or "").encode().lower().translate(_TO_BLANKS).split()


def term_column(text: Column | str) -> Column:
    """Array of a text's terms, as ``terms_of`` has them; null for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.translate(col, UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1))


# ---------------------------------------------------------------- index

def _width(value: int) -> int:
    return 1 if value < 1 << 8 else 2 if value < 1 << 16 else 4 if value < 1 << 32 else 8


def _pack(values: np.ndarray, top: int) -> bytes:
    return values.astype(f"<u{_width(top)}").tobytes()


def _list_row(shard: int, term: str, docs: np.ndarray, tfs: np.ndarray, sizes: np.ndarray,
              block: int) -> tuple:
    """An index row of one term's postings (documents ascending)."""
    base, last, pair_tf, pair_size, pair_end, data = [], [], [], [], [], []
    for a in range(0, len(docs), block):
        d, t = docs[a:a + block], tfs[a:a + block]
        base.append(int(d[0]))
        last.append(int(d[-1]))
        order = np.lexsort((sizes[d], -t))
        low = np.minimum.accumulate(sizes[d][order])
        best = np.append(True, low[1:] < low[:-1])  # shorter than all with a count as high
        pair_tf += t[order][best].tolist()
        pair_size += low[best].tolist()
        pair_end.append(len(pair_tf))
        data += [_pack(d - d[0], int(d[-1] - d[0])), _pack(t, int(t.max()))]
    return (shard, term, len(docs), 0, base, last, pair_tf, pair_size, pair_end, b"".join(data),
            None, None, None)


class _Shard:
    """Postings gathered in a task until the shard is full."""

    def __init__(self, number: int, vocabulary: frozenset | None, settings: Settings):
        self.number, self.vocabulary, self.settings = number, vocabulary, settings
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.bytes = 0
        self.lists: dict[bytes, tuple[array, array]] = {}

    def add(self, doc_id: int | None, text: str | None) -> None:
        terms = terms_of(text)
        if not terms:
            return
        counts = Counter(terms)
        place = len(self.ids)
        wanted = counts if self.vocabulary is None else counts.keys() & self.vocabulary
        for term in wanted:
            pair = self.lists.get(term)
            if pair is None:
                pair = self.lists[term] = (array("q"), array("q"))
            pair[0].append(place)
            pair[1].append(counts[term])
        self.ids.append(doc_id)
        self.sizes.append(len(terms))
        self.bytes += len(text)

    def rows(self) -> Iterator[pd.DataFrame]:
        if not self.ids:
            return
        # Arrays with nulls would reach pandas as doubles: places without an id stand apart.
        no_id = [i for i, x in enumerate(self.ids) if x is None]
        yield pd.DataFrame([(self.number, "", len(self.ids), sum(self.sizes), *[None] * 6,
                             [x or 0 for x in self.ids], no_id, self.sizes)], columns=_COLUMNS)
        sizes = np.array(self.sizes, dtype=np.int64)
        batch = []
        for term, (docs, tfs) in self.lists.items():
            batch.append(_list_row(self.number, term.decode(), np.frombuffer(docs, np.int64),
                                   np.frombuffer(tfs, np.int64), sizes, self.settings.block))
            if len(batch) == 1000:
                yield pd.DataFrame(batch, columns=_COLUMNS)
                batch = []
        if batch:
            yield pd.DataFrame(batch, columns=_COLUMNS)


def build_index(docs: DataFrame, terms: DataFrame | None = None,
                settings: Settings = Settings()) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder and
    read back. With ``terms`` (a column ``term``, distinct) lists are kept for
    these only, if they are few enough to be sent to every worker."""
    spark = python_ready(docs)
    vocabulary = None
    if terms is not None:
        few = terms.select("term").limit(settings.most_terms + 1).collect()
        if len(few) <= settings.most_terms:
            vocabulary = frozenset(r.term.encode() for r in few)
    held = spark.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        shard = _Shard(number, held.value, settings)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if shard.bytes and shard.bytes + len(text or "") > settings.shard_bytes:
                    yield from shard.rows()
                    number += 1
                    shard = _Shard(number, held.value, settings)
                shard.add(None if doc_id is None else int(doc_id), text)
        yield from shard.rows()

    # Ids as text: pandas would make numbers with nulls doubles.
    texts = docs.select(F.col("doc_id").cast("string"), "text")
    return stored(texts.mapInPandas(rows, INDEX_SCHEMA), "ranked-index")


# ---------------------------------------------------------------- search in a shard

def length_part(sizes: np.ndarray, n_docs: int, tokens: int) -> np.ndarray:
    """m of the contract for documents of ``sizes`` terms."""
    return 10 + (90 * sizes * n_docs) // max(tokens, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class PostingList:
    """One list of a shard; blocks are unpacked when they are asked for."""

    def __init__(self, row, m: np.ndarray, n_docs: int, tokens: int, block: int):
        self.m, self.block, self.data = m, block, row.postings
        self.base, self.last = np.asarray(row.base), np.asarray(row.last)
        pair_tf = np.asarray(row.pair_tf, dtype=np.int64)
        end = np.asarray(row.pair_end)
        first = np.append(0, end[:-1])
        best = impact(pair_tf, length_part(np.asarray(row.pair_size, np.int64), n_docs, tokens))
        self.best = np.maximum.reduceat(best, first)
        self.most = int(self.best.max())
        # A block's first pair has its highest count.
        self.doc_width = np.array([_width(x) for x in (self.last - self.base).tolist()])
        self.tf_width = np.array([_width(x) for x in pair_tf[first].tolist()])
        self.count = np.full(len(end), block)
        self.count[-1] = row.n - block * (len(end) - 1)
        self.offset = np.append(0, np.cumsum(self.count * (self.doc_width + self.tf_width)))
        # Until it is unpacked, a block's documents stand as its last one: sorted all the same.
        self.docs = np.repeat(self.last.astype(np.int64), self.count)
        self.impacts = np.zeros(len(self.docs), dtype=np.int64)
        self.ready = np.zeros(len(end), dtype=bool)

    def unpack(self, blocks: np.ndarray) -> None:
        for b in blocks[~self.ready[blocks]].tolist():
            n, a, dw = int(self.count[b]), int(self.offset[b]), int(self.doc_width[b])
            docs = np.frombuffer(self.data, f"<u{dw}", n, a).astype(np.int64) + self.base[b]
            tfs = np.frombuffer(self.data, f"<u{self.tf_width[b]}", n, a + n * dw).astype(np.int64)
            at = slice(b * self.block, b * self.block + n)
            self.docs[at], self.impacts[at] = docs, impact(tfs, self.m[docs])
        self.ready[blocks] = True

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block each of some documents would be in, and its best impact."""
        blocks = np.searchsorted(self.last, docs)
        inside = blocks < len(self.last)
        blocks = np.minimum(blocks, len(self.last) - 1)
        return blocks, np.where(inside & (self.base[blocks] <= docs), self.best[blocks], 0)

    def impacts_of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Impacts of documents whose ``blocks`` are unpacked; 0 if not in the list."""
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where((self.docs[at] == docs) & self.ready[blocks], self.impacts[at], 0)


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th highest score, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def top_places(query: list[tuple[int, PostingList]], n_docs: int, k: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """(documents of the shard, scores) of all that score at least as high as
    the k-th, by Block-Max MaxScore; ``query`` has weights and lists."""
    query = sorted(((w, x) for w, x in query if w > 0), key=lambda q: -q[0] * q[1].most)
    rest = [0]
    for weight, postings in reversed(query):
        rest.append(rest[-1] + weight * postings.most)
    rest.reverse()  # rest[i]: what lists from i on can add
    score = np.zeros(n_docs, dtype=np.int64)
    kth, i = 0, 0
    while i < len(query) and not rest[i] < kth:
        weight, postings = query[i]
        postings.unpack(np.arange(len(postings.last)))
        score[postings.docs] += weight * postings.impacts
        i += 1
        if rest[i] < score.max():
            kth = _kth(score, k)
    found = np.flatnonzero(score)
    found = found[score[found] + rest[i] >= kth]
    left = query[i:]
    if left and len(found):
        blocks, bounds = zip(*[postings.bounds(found) for _, postings in left])
        blocks = np.array(blocks)
        bounds = np.array(bounds) * np.array([[w] for w, _ in left])
        later = bounds.sum(axis=0)
        for j, (weight, postings) in enumerate(left):
            keep = score[found] + later >= kth
            found, later, blocks, bounds = found[keep], later[keep], blocks[:, keep], bounds[:, keep]
            hit = bounds[j] > 0
            postings.unpack(np.unique(blocks[j][hit]))
            score[found[hit]] += weight * postings.impacts_of(found[hit], blocks[j][hit])
            later = later - bounds[j]
            kth = max(kth, _kth(score[found], k))
    kth = max(_kth(score[found], k), 1)
    found = found[score[found] >= kth]
    return found, score[found]


def best_of(found: np.ndarray, scores: np.ndarray, ids: list, k: int) -> list[tuple]:
    """The k best as (doc_id, score): highest score, then null, then least id."""
    rows = [(ids[d], int(s)) for d, s in zip(found.tolist(), scores.tolist())]
    return sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0] or 0))[:k]


# ---------------------------------------------------------------- search

def _blocks_of(items: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """(item_id, term, block), distinct, and the number of blocks."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // settings.items_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int").alias("block")
    pairs = items.select("item_id", F.explode(term_column("text")).alias("term")).distinct()
    return pairs.select("item_id", "term", block), n


def search(index: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The ``settings.k`` best documents of ``index`` for each of ``items``
    (item_id, text): item_id, rank, doc_id, score."""
    spark = index.sparkSession
    return _search(index, *_stored_blocks(items, settings), settings, spark)


def _stored_blocks(items: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    pairs, n = _blocks_of(items, settings)
    return stored(pairs, "ranked-items"), n


def _search(index: DataFrame, pairs: DataFrame, n_blocks: int, settings: Settings,
            spark: SparkSession) -> DataFrame:
    size = index.where("term = ''").agg(F.sum("n"), F.sum("tokens")).first()
    n_docs, tokens = int(size[0] or 0), int(size[1] or 0)
    id_type = dict(pairs.dtypes)["item_id"]
    seen = index.where("term <> ''").join(
        broadcast_if_small(pairs.select("term").distinct()), "term", "left_semi").groupBy(
        "term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1)))
    weighted = stored(pairs.join(seen, "term").select(
        "block", "item_id", "term", weight.cast("long").alias("weight")), "ranked-weights")
    heaps = [_heaps(index, weighted.where(F.col("block") == b), id_type, n_docs, tokens, settings)
             for b in range(n_blocks)]
    return merged(reduce(DataFrame.union, heaps), settings.k)


def _heaps(index: DataFrame, weighted: DataFrame, id_type: str, n_docs: int, tokens: int,
           settings: Settings) -> DataFrame:
    """(item_id, shard, doc_id, score) of one block of items: k rows at most for
    each item and shard. Stored, so that one block is at work at a time."""
    spark = index.sparkSession
    queries: dict = {}
    for row in weighted.collect():  # bounded: one block of items
        queries.setdefault(row.item_id, []).append((row.term, row.weight))
    held = spark.sparkContext.broadcast(queries)
    terms = weighted.select("term").distinct()
    wanted = index.join(broadcast_if_small(terms.union(spark.createDataFrame([("",)], "term string"))),
                        "term", "left_semi")

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["term"] == ""].iloc[0]
        ids = head.ids.tolist()
        for place in head.no_id:
            ids[place] = None
        m = length_part(np.asarray(head.sizes, np.int64), n_docs, tokens)
        lists = {row.term: PostingList(row, m, n_docs, tokens, settings.block)
                 for row in rows.itertuples() if row.term}
        out = []
        for item, terms in held.value.items():
            query = [(w, lists[t]) for t, w in terms if t in lists]
            if query:
                found = top_places(query, len(ids), settings.k)
                out += [(item, head.shard, *hit) for hit in best_of(*found, ids, settings.k)]
        return pd.DataFrame(out, columns=["item_id", "shard", "doc_id", "score"], dtype=object)

    # Null ids must stay integers on their way to Arrow, hence the dtype.
    heaps = wanted.groupBy("shard").applyInPandas(
        answer, f"item_id {id_type}, shard long, doc_id long, score long")
    return stored(heaps, "ranked-heaps")


def merged(heaps: DataFrame, k: int) -> DataFrame:
    """The k best of each item over all shards. Rows are cut to k on the map
    side and for 64 parts of the shards before an item's rows meet."""
    rank, part = scratch_name(heaps, "rank"), F.pmod(F.xxhash64("shard"), F.lit(64))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for keys in ([F.col("item_id"), part], [F.col("item_id")]):
        heaps = heaps.withColumn(rank, F.row_number().over(
            Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)
    return heaps.select("item_id", F.col(rank).cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``search`` of an index built for the terms of ``items``."""
    pairs, n = _stored_blocks(items, settings)
    index = build_index(docs, pairs.select("term").distinct(), settings)
    return _search(index, pairs, n, settings, docs.sparkSession)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = ("regexp_extract_all(translate(text, '" + UPPER + "', '" + LOWER + "'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP11_SQL = f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest({_TERMS_SQL}) AS term FROM documents)
            GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM sizes),
weights AS (SELECT term, CAST(floor(1000::DOUBLE * ln(CAST(2 * docs + 2 AS DOUBLE)
                                                     / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
lengths AS (SELECT doc_id, 10 + ((90 * n * docs) // tokens) AS m FROM sizes, total),
asked AS (SELECT DISTINCT item_id, term
          FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark)),
scores AS (SELECT item_id, doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id)
           GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10"""
