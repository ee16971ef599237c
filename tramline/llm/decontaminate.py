"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item is cut into overlapping pieces. An occurrence of a piece of m
bytes with at most k edits shares at least m - q + 1 - k*q of its q-grams with
the text, on diagonals at most k apart. Shared q-grams are counted in
overlapping diagonal bands of 2(k+1) diagonals; regions that reach the bound
are verified by banded alignment (all of a batch's regions at once).

The index holds exact 8-byte grams of the pieces. The benchmark is dealt into
blocks of about ``block_bytes`` of text; a block's items are broadcast and each
Python worker builds their index, so the driver holds one block of text and a
worker one index. Documents are read row by row and never shuffled. A benchmark
of more than one block takes a job for each, which stores its hits (documents
with hits only) before the next begins; they are joined to the documents then.

Texts are compared in lower case with every run of white space as one blank.
Items of fewer than ``least_bytes`` bytes after that are too short for the lemma:
they match whole and without edits, between borders of words (a border is also
beside each character of a script that is written without blanks).

Defined results: a null or empty text has no hits; a null item text, or one
of fewer than ``least_exact`` bytes, matches nothing (an answer of a word or
two is in most texts; 1 takes them all); equal items all report; repeated rows
each get their own row; without documents there is no row, without items no hit;
other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import python_ready, scratch_name, stored, table, with_release

Q = 8  # a gram is one 64-bit word, so equal words are equal grams
HITS = "array<struct<item_id: bigint, first: int, last: int, edits: int>>"


@dataclass(frozen=True)
class Settings:
    piece: int = 96
    stride: int = 48
    #: Edits allowed: one in so many bytes, fewer if the bound below needs it.
    bytes_per_edit: int = 10
    #: Shared grams that an occurrence must guarantee.
    least_shared: int = 8
    least_bytes: int = 24
    #: Shorter items match nothing.
    least_exact: int = Q
    block_bytes: int = 4 << 20
    #: Bytes of documents that are matched together.
    batch_bytes: int = 1 << 20

    def edits(self, m: int) -> int:
        return max(0, min(m // self.bytes_per_edit, (m - Q + 1 - self.least_shared) // Q))


def normalised(text: str) -> np.ndarray:
    """Bytes of the text in lower case, white space runs as one blank."""
    low = text.lower()
    if len(low) != len(text):  # keep one character for each
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return np.frombuffer(low.encode(), dtype=np.uint8)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0, 9, 10, 11, 12, 13, 32]] = True


def _folded(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """White space folded: the bytes, and the place of each in ``raw``."""
    blank = _BLANK[raw]
    keep = ~blank
    keep[:1] = True
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    return np.where(blank[at], np.uint8(32), raw[at]), at


def grams(b: np.ndarray) -> np.ndarray:
    """The word of Q bytes that starts at each place."""
    n = len(b) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    raw = b.tobytes()
    out = np.empty(n, dtype=np.uint64)
    for k in range(Q):
        words = np.frombuffer(raw, dtype="<u8", count=(len(raw) - k) // Q, offset=k)
        out[k::Q] = words[:len(out[k::Q])]
    return out


_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


#: Scripts written without blanks: Thai and Lao, Myanmar, Khmer, then Han and kana.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F),
             (0x31A0, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))


def _in_word(c: str) -> bool:
    """Whether a character (or none) holds together with its neighbours."""
    return (c.isalnum() or unicodedata.category(c or " ")[0] == "M") \
        and not any(a <= ord(c) <= z for a, z in _UNSPACED)


def _border(raw: bytes, i: int) -> bool:
    """Whether no word goes on over the place of a character's first byte."""
    return not (_in_word(raw[max(0, i - 4):i].decode(errors="ignore")[-1:])
                and _in_word(raw[i:i + 4].decode(errors="ignore")[:1]))


class Short:
    """Items too short for pieces, which match whole."""

    def __init__(self, items: dict[bytes, list[int | None]]):
        self.items = items
        #: By size of head (a whole word of Q bytes at most): heads, sizes of items.
        self.heads = {}
        for k in {min(len(t), Q) for t in items}:
            of = [t for t in items if min(len(t), Q) == k]
            heads = {int.from_bytes(t[:k], "little") for t in of}
            self.heads[k] = (np.array(sorted(heads), dtype=np.uint64), {len(t) for t in of})

    def places(self, b: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Each place where an item stands between borders, and the item.
        ``b`` ends with zeros."""
        raw, g = b.tobytes(), grams(b)
        for k, (heads, sizes) in self.heads.items():
            head = g & np.uint64((1 << 8 * k) - 1)
            near = np.minimum(np.searchsorted(heads, head), len(heads) - 1)
            for i in np.flatnonzero(heads[near] == head).tolist():
                for m in sizes:
                    if raw[i:i + m] in self.items and _border(raw, i) and _border(raw, i + m):
                        yield i, raw[i:i + m]


class Index:
    """Grams of a block of items' pieces; items too short for them apart."""

    def __init__(self, items: list[tuple[int | None, str]], s: Settings):
        self.settings = s
        pieces, owner, codes, piece_of, place_of = [], [], [], [], []
        short: dict[bytes, list[int | None]] = {}
        for item, text in items:
            b, _ = _folded(normalised(text))
            b = np.frombuffer(b.tobytes().strip(b" "), dtype=np.uint8)
            if len(b) < s.least_bytes:
                if len(b) >= max(1, s.least_exact):
                    short.setdefault(b.tobytes(), []).append(item)
                continue
            starts = list(range(0, max(1, len(b) - s.piece + 1), s.stride))
            if len(b) > s.piece and starts[-1] != len(b) - s.piece:
                starts.append(len(b) - s.piece)
            for a in starts:
                p = b[a:a + s.piece]
                g = grams(p)
                codes.append(g)
                piece_of.append(np.full(len(g), len(pieces)))
                place_of.append(np.arange(len(g)))
                pieces.append(p)
                owner.append(item)
        self.short = Short(short)
        self.owner = owner
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.edits = np.array([s.edits(len(p)) for p in pieces], dtype=np.int64)
        self.bound = self.size - Q + 1 - self.edits * Q
        self.bytes = np.zeros((len(pieces), s.piece), dtype=np.uint8)
        for i, p in enumerate(pieces):
            self.bytes[i, :len(p)] = p
        if not pieces:
            return
        code = np.concatenate(codes)
        order = np.argsort(code, kind="stable")
        self.piece_of = np.concatenate(piece_of)[order]
        self.place_of = np.concatenate(place_of)[order]
        self.codes, self.from_ = np.unique(code[order], return_index=True)
        self.from_ = np.append(self.from_, len(code))
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[(self.codes * _MIX) >> np.uint64(64 - _BITS)] = True

    def dense_places(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose gram is in the index and whose neighbourhood of a
        piece's length holds enough such places; and their grams' numbers."""
        g = grams(b)
        at = np.flatnonzero(self.seen[(g * _MIX) >> np.uint64(64 - _BITS)])
        word = np.searchsorted(self.codes, g[at])
        word = np.minimum(word, len(self.codes) - 1)
        real = self.codes[word] == g[at]
        at, word = at[real], word[real]
        # An occurrence lies in a window of the longest piece plus its edits.
        reach = int((self.size + self.edits).max())
        need = int(self.bound.min())
        if need > 1 and len(at):
            n = np.arange(len(at))
            ahead = np.searchsorted(at, at + reach, side="left") - n  # places from here on
            starts = ahead >= need  # a window that starts here is full enough
            cover = np.zeros(len(at) + 1, dtype=np.int64)
            np.add.at(cover, n[starts], 1)
            np.add.at(cover, (n + ahead)[starts], -1)
            keep = np.cumsum(cover[:-1]) > 0
            at, word = at[keep], word[keep]
        return at, word

    def regions(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(piece, first diagonal, last diagonal, a place inside) of each band
        that holds as many shared grams as the lemma asks for."""
        at, word = self.dense_places(b)
        n = self.from_[word + 1] - self.from_[word]
        total = int(n.sum())
        where = np.repeat(self.from_[word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) \
            + np.arange(total)
        i, p, j = np.repeat(at, n), self.piece_of[where], self.place_of[where]
        step = self.edits[p] + 1
        diagonal = i - j + self.settings.piece  # never negative
        lower = diagonal // step
        # A diagonal lies in two bands: the one that starts at its step, and the one before.
        key = np.concatenate([lower, lower - 1]) * len(self.size) + np.concatenate([p, p])
        place = np.concatenate([i, i])
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
        count = np.diff(np.append(first, len(key)))
        band, piece = key[first] // len(self.size), key[first] % len(self.size)
        good = count >= self.bound[piece]
        band, piece, place = band[good], piece[good], place[first][good]
        start = band * (self.edits[piece] + 1) - self.settings.piece
        return piece, start, start + 2 * (self.edits[piece] + 1) - 1, place

    def align(self, b: np.ndarray, piece, low, high, begin, end):
        """Least edits of each piece inside its diagonals (all together), and
        where the best alignment ends. Text outside [begin, end) matches nothing."""
        k = self.edits[piece]
        width = int((high - low + 1 + 2 * k).max())
        base = low - k
        cols = np.arange(width)
        dist = np.zeros((len(piece), width), dtype=np.int32)
        result = np.full(len(piece), 1 << 20, dtype=np.int32)
        ends = np.zeros(len(piece), dtype=np.int64)
        for j in range(int(self.size[piece].max())):
            text = base[:, None] + j + cols
            inside = (text >= begin[:, None]) & (text < end[:, None])
            char = np.where(inside, b[np.clip(text, 0, len(b) - 1)], 0)
            change = dist + (char != self.bytes[piece, j][:, None])
            drop = np.append(dist[:, 1:] + 1, np.full((len(piece), 1), 1 << 19, np.int32), axis=1)
            best = np.minimum(change, drop)
            dist = (np.minimum.accumulate(best - cols, axis=1) + cols).astype(np.int32)
            done = self.size[piece] == j + 1
            if done.any():
                result[done] = dist[done].min(axis=1)
                ends[done] = base[done] + j + 1 + dist[done].argmin(axis=1)
        return result, ends


def find(texts: list[str | None], index: Index) -> list[list[tuple]]:
    """Hits of each text: (item_id, first and last character, least edits)."""
    out: list[list[tuple]] = [[] for _ in texts]
    if not len(index.size) and not index.short.items:
        return out
    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < index.settings.batch_bytes):
            raw = normalised(texts[stop] or "")
            parts.append((raw, *_folded(raw)))
            size += len(raw)
            stop += 1
        _match(parts, start, index, out)
        start = stop
    return out


def _match(parts, first_doc: int, index: Index, out: list[list[tuple]]) -> None:
    gap = np.zeros(2 * index.settings.piece, dtype=np.uint8)  # so that bands never span texts
    sizes = np.array([len(b) for _, b, _ in parts])
    begins = len(gap) + np.concatenate([[0], np.cumsum(sizes + len(gap))[:-1]])
    b = np.concatenate([gap, *[x for _, p, _ in parts for x in (p, gap)]])
    if index.short.items:
        _match_short(parts, begins, b, first_doc, index, out)
    if not len(index.size):
        return
    piece, low, high, place = index.regions(b)
    doc = np.searchsorted(begins, place, side="right") - 1
    for a in range(0, len(piece), 4096):
        cut = slice(a, a + 4096)
        d = doc[cut]
        edits, ends = index.align(b, piece[cut], low[cut], high[cut], begins[d],
                                  begins[d] + sizes[d])
        for i in np.flatnonzero(edits <= index.edits[piece[cut]]):
            p, k = piece[cut][i], int(d[i])
            last = int(ends[i] - begins[k])
            raw, _, at = parts[k]
            last = min(last, len(at))
            first = max(0, last - int(index.size[p]))
            chars = np.cumsum((raw[:at[last - 1] + 1] & 0xC0) != 0x80)
            out[first_doc + k].append((index.owner[p], int(chars[at[first]]) - 1,
                                       int(chars[-1]), int(edits[i])))


def _match_short(parts, begins, b: np.ndarray, first_doc: int, index: Index, out) -> None:
    chars, held = None, -1
    for place, text in sorted(index.short.places(b)):
        k = int(np.searchsorted(begins, place, side="right")) - 1
        raw, _, at = parts[k]
        if k != held:
            chars, held = np.cumsum((raw & 0xC0) != 0x80), k
        first = place - int(begins[k])
        for item in index.short.items[text]:
            out[first_doc + k].append((item, int(chars[at[first]]) - 1,
                                       int(chars[at[first + len(text) - 1]]), 0))


def merged(hits: list[tuple]) -> list[tuple]:
    """One hit for each item and run of overlapping places."""
    result: list[tuple] = []
    for item, first, last, edits in sorted(hits, key=lambda h: (h[0] is None, h[0] or 0, *h[1:])):
        if result and result[-1][0] == item and first <= result[-1][2]:
            _, a, z, e = result[-1]
            result[-1] = (item, a, max(z, last), min(e, edits))
        else:
            result.append((item, first, last, edits))
    return result


#: The worker's index: only that of the block it is matching.
_held: dict[str, Index] = {}


Items = list[tuple[int | None, str]]


def _index(key: str, items: Items, s: Settings) -> Index:
    if key not in _held:
        _held.clear()
        _held[key] = Index(items, s)
    return _held[key]


def blocks(benchmark: DataFrame, s: Settings) -> tuple[int, Iterator[Items]]:
    """How many blocks of about ``block_bytes`` the benchmark's items make, and
    the blocks, each collected when its turn comes."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-total // s.block_bytes))
    if n > 1:
        rows = stored(rows.repartition(n).withColumn("block", F.spark_partition_id()),
                      "benchmark-blocks")

    def each() -> Iterator[Items]:
        for k in range(n):
            block = rows.where(F.col("block") == k) if n > 1 else rows
            yield [(r["item_id"], r["text"]) for r in block.collect()]
    return n, each()


def matcher(text: Column | str, items: Items, spark: SparkSession, s: Settings) -> Column:
    """Array column of a text column's hits of a block's items."""
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "first", "last", "edits")
        return with_release(
            pd.Series([[dict(zip(names, h)) for h in merged(found)]
                       for found in find(list(texts), _index(key, shared.value, s))], dtype=object)
            for texts in batches)
    return run.asNondeterministic()(text)


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str,
              s: Settings = Settings()) -> DataFrame:
    """``docs`` with an array column ``name`` of the benchmark hits of ``text``."""
    spark = python_ready(docs)
    n, each = blocks(benchmark, s)
    if n == 1:
        return docs.withColumn(name, matcher("text", next(each), spark, s))
    key, key_hash = scratch_name(docs, "hit_doc"), scratch_name(docs, "hit_hash")
    ids = docs.select(F.col("doc_id").alias(key), F.xxhash64("text").alias(key_hash), "text")
    # Rows equal in doc_id and text have the same hits: once is enough.
    found = [stored(ids.withColumn("hits", matcher("text", items, spark, s))
                    .where(F.size("hits") > 0).select(key, key_hash, "hits")
                    .dropDuplicates([key, key_hash]), "benchmark-hits") for items in each]
    hits = stored(reduce(DataFrame.unionAll, found).groupBy(key, key_hash).agg(
        F.array_sort(F.flatten(F.collect_list("hits"))).alias(name)), "benchmark-all-hits")
    joined = docs.join(hits, docs["doc_id"].eqNullSafe(hits[key])
                       & (F.xxhash64(docs["text"]) == hits[key_hash]), "left")
    return joined.select(*[docs[c] for c in docs.columns], F.coalesce(
        hits[name], F.array().cast(HITS)).alias(name))


def decontaminate(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: whether it holds a benchmark passage, the
    items, and each hit with its place in the text."""
    return (with_hits(docs.select("doc_id", "text"), benchmark, "hits", s)
            .select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                    F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
                    .alias("items"), "hits"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` without a benchmark hit; all
    columns as they were."""
    name = scratch_name(docs, "benchmark_hits")
    found = with_hits(docs, table(spark, sf_dir, "benchmark"), name)
    return found.where(F.size(name) == 0).drop(name)


def leaks(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per hit: doc_id, item_id, first and last character, edits.
    Documents without a hit have no row."""
    found = decontaminate(docs, benchmark, s)
    return found.select("doc_id", F.explode_outer("hits").alias("hit")).where(
        F.col("hit").isNotNull()).select("doc_id", "hit.*")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
