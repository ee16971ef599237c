"""Suffix-array dedup: remove every byte of a string of ``length`` bytes that
also starts anywhere else, in the same document or another.

A string of that length is assigned to its anchor: the leftmost of its
``gram``-byte grams with the smallest hash. Equal strings have equal anchors
at the same distance, so they meet by the anchor's hash. Neighbouring starts
with one anchor form a run; runs equal in every byte are one class.

* A class with two occurrences is repeated: a grouped count shows it.
* Different classes of one anchor may overlap in part. One occurrence of each
  goes, with its bytes, to a cell, which builds an enhanced suffix array
  (order and common prefixes, by doubling ranks), scans the tree of
  common-prefix intervals with a stack, and outputs each interval that at
  least two different bytes precede: the maximal repeats, each with all its
  occurrences. Starts they cover are repeated.
* An anchor with more than ``cell`` classes (a passage in many surroundings)
  is not sent whole to one task: its runs are cut into blocks of starts, which
  meet by all the bytes the block's strings share, longer than the gram. Cuts
  of 64, 8 and 1 starts follow each other; with 1, a block is the string
  itself, and counting decides. So every case ends exactly.

Texts are bytes in UTF-8. Positions are judged on the input. Hashes have 64
bits; equal hashes are taken for equal strings outside of cells.

Defined results: a null text is empty; a text shorter than ``length`` keeps all
its bytes; equal rows are different documents, each repeating the other; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, python_ready, stored, table, width, with_release
from tramline.llm.shingles import _BASE, _tables, mix, release


@dataclass(frozen=True)
class Settings:
    length: int = 400
    gram: int = 200
    #: Classes of one anchor that one cell takes.
    cell: int = 64
    #: Starts in a block, for anchors with more classes than that.
    blocks: tuple[int, ...] = (64, 8, 1)
    #: Bytes of texts that are hashed together; a batch takes some 150 times as
    #: much memory. A longer text is one batch.
    batch_bytes: int = 256 << 10

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


#: Ids pass through pandas as text: long columns with nulls would turn to floats.
RUN = "doc_id string, text_hash long, start int, starts int"
ANCHORS = f"{RUN}, key long, class long, distance int, count long"
BODIES = f"{RUN}, key long, class long, distance int, witness boolean, body binary"


class Hashes:
    """Hashes of any stretches of a buffer."""

    def __init__(self, b: np.ndarray):
        up, self.down = _tables(len(b) + 1)
        self.total = np.concatenate([[np.uint64(0)],
                                     np.cumsum((b + np.uint64(1)) * up[:len(b)])])

    def of(self, start: np.ndarray, end: np.ndarray, salt=np.uint64(0)) -> np.ndarray:
        return mix(((self.total[end] - self.total[start]) * self.down[start])
                   + (end - start).astype(np.uint64) * _BASE + salt)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of x[i : i + w] for each i that has so many."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(np.uint64).max, dtype=np.uint64)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(ahead[:n], behind[w - 1:w - 1 + n])


def runs_of(parts: list[bytes], s: Settings) -> dict[str, np.ndarray]:
    """Runs of starts with one anchor, of a batch of texts: text number, start
    in the text, number of starts, distance from start to anchor, the anchor's
    hash (key) and the hash of the run's bytes (class)."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    b = np.frombuffer(b"".join(parts), dtype=np.uint8)
    n_starts = np.maximum(sizes - s.length + 1, 0)
    empty = {c: np.zeros(0, dtype=np.int64) for c in ("text", "start", "starts", "distance")}
    if not n_starts.sum():
        return empty | {c: np.zeros(0, dtype=np.uint64) for c in ("key", "class")}
    hashes = Hashes(b)
    at = np.arange(len(b) - s.gram + 1)
    h = hashes.of(at, at + s.gram)
    bits = np.uint64(max(1, int(len(b)).bit_length()))
    ranked = (h >> bits << bits) | at.astype(np.uint64)  # the place breaks ties, leftmost first
    owner = (_sliding_min(ranked, s.window) & ((np.uint64(1) << bits) - np.uint64(1))
             ).astype(np.int64)
    text = np.repeat(np.arange(len(parts)), n_starts)
    i = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts) \
        + begins[text]
    owner = owner[i]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])))
    starts = np.diff(np.append(first, len(i)))
    text, i, owner = text[first], i[first], owner[first]
    distance = owner - i
    body = hashes.of(i, i + starts + s.length - 1, (distance << 32 | starts).astype(np.uint64))
    return {"text": text, "start": i - begins[text], "starts": starts, "distance": distance,
            "key": h[owner], "class": body}


def _batches(texts: list[str | None], s: Settings) -> Iterator[tuple[int, list[bytes]]]:
    start = 0
    while start < len(texts):
        parts, size, stop = [], 0, start
        while stop < len(texts) and (stop == start or size < s.batch_bytes):
            parts.append((texts[stop] or "").encode())
            size += len(parts[-1])
            stop += 1
        yield start, parts
        start = stop


def _merged(text: np.ndarray, start: np.ndarray, starts: np.ndarray):
    """Runs (in order of text and start) with neighbours joined."""
    if not len(text):
        return text, start, starts
    new = np.append(True, (text[1:] != text[:-1]) | (start[1:] != (start + starts)[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], start[last] + starts[last] - start[first]


def anchors(docs: DataFrame, s: Settings) -> DataFrame:
    """Runs of all documents, those equal within a document once (with their
    count). Rows without key are runs already known to be repeated."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy(dtype=object)
            marks = batch["text_hash"].to_numpy()
            for at, parts in _batches(list(batch["text"]), s):
                r = runs_of(parts, s)
                same = np.lexsort((r["start"], r["class"], r["key"], r["text"]))
                t, k, c = (r[x][same] for x in ("text", "key", "class"))
                new = np.append(True, (t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (c[1:] != c[:-1]))
                first = np.flatnonzero(new[:len(t)])
                count = np.diff(np.append(first, len(t)))
                one = same[first]
                again = np.sort(same[np.repeat(count, count) > 1])
                bt, bs, bn = _merged(r["text"][again], r["start"][again], r["starts"][again])
                nothing = pd.array([pd.NA] * len(bt), dtype="Int64")
                frames = [pd.DataFrame({
                    "doc_id": ids[at + r["text"][one]], "text_hash": marks[at + r["text"][one]],
                    "start": r["start"][one], "starts": r["starts"][one],
                    "key": pd.array(r["key"][one].view(np.int64), dtype="Int64"),
                    "class": pd.array(r["class"][one].view(np.int64), dtype="Int64"),
                    "distance": pd.array(r["distance"][one], dtype="Int64"),
                    "count": pd.array(count, dtype="Int64")}), pd.DataFrame({
                        "doc_id": ids[at + bt], "text_hash": marks[at + bt], "start": bs,
                        "starts": bn, "key": nothing, "class": nothing, "distance": nothing,
                        "count": nothing})]
                yield from frames

    return stored(docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                              F.xxhash64("text").alias("text_hash"), "text")
                  .mapInPandas(lambda batches: with_release(run(batches), release), ANCHORS),
                  "repeat-anchors")


def bodies(docs: DataFrame, picked: DataFrame, s: Settings) -> DataFrame:
    """The bytes of picked runs."""
    lists = stored(picked.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "starts", "distance", "key", "class", "witness"))
        .alias("runs")), "repeat-picked")
    rows = with_runs(docs, lists, "inner").select(
        F.col("id_text").alias("doc_id"), "text_hash", "text", "runs")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, mark, text, runs in zip(batch["doc_id"], batch["text_hash"], batch["text"],
                                             batch["runs"]):
                raw = (text or "").encode()
                for r in runs:
                    a = r["start"]
                    out.append((doc, mark, a, r["starts"], r["key"], r["class"], r["distance"],
                                r["witness"], raw[a:a + r["starts"] + s.length - 1]))
            yield pd.DataFrame(out, columns=_BODY_NAMES)

    return stored(rows.mapInPandas(lambda batches: with_release(run(batches)), BODIES),
                  "repeat-bodies")


def with_runs(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """doc_id (as it was, and as text), text_hash and text of ``docs``, joined
    with the lists of runs of documents (stored: doc_id, text_hash, runs); these
    are broadcast if a count of documents and runs shows them small."""
    size = lists.agg(F.count("*").alias("n"), F.sum(F.size("runs")).alias("runs")).first()
    lists = lists.select(F.col("doc_id").alias("r_doc"), F.col("text_hash").alias("r_hash"), "runs")
    if size["n"] <= 200_000 and (size["runs"] or 0) <= 2_000_000:
        lists = F.broadcast(lists)
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("id_text"), "text",
                       F.xxhash64("text").alias("text_hash"))
    return rows.join(lists, F.col("id_text").eqNullSafe(F.col("r_doc"))
                     & (F.col("text_hash") == F.col("r_hash")), how).select(
                         "doc_id", "id_text", "text_hash", "text", "runs")


_BODY_NAMES = [c.split()[0] for c in BODIES.split(", ")]


def _doubled(rank: np.ndarray, step: int) -> np.ndarray:
    """Ranks of strings twice as long, from ranks of strings of ``step``."""
    later = np.zeros(len(rank), dtype=np.uint64)
    later[:max(0, len(rank) - step)] = rank[step:] + np.uint64(1)
    pair = (rank << np.uint64(32)) | later
    return np.unique(pair, return_inverse=True)[1].astype(np.uint64)


def suffix_ranks(b: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of the string of that length at each place) for lengths
    8, 16, ... until one is at least ``least``; past the end counts as zeros."""
    padded = np.concatenate([b, np.zeros(8, dtype=np.uint8)])
    word = np.zeros(len(b), dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + len(b)]
    ranks = [(8, np.unique(word, return_inverse=True)[1].astype(np.uint64))]
    while ranks[-1][0] < least:
        step, rank = ranks[-1]
        ranks.append((2 * step, _doubled(rank, step)))
    return ranks


def _common(ranks, b: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the strings at x and at y, at most ``most``."""
    total = np.zeros(len(x), dtype=np.int64)
    last = len(b) - 1
    live = np.ones(len(x), dtype=bool)
    for size, rank in reversed(ranks):
        i, j = x + total, y + total
        same = live & (i <= last) & (j <= last)
        same &= rank[np.minimum(i, last)] == rank[np.minimum(j, last)]
        total += np.where(same, size, 0)
    for _ in range(8):
        i, j = x + total, y + total
        live &= (i <= last) & (j <= last) & (b[np.minimum(i, last)] == b[np.minimum(j, last)])
        total += live
    return np.minimum(total, most)


def maximal_repeats(bodies_: list[bytes], starts: np.ndarray, least: int):
    """Maximal repeats of at least ``least`` bytes among the starts of some
    bodies: (length, occurrences), an occurrence being a body's number and an
    offset. Only the first ``starts`` offsets of a body are starts."""
    sizes = np.array([len(x) for x in bodies_], dtype=np.int64)
    # No UTF-8 text holds the byte that ends a body, so it equals no byte of one.
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    b = np.frombuffer(b"\xff".join(bodies_) + b"\xff", dtype=np.uint8)
    owner = np.repeat(np.arange(len(sizes)), starts)
    offset = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    place = begins[owner] + offset
    ranks = suffix_ranks(b, int(sizes.max()))
    order = np.argsort(ranks[-1][1][place], kind="stable")
    owner, offset, place = owner[order], offset[order], place[order]
    room = sizes[owner] - offset
    lcp = _common(ranks, b, place[:-1], place[1:], np.minimum(room[:-1], room[1:]))
    # Byte before each start; a start without one counts as preceded by its own kind.
    before = np.where(offset > 0, b[place - 1].astype(np.int64), -1 - np.arange(len(place)))
    joined = np.append(lcp >= least, False)
    left = np.flatnonzero(joined & ~np.append(False, joined[:-1]))
    right = np.flatnonzero(~joined & np.append(False, joined[:-1]))
    found = []
    if len(left):
        # Left-diverse at the root or nowhere below it.
        ends = np.stack([left, right + 1], 1).ravel()
        padded = np.append(before, 0)
        low = np.minimum.reduceat(padded, ends)[::2]
        high = np.maximum.reduceat(padded, ends)[::2]
        for a, z in zip(left[low != high].tolist(), right[low != high].tolist()):
            for length, i, j in _intervals(lcp, a, z, least):
                kinds = before[i:j + 1]
                if (kinds != kinds[0]).any():
                    found.append((length, owner[i:j + 1], offset[i:j + 1]))
    return found


def _intervals(lcp: np.ndarray, a: int, z: int, least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last place) inside [a, z]: a
    stack holds the open intervals, each nested in the one below it."""
    stack: list[tuple[int, int]] = []  # (length, first place)
    for i, value in enumerate([*lcp[a:z].tolist(), least - 1]):
        first = a + i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, a + i
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def _cell(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """Repeated runs of the rows of some anchors that are no witnesses."""
    starts = rows["starts"].to_numpy(dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(starts)[:-1]])
    cover = np.zeros(int(starts.sum()) + 1, dtype=np.int64)
    for length, owner, offset in maximal_repeats(list(rows["body"]), starts, s.length):
        np.add.at(cover, begin[owner] + offset, 1)
        np.add.at(cover, begin[owner] + np.minimum(offset + length - s.length + 1, starts[owner]),
                  -1)
    hit = np.cumsum(cover[:-1]) > 0
    owner = np.repeat(np.arange(len(starts)), starts)
    at = np.flatnonzero(hit & ~rows["witness"].to_numpy(dtype=bool)[owner])
    o, f, n = _merged(owner[at], at - begin[owner[at]], np.ones(len(at), dtype=np.int64))
    return pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(dtype=object)[o],
                         "text_hash": rows["text_hash"].to_numpy()[o],
                         "start": rows["start"].to_numpy()[o] + f, "starts": n})


def cut(rows: DataFrame, block: int, s: Settings) -> DataFrame:
    """Runs cut into blocks of starts at equal distances from the anchor, keyed
    by all bytes that the strings of a whole block share."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, mark, start, starts, key, _, distance, witness, body in zip(
                    *(batch[c] for c in _BODY_NAMES)):
                # Start number o of the run lies distance - o before the anchor.
                at = 0
                while at < starts:
                    far = distance - at
                    near = far // block * block  # the block's last distance
                    n = min(starts - at, far - near + 1)
                    # Common to the block: from its nearest start to the end of its farthest.
                    core_from = distance - near
                    core_to = distance - (near + block - 1) + s.length
                    part = body[at:at + n + s.length - 1]
                    if block == 1:
                        core = part
                    else:
                        core = body[max(0, core_from):max(0, core_to)]
                    tag = f"{key} {near} {block}".encode()
                    out.append((doc, mark, start + at, n, _digest(tag, core),
                                _digest(f"{far} {n}".encode(), part), far, witness, part))
                    at += n
            yield pd.DataFrame(out, columns=_BODY_NAMES)

    return rows.mapInPandas(run, BODIES)


def _digest(tag: bytes, data: bytes) -> int:
    d = hashlib.blake2b(data, digest_size=8, key=hashlib.md5(tag).digest()).digest()
    return int.from_bytes(d, "little", signed=True)


def repeated_runs(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Runs of starts (doc_id, text_hash, start, starts) whose strings occur
    more than once."""
    spark = python_ready(docs)
    names = ["doc_id", "text_hash", "start", "starts"]
    rows = anchors(docs, s)
    keyed = rows.where("key IS NOT NULL")
    again = stored(keyed.groupBy("key").agg(F.sum("count").alias("n")).where("n > 1")
                   .select("key"), "repeat-keys")
    keyed = stored(keyed.join(broadcast_if_small(again, 1_000_000), "key", "left_semi"),
                   "repeat-keyed")
    # Any occurrence can stand for its class; ``first`` keeps one row's values.
    each = stored(keyed.groupBy("key", "class").agg(
        F.sum("count").alias("n"), *[F.first(c).alias(c) for c in (*names, "distance")]),
        "repeat-classes")
    twice = each.where("n > 1").select("key", "class")
    found = [rows.where("key IS NULL").select(*names),
             keyed.join(twice, ["key", "class"]).select(*names)]
    # Stored, here and below, so that joins with a hot key stand alone.
    several = stored(each.groupBy("key").agg(F.count("*").alias("k"), F.min("n").alias("least"))
                     .where("k > 1 AND least = 1").select("key"), "repeat-several")
    picked = each.join(broadcast_if_small(several, 1_000_000), "key").withColumn(
        "witness", F.col("n") > 1)
    left = bodies(docs, picked, s)
    for block in (*s.blocks, 0):
        counts = left.groupBy("key").agg(F.count("*").alias("k"),
                                         F.min("witness").alias("settled"))
        counts = stored(counts.where("k > 1 AND NOT settled").drop("settled"), "repeat-counts")
        few, many = counts.where(F.col("k") <= s.cell), counts.where(F.col("k") > s.cell)
        cells = left.join(broadcast_if_small(few, 1_000_000), "key", "left_semi")
        found.append(_in_cells(cells, s, spark))
        if not block or many.isEmpty():
            break
        wide = left.join(broadcast_if_small(many), "key", "left_semi")
        blocks = stored(cut(wide, block, s), "repeat-blocks")
        folded = stored(blocks.groupBy("key", "class").agg(
            F.count("*").alias("n"), F.min("witness").alias("all_witness"),
            *[F.first(c).alias(c) for c in _BODY_NAMES if c not in ("key", "class", "witness")]),
            "repeat-folded")
        found.append(blocks.where("NOT witness").join(
            folded.where("n > 1").select("key", "class"), ["key", "class"]).select(*names))
        left = folded.withColumn("witness", F.col("all_witness") | (F.col("n") > 1)).select(
            *_BODY_NAMES)
    total = found[0]
    for more in found[1:]:
        total = total.unionByName(more)
    return total


def _in_cells(rows: DataFrame, s: Settings, spark: SparkSession) -> DataFrame:
    """Cells of whole anchors: each group takes those of a share of the hashes."""
    groups = 8 * width(spark)
    return (rows.withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(groups)))
            .groupBy("cell").applyInPandas(lambda cell: _cell(cell, s), RUN))


def spans(runs, length: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that some run's strings cover."""
    out: list[list[int]] = []
    for a, n in sorted((r["start"], r["starts"]) for r in runs):
        z = a + n - 1 + length
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def without_repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, the removed spans (first
    and one past the last byte), n_removed, n_spans, kept_sha256 and the bytes
    that are left."""
    python_ready(docs)
    runs = stored(repeated_runs(docs, s).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "starts")).alias("runs")), "repeat-runs")
    rows = with_runs(docs, runs, "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                  "spans array<struct<first: int, last: int>>, kept binary")
    def remove(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, lists):
            raw = (text or "").encode()
            gone = spans(found if found is not None else [], s.length)
            edges = [0, *[x for span in gone for x in span], len(raw)]
            kept = b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2]))
            out.append((len(raw), len(raw) - len(kept), len(gone),
                        hashlib.sha256(kept).hexdigest(),
                        [{"first": a, "last": z} for a, z in gone], kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256",
                                          "spans", "kept"])

    return rows.select("doc_id", remove.asNondeterministic()("text", "runs").alias("r")).select(
        "doc_id", "r.*")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
