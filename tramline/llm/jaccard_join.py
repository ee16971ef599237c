"""N-gram Jaccard join: prefix filter, parity bitmaps, whole sets in cells.

Documents are sets of word shingles; equal sets are one node. There is one global
order of shingles (rare ones first), for the prefixes. Vertical partitioning (the
order cut into fragments, overlaps of two sets counted fragment by fragment over
the cluster and summed for each pair) was replaced: it took 6.35 x the input in
disk, this takes 0.89. Which pairs are counted:

* Two linked sets share one of their first shingles in the global order (the
  prefix), at places i and j with i + j no more than the differences the
  threshold leaves. Prefix shingles meet in blocks.
* A block of at most ``small_block`` nodes gives its pairs; larger blocks are
  dealt over cells of two tiles of nodes. Parity bitmaps, about a bit for each
  shingle, drop most false ties: every differing shingle flips one bit. A cell
  returns a spanning forest of the ties that are left.
* Ties make nodes into groups. Each group is dealt over cells
  of two tiles of nodes, to which each set goes whole; a cell counts overlaps
  as products of incidence matrices (of ``columns`` shingles at a time, in the
  order of their hashes), and returns a spanning forest of its links. So a group
  of n near copies gives no n * n rows, and a set is sent once for each tile of
  its group.

The order needs only be one order: shingles that many documents share come
last, by the logarithm of their counts (counted over all documents in batches;
counts under ``batch_least`` in a batch do not matter for the result). Shingles
known to be frequent are dealt over many tasks.

Defined results: texts without words have n_shingles 0 and are linked with
nothing; a null doc_id is never a component's id unless all are null; rows
equal in doc_id and text are one document; an empty table gives an empty table;
other columns are not looked at. Sets are compared as sets of 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import shingles
from tramline.llm.common import (
    broadcast_if_small, python_ready, stored, table, width, with_release,
)
from tramline.llm.components import components
from tramline.llm.shingles import mix, set_digest, shingle_sets


@dataclass(frozen=True)
class Settings:
    words: int = 4
    percent: int = 85
    small_block: int = 32
    #: Shingles (8 bytes and a byte each) that are placed last in the order.
    frequent: int = 500_000
    batch_least: int = 3
    #: Hashes that a task gathers before it passes them on.
    gather: int = 2_000_000
    #: Nodes in a tile, and shingles in one product of a cell.
    tile: int = 256
    columns: int = 4096
    #: Nodes in a tile of bitmaps, and the fewest bits of one.
    bitmap_tile: int = 1024
    least_bits: int = 512

    def linked(self, overlap, a, b):
        return 100 * overlap >= self.percent * (a + b - overlap)

    def most_differing(self, a, b):
        """Shingles in which linked sets of these sizes can differ at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


ENTRY = np.dtype([("h", "<u8"), ("d", "<i8"), ("n", "<u4"), ("p", "<u4")])
#: Ids pass through pandas as text: long columns with nulls would turn to floats.
PROFILE = ("doc_id string, text_hash long, n_shingles long, node long, sketch binary, "
           "h long, count long")


def _releasing(run):
    """A function of batches that gives its tables' memory back in the end."""
    return lambda batches: with_release(run(batches), shingles.release)


def _hash_column(v: np.ndarray) -> np.ndarray:
    return v.view(np.int64)


def _bitmap(hashes: np.ndarray, least: int) -> bytes:
    """Parity of the number of hashes in each class; the number of classes is
    the power of two from the set's size on. Halving a bitmap (by ``_folded``)
    gives that of half as many classes."""
    size = max(least, 1 << (len(hashes) - 1).bit_length())
    bits = np.bincount((mix(hashes) >> np.uint64(20)) & np.uint64(size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _folded(bitmap: bytes, n_bytes: int) -> np.ndarray:
    """A bitmap with its halves laid over each other until it has so few bytes."""
    b = np.frombuffer(bitmap, dtype=np.uint8)
    while len(b) > n_bytes:
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return b


def profile(docs: DataFrame, s: Settings) -> DataFrame:
    """Two kinds of rows: one per document (its node: the digest of its set),
    and counts of shingles that are frequent within a batch (column h)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def counts() -> pd.DataFrame:
            h, n = np.unique(np.concatenate(gathered), return_counts=True)
            often = n >= s.batch_least
            return pd.DataFrame({"h": _hash_column(h[often]), "count": n[often]})

        for batch in batches:
            rows = []
            for hashes in shingle_sets(list(batch["text"]), s.words):
                if not len(hashes):
                    rows.append((0, None, None))
                    continue
                node = set_digest(hashes)
                rows.append((len(hashes), node, _bitmap(hashes, s.least_bits)))
                if node not in seen:
                    seen.add(node)
                    gathered.append(hashes)
                    size += len(hashes)
            sizes, nodes, sketches = zip(*rows) if rows else ((), (), ())
            out = pd.DataFrame({"n_shingles": pd.array(sizes, dtype="Int64"),
                                "node": pd.array(nodes, dtype="Int64"),
                                "sketch": pd.Series(sketches, dtype=object)})
            out["doc_id"] = batch["doc_id"].to_numpy(dtype=object)
            out["text_hash"] = batch["text_hash"].to_numpy()
            out["h"] = pd.array([pd.NA] * len(out), dtype="Int64")
            out["count"] = pd.array([pd.NA] * len(out), dtype="Int64")
            yield out[_PROFILE_NAMES]
            if size >= s.gather:
                yield _padded(counts())
                gathered.clear()
                seen.clear()
                size = 0
        if size:
            yield _padded(counts())

    return stored(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text",
                              F.xxhash64("text").alias("text_hash"))
                  .mapInPandas(_releasing(run), PROFILE)
                  .withColumn("doc_id", F.col("doc_id").cast("long")), "shingle-profile")


_PROFILE_NAMES = [c.split()[0] for c in PROFILE.split(", ")]


def _padded(counts: pd.DataFrame) -> pd.DataFrame:
    for c in _PROFILE_NAMES:
        if c in ("sketch", "doc_id"):
            counts[c] = None
        elif c not in counts:
            counts[c] = pd.array([pd.NA] * len(counts), dtype="Int64")
    return counts[_PROFILE_NAMES]


def frequent_shingles(rows: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) of at most ``s.frequent`` shingles with the greatest
    counts, and the logarithm of each count."""
    totals = stored(rows.where("h IS NOT NULL").groupBy("h").agg(F.sum("count").alias("n"))
                    .select("h", F.floor(F.log2("n")).cast("int").alias("rank")),
                    "frequent-shingles")
    sizes = {r["rank"]: r["n"] for r in totals.groupBy("rank").agg(F.count("*").alias("n"))
             .collect()}  # a row for each power of two
    least, total = 64, 0
    for rank in sorted(sizes, reverse=True):
        total += sizes[rank]
        if total > s.frequent:
            break
        least = rank
    found = totals.where(F.col("rank") >= least).toPandas()
    h = found["h"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], found["rank"].to_numpy(dtype=np.uint8)[order]


def _ranks(h: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, rank = frequent
    if not len(known):
        return np.zeros(len(h), dtype=np.uint8)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, rank[at], 0)


def blocks(docs: DataFrame, frequent, s: Settings) -> DataFrame:
    """Pairs of nodes from small blocks (a, b), and shingles with their nodes
    from larger ones (kind 1: a is the shingle's place, b the node)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent)  # bounded by s.frequent
    parts = 4 * width(spark)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entries: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def deal() -> pd.DataFrame:
            e = np.concatenate(entries)
            key = mix(e["h"])
            # A frequent shingle is dealt by its nodes as well.
            often = _ranks(e["h"], shared.value) > 0
            key[often] ^= mix(e["d"][often].view(np.uint64))
            part = (key % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            e, part = e[order], part[order]
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(first[1:], len(e))
            return pd.DataFrame({"part": part[first],
                                 "entries": [e[a:z].tobytes() for a, z in zip(first, ends)]})

        for batch in batches:
            for hashes in shingle_sets(list(batch["text"]), s.words):
                n = len(hashes)
                node = set_digest(hashes) if n else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                rank = _ranks(hashes, shared.value)
                head = hashes[np.lexsort((hashes, rank))[:s.prefix(n)]]
                e = np.empty(len(head), dtype=ENTRY)
                e["h"], e["d"], e["n"], e["p"] = head, node, n, np.arange(len(head))
                entries.append(e)
                size += n
                if size >= s.gather:
                    yield deal()
                    entries.clear()
                    seen.clear()
                    size = 0
        if entries:
            yield deal()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        e = np.concatenate([np.frombuffer(x, dtype=ENTRY) for x in rows["entries"]])
        pairs, members = _met(e, _ranks(e["h"], shared.value) > 0, s)
        return pd.DataFrame({
            "kind": np.repeat(np.array([0, 1], dtype=np.int32), [len(pairs), len(members)]),
            "a": np.concatenate([pairs[:, 0], members[:, 0]]),
            "b": np.concatenate([pairs[:, 1], members[:, 1]])})

    dealt = docs.select("text").mapInPandas(_releasing(prefixes), "part long, entries binary")
    return stored(dealt.groupBy("part").applyInPandas(meet, "kind int, a long, b long"),
                  "shingle-blocks")


def _met(e: np.ndarray, often: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and block members (rows of two numbers) of one part's entries."""
    none = np.zeros((0, 2), dtype=np.int64)
    wide = e[often]
    e = e[~often]
    e = e[np.lexsort((e["d"], e["p"], e["h"]))]
    if len(e):
        again = (e["h"][1:] == e["h"][:-1]) & (e["d"][1:] == e["d"][:-1])
        e = e[np.append(True, ~again)]
    start, block, count = _groups(e["h"])
    if len(e):
        # Differences with the block's best partner must be few enough.
        p = e["p"].astype(np.int64)
        first = p[start]
        second = np.where(count > 1, p[np.minimum(start + 1, len(p) - 1)], 1 << 40)
        is_first = np.arange(len(e)) == start[block]
        partner = np.where(is_first, second[block], first[block])
        n = e["n"].astype(np.int64)
        e = e[p + partner <= s.most_differing(n, 100 * n // s.percent)]
    start, block, count = _groups(e["h"])
    small = (count[block] <= s.small_block) if len(e) else np.zeros(0, dtype=bool)
    large = np.concatenate([e[~small], wide])
    members = np.stack([large["h"].view(np.int64), large["d"]], 1) if len(large) else none
    return _pairs(e[small], s), np.unique(members, axis=0)


def _groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys: where each group starts, the group of each row, sizes."""
    if not len(h):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    count = np.diff(np.append(start, len(h)))
    return start, np.repeat(np.arange(len(start)), count), count


def _pairs(e: np.ndarray, s: Settings) -> np.ndarray:
    """Distinct pairs of nodes in the same (small) block that can be linked."""
    start, _, count = _groups(e["h"])
    found = [np.zeros((0, 2), dtype=np.int64)]
    for size in np.unique(count):
        rows = start[count == size][:, None] + np.arange(size)
        for i in range(size):
            for j in range(i + 1, size):
                x, y = e[rows[:, i]], e[rows[:, j]]
                a, b = x["n"].astype(np.int64), y["n"].astype(np.int64)
                can = (x["p"].astype(np.int64) + y["p"] <= s.most_differing(a, b)) \
                    & (100 * np.minimum(a, b) >= s.percent * np.maximum(a, b))
                found.append(np.stack([np.minimum(x["d"], y["d"])[can],
                                       np.maximum(x["d"], y["d"])[can]], 1))
    return np.unique(np.concatenate(found), axis=0)


def _parity_differences(x: pd.Series, y: pd.Series) -> pd.Series:
    out = np.zeros(len(x), dtype=np.int64)
    for i, (a, b) in enumerate(zip(x, y)):
        size = min(len(a), len(b))
        out[i] = np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum()
    return pd.Series(out)


def possible_pairs(pairs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose parity bitmaps differ no more than links allow."""
    def side(x: str) -> DataFrame:
        return nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                            F.col("sketch").alias(f"sketch_{x}"))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    most = F.floor((100 - s.percent) * (F.col("n_a") + F.col("n_b")) / (100 + s.percent))
    differences = F.pandas_udf(_parity_differences, "long")
    return both.where(differences("sketch_a", "sketch_b") <= most).select("a", "b")


def possible_ties(members: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Of larger blocks (shingle a, node b), a spanning forest of the pairs whose
    parity bitmaps differ no more than links allow."""
    sizes = members.groupBy("a").agg(F.ceil(F.count("*") / s.bitmap_tile).cast("int")
                                     .alias("tiles"))
    cells = (members.join(sizes, "a")
             .withColumn("tile", F.pmod(F.xxhash64("b"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode_outer(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("a", F.least("tile", "other").alias("i"),
                     F.greatest("tile", "other").alias("j"), F.col("b").alias("node")))
    places = 8 * width(members.sparkSession)

    def ties(rows: pd.DataFrame) -> pd.DataFrame:
        found = [_tied(cell["node"].to_numpy(dtype=np.int64),
                       cell["n_shingles"].to_numpy(dtype=np.int64), list(cell["sketch"]), s)
                 for _, cell in rows.groupby(["a", "i", "j"], sort=False)]
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    return (cells.join(nodes.select("node", "n_shingles", "sketch"), "node")
            .withColumn("place", F.pmod(F.xxhash64("a", "i", "j"), F.lit(places)))
            .groupBy("place").applyInPandas(ties, "a long, b long"))


def _tied(nodes: np.ndarray, n: np.ndarray, bitmaps: list[bytes], s: Settings) -> np.ndarray:
    """A forest (node, node) of one cell's possible links. Linked sets are of
    like size, so their bitmaps have one size or are a halving apart."""
    found = [np.zeros((0, 2), dtype=np.int64)]
    size = np.array([len(x) for x in bitmaps])
    for small in np.unique(size):
        at = np.flatnonzero((size == small) | (size == 2 * small))
        bits = np.unpackbits(np.stack([_folded(bitmaps[i], int(small)) for i in at]),
                             axis=1).astype(np.float32)
        ones, m = bits.sum(axis=1), n[at]
        differ = ones[:, None] + ones[None, :] - 2 * (bits @ bits.T)
        possible = ((differ <= s.most_differing(m[:, None], m[None, :]))
                    & (100 * np.minimum(m[:, None], m[None, :])
                       >= s.percent * np.maximum(m[:, None], m[None, :])))
        label = _labels(possible)
        moved = label != np.arange(len(at))
        found.append(np.stack([nodes[at[moved]], nodes[at[label[moved]]]], 1))
    return np.concatenate(found)


def _labels(linked: np.ndarray) -> np.ndarray:
    """The smallest number in each one's component of a link matrix."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(np.where(linked, label[None, :], len(linked)).min(axis=1), label)
        least = least[least]
        if (least == label).all():
            return label
        label = least


CELL = "root long, i int, j int, node long, hashes binary"


def cell_links(docs: DataFrame, groups: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """A spanning forest (a, b) of the links within each group (node, root)."""
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / s.tile).cast("int").alias("tiles"))
    wanted = stored(
        groups.join(sizes, "root").join(nodes.select("node", "rep"), "node")
        .select(F.col("rep.doc_id").alias("w_doc"), F.col("rep.text_hash").alias("w_hash"), "node",
                "root", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
                .alias("tile")), "shingle-wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"))
    picked = rows.join(broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("w_doc"))
                       & (F.col("text_hash") == F.col("w_hash"))).select(
                           "root", "tiles", "tile", "node", "text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for root, tiles, tile, node, hashes in zip(
                    batch["root"], batch["tiles"], batch["tile"], batch["node"],
                    shingle_sets(list(batch["text"]), s.words)):
                rows += [(root, min(tile, other), max(tile, other), node, hashes.tobytes())
                         for other in range(tiles)]
            yield pd.DataFrame(rows, columns=["root", "i", "j", "node", "hashes"])

    def count(cells: pd.DataFrame) -> pd.DataFrame:
        # Rows equal in doc_id and text bring a set twice.
        cells = cells.drop_duplicates(["root", "i", "j", "node"])
        found = [_forest(cell["node"].to_numpy(dtype=np.int64), list(cell["hashes"]), s)
                 for _, cell in cells.groupby(["root", "i", "j"], sort=False)]
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    places = 8 * width(docs.sparkSession)
    return (picked.mapInPandas(_releasing(sets), CELL)
            .withColumn("place", F.pmod(F.xxhash64("root", "i", "j"), F.lit(places)))
            .groupBy("place").applyInPandas(count, "a long, b long"))


def _forest(nodes: np.ndarray, sets: list[bytes], s: Settings) -> np.ndarray:
    """Links of one cell's sets, as (node, smallest node tied to it)."""
    order = np.argsort(nodes)
    nodes = nodes[order]
    parts = [np.frombuffer(sets[i], "<u8") for i in order]
    n = np.array([len(p) for p in parts], dtype=np.int64)
    h, owner = np.concatenate(parts), np.repeat(np.arange(len(nodes)), n)
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    _, column, count = _groups(h)
    held = count[column] > 1  # a shingle of one node adds to no overlap
    owner, column = owner[held], np.unique(column[held], return_inverse=True)[1]
    overlap = np.zeros((len(nodes), len(nodes)), dtype=np.float32)
    width_ = min(s.columns, int(column[-1]) + 1) if len(column) else 1
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width_):
        a, z = np.searchsorted(column, [first, first + width_])
        part = np.zeros((len(nodes), width_), dtype=np.float32)
        part[owner[a:z], column[a:z] - first] = 1
        overlap += part @ part.T  # these columns' partial overlaps
    linked = s.linked(overlap.astype(np.int64), n[:, None], n[None, :])
    label = _labels(linked)
    moved = label != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[label[moved]]], 1)


def jaccard_components(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id
    (smallest doc_id reachable by links) and first (the component's one
    document that stays when the others go)."""
    python_ready(docs)
    rows = profile(docs, s)
    people = rows.where("h IS NULL").select("doc_id", "text_hash", "n_shingles", "node", "sketch")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = stored(people.where("node IS NOT NULL").groupBy("node").agg(
        F.min(order).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "shingle-nodes")
    met = blocks(docs, frequent_shingles(rows, s), s)
    pairs = possible_pairs(met.where("kind = 0").select("a", "b"), nodes, s)
    ties = possible_ties(met.where("kind = 1").select("a", "b").distinct(), nodes, s)
    groups = stored(components(pairs.union(ties), "shingle-groups"), "shingle-group-nodes")
    links = cell_links(docs, groups, nodes, s)
    joined = components(links, "shingle-links")
    # The first document of each component, for the nodes that have links.
    rep = (joined.join(nodes.select("node", "rep"), "node")
           .groupBy("root").agg(F.min("rep").alias("top")))
    tops = (nodes.select("node", "rep").join(joined, "node", "left").join(rep, "root", "left")
            .select("node", F.coalesce("top", "rep").alias("top")))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    return (people.drop("sketch").join(tops, "node", "left")
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("top").isNull(), F.col("doc_id"))
                    .otherwise(F.col("top.doc_id")).alias("component_id"),
                    (F.col("top").isNull() | (F.col("top") == own)).alias("first")))


#: Near copies for the pipeline's stage; op8's own contract is the default.
STAGE = Settings(words=5, percent=80)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component (five words, 80 %) only the document
    with the smallest doc_id (then text hash); all columns as they were."""
    found = jaccard_components(docs, STAGE)
    gone = stored(found.where("NOT first").select(F.col("doc_id").alias("gone_doc_id"),
                                                  F.col("text_hash").alias("gone_text_hash"))
                  .distinct(), "near-copies")
    return docs.join(broadcast_if_small(gone),
                     docs["doc_id"].cast("long").eqNullSafe(gone["gone_doc_id"])
                     & (F.xxhash64(docs["text"]) == gone["gone_text_hash"]), "left_anti")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")
