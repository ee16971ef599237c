"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes if the same line, or one within ``edits`` edits of it, occurs
earlier (by doc_id, then text hash, then line number). Near lines are found
by segments: a line of length l is cut into edits + 1 segments; a line of the
same or a greater length, up to l + edits, that is near it must hold one of
them unchanged at one of a few starts (those that leave enough edits for what
lies to the left and to the right). Each line emits its own segments and the
substrings it probes with as hashes of (l, segment, substring); hashes that
two different lines share name the candidate lines, mostly a small part.

Candidates meet in a left semi join, which stops at a line's first match and
so never lists the pairs of a group: equal hash, then a parity bitmap of the
characters (an edit changes at most two of its bits), then a banded
bit-parallel edit distance in one 64-bit word.

Where very many different lines share a segment (an opening, a form), a shared
one says little. With ``crowd`` set, lines of such a crowd are held against its first lines, which
settles near copies of one line; if many are left they are cut again beside the
segment, and must share a segment of that part as well, as often as it takes. So
a line meets few others, and the work grows with the number of lines, not with
the square of a crowd.

Exact copies fold in aggregates before every shuffle of lines. The shared
hashes are broadcast only if a count shows them few; else they are joined.

Lines of fewer than ``least_chars`` characters (blanks at the ends not counted)
go for being equal to an earlier line only: from ``short_exact`` characters on
wherever that is, shorter ones within their own document, as ordinary short
lines of different documents are no copies. They fold by the same aggregates;
the hashes of the latter hold their document.

Defined results: blank lines are never touched, and without ``short_exact`` no
line under ``least_chars`` is; rows equal in doc_id and text count as
one document, whose lines are kept or dropped alike; a null id counts as the
smallest; null and empty texts stay as they are; an empty table gives an empty
table; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, scratch_name, stored, table


@dataclass(frozen=True)
class Settings:
    edits: int = 2
    least_chars: int = 20
    #: Characters from which an equal short line counts in any document; shorter
    #: ones count in the same document. None leaves all short lines alone.
    short_exact: int | None = None
    #: Shared hashes (8 bytes each) up to which they are broadcast.
    broadcast_hashes: int = 1_000_000
    #: Different lines from which those that share a segment are a crowd, which
    #: is cut further, and how often. None compares all groups as they are.
    crowd: int | None = None
    levels: int = 4


#: What the query and the pipeline's stage remove.
WHOLE = Settings(short_exact=10)


def with_segments(lines: DataFrame, part: str, s: Settings, parent: str | None = None,
                  places: bool = False) -> DataFrame:
    """``lines`` with ``segs``, hashes of the own segments of the text in column
    ``part``, which also probe texts of its length, and of the other substrings
    it probes with. The lowest bit of a hash tells own ones. ``parent`` is a key
    that goes into the hashes. With ``places`` an element is a struct of the hash
    and where its substring lies: (hash, first, size, i)."""
    parts, rows = s.edits + 1, []
    seed = f"{parent}, " if parent else ""
    # Lengths are columns of their own, so that no expression repeats them.
    lines = lines.withColumn("chars", F.char_length(part))
    lines = lines.select("*", *[F.expr(f"INT((chars - {k}) div {parts})").alias(f"base{k}")
                                for k in range(parts)])
    lines = lines.select("*", *[F.expr(f"{parts} - (chars - {k} - {parts} * base{k})")
                                .alias(f"even{k}") for k in range(parts)])
    for shorter in range(parts):
        base, even = f"base{shorter}", f"even{shorter}"
        for i in range(1, parts + 1):
            # Segments after the first ``even`` ones take a character more.
            start = f"1 + {i - 1} * {base} + GREATEST(0, {i - 1} - {even})"
            size = f"{base} + INT({i} > {even})"
            low = max(-(i - 1), shorter - (parts - i))
            high = min(i - 1, shorter + (parts - i))
            for shift in range(low, high + 1):
                own = int(shorter == 0 and shift == 0)
                key = (f"(XXHASH64({seed}{i}, chars - {shorter}, SUBSTRING({part}, {start} + {shift},"
                       f" {size})) & -2L) | {own}L")
                rows.append(f"NAMED_STRUCT('hash', {key}, 'first', {start} + {shift}, 'size', {size},"
                            f" 'i', {i})" if places else key)
    return lines.withColumn("segs", F.expr(f"ARRAY({', '.join(rows)})"))


def parity(line: Column) -> Column:
    """A bit for each of 64 classes of characters: set if their number is odd."""
    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c).bitwiseAND(F.lit(63)))))


def edit_distance(p: str, t: str, k: int) -> str:
    """SQL for the edit distance of two strings if it is at most k (else some
    greater number), for lengths above k that differ by at most k.

    Bit b of a word stands for row j - k + b of column j: the band slides down
    one row with each column. ``vp`` / ``vn`` hold where the distance grows or
    falls from one row to the next, ``hp`` / ``hn`` from the column before.
    The distance is followed down the band's last row until the last row of
    the matrix, then along that row."""
    top, mask = 2 * k, (1 << (2 * k + 1)) - 1
    equal = " + ".join(f"IF(z.p[j + {b} - 1] = z.t[j - 1], {1 << b}L, 0L)" for b in range(top + 1))
    return f"""
    TRANSFORM(ARRAY(NAMED_STRUCT(
        'p', CONCAT(ARRAY_REPEAT('', {k}), SLICE(SPLIT({p}, ''), 1, CHAR_LENGTH({p})),
                    ARRAY_REPEAT('', {2 * k + 1})),
        't', SPLIT({t}, ''), 'm', CHAR_LENGTH({p}), 'n', CHAR_LENGTH({t}))), z ->
      AGGREGATE(SEQUENCE(1, z.n),
        NAMED_STRUCT('vp', {mask & ~((1 << k) - 1)}L, 'vn', 0L, 'd', {k}L),
        (s, j) -> IF(s.d > {2 * k} + z.n - z.m, s,
          TRANSFORM(TRANSFORM(TRANSFORM(ARRAY({equal}),
            x -> ((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn) & {mask}L),
            d0 -> NAMED_STRUCT('d0', d0, 'hp', (s.vn | ~(d0 | s.vp)) & {mask}L, 'hn', d0 & s.vp)),
            h -> NAMED_STRUCT(
              'vp', (h.hn | ~(SHIFTRIGHT(h.d0, 1) | h.hp)) & {mask}L,
              'vn', SHIFTRIGHT(h.d0, 1) & h.hp,
              'd', IF(j <= z.m - {k}, s.d + 1 - (SHIFTRIGHT(h.d0, {top}) & 1L),
                      s.d + (SHIFTRIGHT(h.hp, z.m - j + {k}) & 1L)
                          - (SHIFTRIGHT(h.hn, z.m - j + {k}) & 1L))))[0]),
        s -> s.d))[0]"""


def lines_of(docs: DataFrame, s: Settings) -> DataFrame:
    """One row per line that may go: where it is, its hashes, and itself."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.split("text", "\n").alias("lines"))
    # Outer, as a plain explode would split every text once more for a filter.
    lines = split.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("n", "line"))
    at = F.struct("doc_id", "text_hash", "n").alias("at")
    if s.short_exact is None:
        return (lines.where(F.char_length(F.trim("line")) >= s.least_chars)
                .select(at, F.xxhash64("line").alias("h1"),
                        F.xxhash64(F.lit(7), "line").alias("h2"), F.lit(True).alias("long"), "line"))
    lines = lines.withColumn("size", F.char_length(F.trim("line")))
    anywhere = F.col("size") >= min(s.short_exact, s.least_chars)
    return (lines.where(anywhere | (F.trim(F.translate("line", "\r\t", "")) != ""))
            .select(at, F.when(anywhere, F.xxhash64("line"))
                    .otherwise(F.xxhash64("line", "doc_id", "text_hash")).alias("h1"),
                    F.when(anywhere, F.xxhash64(F.lit(7), "line"))
                    .otherwise(F.xxhash64(F.lit(7), "line", "doc_id", "text_hash")).alias("h2"),
                    (F.col("size") >= s.least_chars).alias("long"), "line"))


def _shared(keyed: DataFrame, s: Settings) -> DataFrame:
    """Keys that different lines share, one of them as an own segment, and by
    how many rows (``n``); stored."""
    return stored(keyed.groupBy("key").agg(
        F.min("h1").alias("a"), F.max("h1").alias("z"), F.max("own").alias("own"),
        F.count(F.lit(1)).alias("n")).where("a <> z AND own = 1").select("key", "n"), "line-hashes")


def _few(keys: DataFrame, s: Settings) -> DataFrame:
    return broadcast_if_small(keys.select("key"), s.broadcast_hashes)


def _met(later: DataFrame, earlier: DataFrame, s: Settings) -> DataFrame:
    """(h1, h2) of the lines of ``later`` that have a near one before them in
    ``earlier`` with the same ``key``, where one has it as an own segment."""
    later.createOrReplaceTempView(view := scratch_name(later, "line_later"))
    earlier.createOrReplaceTempView(other := scratch_name(earlier, "line_earlier"))
    return later.sparkSession.sql(f"""
        SELECT b.h1, b.h2 FROM {view} b LEFT SEMI JOIN {other} a
        ON a.key = b.key AND a.own + b.own > 0 AND a.at < b.at
           AND ABS(CHAR_LENGTH(a.line) - CHAR_LENGTH(b.line)) <= {s.edits}
           AND BIT_COUNT(a.bits ^ b.bits) <= {2 * s.edits}
           AND {edit_distance('a.line', 'b.line', s.edits)} <= {s.edits}""")


def near_lines(lines: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Hashes of the lines that have a different, near line before them."""
    # An outer explode: a plain one would first compute the array as a filter.
    keyed = with_segments(lines, "line", s).select(
        "at", "h1", "h2", "line", F.explode_outer("segs").alias("seg")).select(
        F.col("seg").bitwiseAND(F.lit(-2)).alias("key"),
        F.col("seg").bitwiseAND(F.lit(1)).alias("own"), "at", "h1", "h2", "line")
    shared = _shared(keyed, s)
    found = (keyed.join(_few(shared, s), "key", "left_semi")
             .groupBy("h1", "h2").agg(F.min("at").alias("at"), F.first("line").alias("line"),
                                      F.collect_set(F.struct("key", "own")).alias("segs")))
    candidates = stored(found.withColumn("bits", parity(F.col("line"))), "line-candidates")
    rows = candidates.select("h1", "h2", "at", "line", "bits", F.explode("segs").alias("seg")).select(
        "h1", "h2", "at", "line", "bits", "seg.key", "seg.own")
    if s.crowd is None:
        return _met(rows, rows, s).distinct()
    # Copies are one row here, so this counts different lines.
    crowds = stored(rows.groupBy("key").count().where(F.col("count") > s.crowd).select("key"),
                    "line-crowds")
    if crowds.isEmpty():
        return _met(rows, rows, s).distinct()
    crowds = _few(crowds, s)
    small = rows.join(crowds, "key", "left_anti")
    found, left = _first_matches(stored(rows.join(crowds, "key", "left_semi"), "line-crowd"), s)
    found = _met(small, small, s).unionByName(found)
    if not left.isEmpty():
        left = _few(left, s)
        again = rows.join(left, "key", "left_semi").select("h1", "h2").distinct()
        lines = candidates.select("h1", "h2", "at", "line", "bits").join(
            again, ["h1", "h2"], "left_semi")
        found = found.unionByName(_near_in_crowds(lines, left, stored(found, "line-met"), s))
    return found.distinct()


def _first_matches(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Near lines in crowds: (h1, h2) of what is found, and the keys of crowds
    that must be cut further.

    Where a crowd is many near copies, nearly all lines match one of its first
    ``crowd`` lines; where few lines are left without, these are held against all
    the others. Only a crowd with many lines left is to be cut."""
    first = rows.withColumn("place", F.row_number().over(
        Window.partitionBy("key").orderBy("at", F.desc("own")))).where(
        F.col("place") <= s.crowd).drop("place")
    met = stored(_met(rows, first, s).distinct(), "line-met")
    left = rows.join(broadcast_if_small(met), ["h1", "h2"], "left_anti")
    counts = stored(left.groupBy("key").count(), "line-left")
    few = counts.where(F.col("count") <= s.crowd)
    rest = _met(left.join(_few(few, s), "key", "left_semi"), rows, s)
    return met.unionByName(rest), counts.where(F.col("count") > s.crowd).select("key")


def _placed(rows: DataFrame, part: str, s: Settings, parent: str | None = None) -> DataFrame:
    """A row for each substring that stands for a line: its key, whether it is an
    own segment, and ``rest``, the text to its right in ``part`` or, for the last
    segments, to its left."""
    placed = with_segments(rows, part, s, parent, places=True).select(
        "at", "h1", "h2", "line", "bits", F.col(part).alias("whole"), F.explode_outer("segs").alias("seg"))
    rest = F.expr("IF(2 * seg.i <= " + str(s.edits + 2) + ", SUBSTRING(whole, seg.first + seg.size),"
                  " SUBSTRING(whole, 1, seg.first - 1))")
    return placed.select(F.col("seg.hash").bitwiseAND(F.lit(-2)).alias("key"),
                         F.col("seg.hash").bitwiseAND(F.lit(1)).alias("own"),
                         "at", "h1", "h2", "line", "bits", rest.alias("rest"))


def _near_in_crowds(lines: DataFrame, crowds: DataFrame, known: DataFrame, s: Settings
                    ) -> DataFrame:
    """Near lines among those that share a segment with very many others; those
    ``known`` to have a near one before them are not asked about again.

    Where a pair's edits leave a segment alone, the texts on the one side of it
    are as near as the lines are. So this side is cut into segments of its own,
    and of a crowd only lines that share one of these as well are compared. What
    is a crowd still is cut again; the last of ``levels`` compares all it has."""
    rows = _placed(lines, "line", s).join(crowds, "key", "left_semi")
    found = []
    for level in range(s.levels):
        sides = rows.select("at", "h1", "h2", "line", "bits", "rest", F.col("key").alias("parent"))
        rows = stored(_placed(sides.dropDuplicates(["h1", "h2", "parent", "rest"]), "rest", s,
                              "parent"), "line-crowd")
        shared = _shared(rows, s)
        last = level + 1 == s.levels
        small = rows.join(_few(shared if last else shared.where(F.col("n") <= s.crowd), s),
                          "key", "left_semi").drop("rest")
        found.append(_met(small.join(broadcast_if_small(known), ["h1", "h2"], "left_anti"), small, s))
        crowds = shared.where(F.col("n") > s.crowd)
        if last or crowds.isEmpty():
            break
        rows = stored(rows.join(_few(crowds, s), "key", "left_semi"), "line-crowd")
        met, crowds = _first_matches(rows.drop("rest"), s)
        found.append(met)
        if crowds.isEmpty():
            break
        rows = rows.join(_few(crowds, s), "key", "left_semi")
    return reduce(DataFrame.unionByName, found)


def dropped_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per document (doc_id, text_hash): the numbers (from 0) of the lines that
    go, and how many of them are near and exact repeats."""
    lines = lines_of(docs, s)
    near = near_lines(lines.where("long").drop("long"), s).withColumn("near", F.lit(True))
    places = lines.drop("line", "long")
    first = places.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # Only lines seen twice and near lines matter from here on. They are stored,
    # so that the join below stands alone and its hot lines can be split.
    marked = stored(first.join(near, ["h1", "h2"], "left").where("n > 1 OR near")
                    .select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")),
                    "line-marked")
    exact = F.col("at") != F.col("first")
    # Sets, so that a row that occurs twice counts once.
    return (places.join(broadcast_if_small(marked), ["h1", "h2"]).where("near OR at <> first")
            .groupBy("at.doc_id", "at.text_hash")
            .agg(F.collect_set("at.n").alias("gone"),
                 F.size(F.collect_set(F.when(exact, F.col("at.n")))).alias("n_exact")))


def with_dropped(docs: DataFrame, name: str, s: Settings) -> DataFrame:
    """``docs`` with a struct column ``name`` (gone, n_exact), null where no
    line of a document goes."""
    gone = dropped_lines(docs.select("doc_id", "text"), s)
    key, key_hash = scratch_name(docs, "gone_doc"), scratch_name(docs, "gone_hash")
    gone = gone.select(F.col("doc_id").alias(key), F.col("text_hash").alias(key_hash),
                       F.struct("gone", "n_exact").alias(name))
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col(key))
                     & (F.xxhash64(docs["text"]) == F.col(key_hash)), "left").drop(key, key_hash)


def kept_text(name: str) -> Column:
    """The text less the lines that go."""
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.col(name)["gone"], i))
    return F.when(F.col(name).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def line_dedup(docs: DataFrame, s: Settings = WHOLE) -> DataFrame:
    """doc_id, counts of lines and of those that go for being equal (n_exact)
    or near (n_near) to an earlier one, and the text that is left."""
    found = with_dropped(docs.select("doc_id", "text"), "lost", s)
    n_exact = F.coalesce(F.col("lost.n_exact"), F.lit(0))
    gone = F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost.gone"))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    return found.select("doc_id", lines.alias("n_lines"), n_exact.alias("n_exact"),
                        (gone - n_exact).alias("n_near"), kept_text("lost").alias("text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` with their texts less repeated lines, and
    ``n_chars`` (if there) counted anew for these; other columns as they were.
    A row of whose text only blank lines would be left goes."""
    name = scratch_name(docs, "lost_lines")
    found = with_dropped(docs, name, WHOLE)
    lost = F.col(name).isNotNull()
    text = kept_text(name)
    found = found.withColumn("text", text).where(~lost | (F.trim(F.translate("text", "\n\r\t", ""))
                                                          != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(lost, F.char_length("text").cast(kind))
                                 .otherwise(F.col("n_chars")))
    return found.drop(name)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))
