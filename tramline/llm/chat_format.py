"""Chat formatting: cumulative snapshots collapse, then maximal conversations
are rendered.

A chat logged after every turn leaves snapshots, each a prefix of the next.
Each turn gets a rolling hash of all turns up to it; a conversation whose
last hash is a proper prefix hash of another is dropped by an anti-join, and
of equal conversations the one with the smallest id stays.

The rolling hash is a running sum of turn hashes (each over turn number, role
and text), 4 x 32 bits wide. Sums are taken per slice of ``SLICE`` turn
numbers first and carried from slice to slice, so that a conversation of any
length spreads over many tasks; a rendered conversation is one row per slice.

Defined results: rows without conv_id or turn belong to no conversation and
are left out; a null role or text reads as empty (null and empty differ in
the hash); a row repeated exactly counts once; different rows with one turn
number are ordered by role, then text. Turn numbers are part of the identity
of a turn. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import stored, table

#: Turn numbers in a slice.
SLICE = 256

_PARTS = ("h0", "h1", "h2", "h3")
_LOW = 0xFFFFFFFF


def _halves(seed: int, first: str, second: str) -> list[Column]:
    h = F.xxhash64(F.lit(seed), "turn", F.col("role").isNull(), F.coalesce("role", F.lit("")),
                   F.col("text").isNull(), F.coalesce("text", F.lit("")))
    return [F.shiftrightunsigned(h, 32).alias(first), h.bitwiseAND(F.lit(_LOW)).alias(second)]


def turn_hashes(turns: DataFrame) -> DataFrame:
    """One row per distinct turn: its slice, place and rolling prefix hash.

    A hash holds the turns up to this one, the number ``k`` of them included."""
    rows = (turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
            .select("conv_id", "turn", "role", "text").distinct()
            .withColumn("slice", F.floor(F.col("turn") / SLICE))
            .select("*", *_halves(11, "h0", "h1"), *_halves(29, "h2", "h3")))
    sums = [*(F.sum(c).alias(f"{c}_all") for c in _PARTS), F.count("*").alias("k_all")]
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per slice of a conversation.
    carried = (rows.groupBy("conv_id", "slice").agg(*sums)
               .select("conv_id", "slice", *[
                   F.coalesce(F.sum(f"{c}_all").over(before), F.lit(0)).alias(f"{c}_from")
                   for c in (*_PARTS, "k")]))
    within = (Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
              .rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.join(carried, ["conv_id", "slice"])
    k = F.col("k_from") + F.count("*").over(within)
    # Sums of 32-bit parts stay below 2^63 for 2^31 turns; low bits are kept.
    parts = [(F.col(f"{c}_from") + F.sum(c).over(within)).bitwiseAND(F.lit(_LOW)) for c in _PARTS]
    return joined.select("conv_id", "turn", "role", "text", "slice", k.alias("k"),
                         F.struct(*[p.alias(c) for p, c in zip(parts, _PARTS)]).alias("prefix"))


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_equal (conversations equal to it) of those that
    are no proper prefix of another."""
    narrow = hashed.select("conv_id", "k", "prefix")
    size = narrow.groupBy("conv_id").agg(
        F.max("k").alias("n_turns"), F.max_by("prefix", "k").alias("prefix"))
    wholes = size.groupBy("n_turns", "prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    # Prefixes of copies and common openings fold before the shuffle.
    proper = (narrow.join(size.select("conv_id", "n_turns"), "conv_id")
              .where(F.col("k") < F.col("n_turns"))
              .groupBy("k", "prefix").agg(F.count("*").alias("n_longer")))
    return (wholes.join(proper, (wholes["n_turns"] == proper["k"])
                        & (wholes["prefix"] == proper["prefix"]), "left_anti")
            .select("conv_id", "n_turns", "n_equal"))


def render(hashed: DataFrame, kept: DataFrame) -> DataFrame:
    """Rendered text of the kept conversations, one row per slice of turns:
    ``<|role|>`` and the text of each turn on lines of their own."""
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"),
                    F.coalesce("text", F.lit("")), F.lit("\n"))
    return (hashed.join(kept, "conv_id")
            .groupBy("conv_id", "slice")
            .agg(F.first("n_turns").alias("n_turns"), F.first("n_equal").alias("n_equal"),
                 F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))
            .select("conv_id", F.col("slice").cast("long").alias("segment"), "n_turns", "n_equal",
                    F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text")))


def chat_format(turns: DataFrame) -> DataFrame:
    hashed = stored(turn_hashes(turns), "chat-turns")
    return render(hashed, maximal_conversations(hashed))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(table(spark, sf_dir, "conversations"))


OP10_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
h AS (SELECT *, row_number() OVER w AS k,
        md5(string_agg(md5(concat_ws('|', turn, role IS NULL, length(coalesce(role, '')),
            coalesce(role, ''), text IS NULL, coalesce(text, ''))), '') OVER w) AS prefix
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST
                          ROWS UNBOUNDED PRECEDING)),
size AS (SELECT conv_id, max(k) AS n_turns, max_by(prefix, k) AS prefix FROM h GROUP BY conv_id),
wholes AS (SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_equal
           FROM size GROUP BY n_turns, prefix),
proper AS (SELECT DISTINCT h.prefix FROM h JOIN size USING (conv_id) WHERE h.k < size.n_turns),
kept AS (SELECT * FROM wholes WHERE prefix NOT IN (SELECT prefix FROM proper))
SELECT conv_id, CAST(floor(turn / {SLICE}) AS BIGINT) AS segment, any_value(n_turns) AS n_turns,
       any_value(n_equal) AS n_equal,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10),
                  '' ORDER BY k) AS text
FROM h JOIN kept USING (conv_id) GROUP BY conv_id, segment
"""
