"""Quality rule: zstandard compression ratios held against bands.

The ratio (bytes before / bytes after) of a whole text, and of each of its
fixed chunks, must lie in a band that depends on the length measured: short
texts compress badly whatever they say, long ones well. A ratio above the
band is repetition (menus, spam, one word over and over); below it, noise
(encoded data, random strings). All work is per row: one scan, no shuffle.

Defined results: a null or empty text has no words and ratio 0, and fails the
base rule (fewer than 50 words); repeated rows each get their own row; an empty
table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import python_ready, table

BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, ratio double, n_chunks long, "
          "bad_chunk_share double, verdict string, kept boolean")


@dataclass(frozen=True)
class Bands:
    """Limits on ratios by length in bytes: (length below, least, most)."""
    limits: tuple[tuple[float, float, float], ...] = (
        (128, 0.30, 2.5), (512, 0.80, 2.6), (2048, 1.10, 2.8),
        (8192, 1.30, 3.0), (32768, 1.40, 3.2), (float("inf"), 1.40, 4.0))
    chunk_bytes: int = 4096
    #: A last chunk shorter than this is part of the one before it.
    least_chunk: int = 1024
    #: Share of a text's bytes that may lie in chunks out of their band.
    bad_share: float = 0.25
    level: int = 3

    def side(self, n_bytes: int, ratio: float) -> int:
        """-1 below the band for this length, 1 above it, 0 inside."""
        _, least, most = next(x for x in self.limits if n_bytes < x[0])
        return -1 if ratio < least else int(ratio > most)


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in some 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0  # end: first word not yet counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _dup_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    dups = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dups += 1
        elif line and not line.isspace():
            seen.add(line)
    return dups


def _measure(text: str | None, bands: Bands, packer) -> tuple:
    raw = (text or "").encode()
    words = raw.split()  # on exactly the six ASCII blanks
    n = len(words)
    repeat = _repeat_words(words)
    failed = n < 50 or 100 * repeat > 50 * n
    base = (n, len(text or "") - sum(map(raw.count, BLANKS)), sum(map(raw.count, SYMBOLS)),
            _dup_lines(raw), repeat, failed)
    if not raw:
        return (*base, 0.0, 0, 0.0, "empty", False)
    size = len(raw)
    ratio = size / len(packer.compress(raw))
    side = bands.side(size, ratio)
    cuts = list(range(0, size, bands.chunk_bytes))
    if len(cuts) > 1 and size - cuts[-1] < bands.least_chunk:
        cuts.pop()
    bad = 0
    if len(cuts) > 1:
        for a, b in zip(cuts, [*cuts[1:], size]):
            if bands.side(b - a, (b - a) / len(packer.compress(raw[a:b]))):
                bad += b - a
    share = bad / size
    verdict = ("repetitive" if side > 0 else "incompressible" if side < 0
               else "uneven" if share > bands.bad_share else "in_band")
    return (*base, ratio, len(cuts), share, verdict, not failed and verdict == "in_band")


def measures(text: Column | str, bands: Bands = Bands()) -> Column:
    """Struct column with the counts, ratios and verdict of a text column."""
    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        import zstandard
        packer = zstandard.ZstdCompressor(level=bands.level)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pd.DataFrame([_measure(t, bands, packer) for t in texts], columns=names)
    return run.asNondeterministic()(text)


def compression_bands(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts and the verdict."""
    python_ready(docs)
    return docs.select("doc_id", measures("text", bands).alias("m")).select("doc_id", "m.*")


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands(table(spark, sf_dir, "documents"))
