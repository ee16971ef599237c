"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import fresh_dir, ship_package

Builder = Callable[[SparkSession, str], DataFrame]

#: A word: a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: lineage
    ends there, and a lost executor costs no recomputation of what is before."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def python_ready(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package on the Python workers, and
    batches of 2,000 rows where the session has Spark's own 10,000: whole texts
    are wide rows, and a worker holds a batch several times over."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "2000")
    return spark


def with_release(rows: Iterator, *caches: Callable[[], None]) -> Iterator:
    """``rows``, and at the end of the partition the worker's caches emptied: a
    worker lives on for other stages, whose memory it would take."""
    try:
        yield from rows
    finally:
        import pyarrow
        for clear in caches:
            clear()
        pyarrow.default_memory_pool().release_unused()


def scratch_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its columns are."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fifth of the documents that nothing is learned from
    (crc32 of the id's text mod 5 is 0); false for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a few words each up to which a table counts as small.
SMALL_ROWS = 500_000


def broadcast_if_small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``df`` (stored, of a few narrow columns) marked for broadcast if a count
    shows that it is small; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
