"""An update-mode sink that compacts itself: a base, a few deltas, a manifest.

Each epoch writes its changed rows to ``delta/epoch_id=N``. After every ``every``
epochs the base and the deltas since are folded into a new base
``base/epoch_id=N``, and a manifest of that number makes it the valid one: a
small file, written under another name and renamed, so that readers see it whole
or not at all. A reader takes the newest manifest, its base, and the deltas after
it: never more than ``every`` + 1 folders, however long the stream has run.

A crash at any point leaves a valid table. Before the rename the old base and
its deltas are all there; a half-written base is overwritten when the epoch runs
again. A retried epoch writes the same delta, which a base that has it already
makes void. Old bases and deltas are removed one compaction later, so a reader
that has just opened the manifest before can finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tramline.session import fresh_dir
from tramline.streaming.runner import (
    EPOCH, await_end, drop_epochs, epochs, latest_rows, start,
)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm


def _manifests(spark: SparkSession, sink: str) -> list[int]:
    fs, at, _ = _fs(spark, f"{sink}/manifest")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n) for n in names if n.isdigit())


def switch(spark: SparkSession, sink: str, epoch: int) -> None:
    """Make the base of ``epoch`` the valid one, in one step."""
    fs, at, jvm = _fs(spark, f"{sink}/manifest/{epoch}")
    if fs.exists(at):
        return
    _, draft, _ = _fs(spark, f"{sink}/manifest/_{epoch}")
    fs.create(draft, True).close()
    if not fs.rename(draft, at):
        raise RuntimeError(f"manifest {epoch} of {sink} could not be switched")


class UpsertSink:
    """The table at ``sink`` with one set of rows for each of ``keys``."""

    def __init__(self, spark: SparkSession, sink: str, keys: Sequence[str], schema: T.StructType,
                 *, every: int = 8):
        self.spark, self.sink, self.keys, self.every = spark, sink.rstrip("/"), list(keys), every
        self.schema = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])

    def _read(self, kind: str, numbers: list[int]) -> DataFrame:
        paths = [f"{self.sink}/{kind}/{EPOCH}={n}" for n in numbers]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        if kind == "base":  # its rows have their own epochs
            return self.spark.read.schema(self.schema).parquet(*paths)
        return self.spark.read.schema(self.schema).option(
            "basePath", f"{self.sink}/{kind}").parquet(*paths)

    def parts(self, until: int | None = None) -> tuple[list[int], list[int]]:
        """Numbers of the valid base (or none) and of the deltas after it."""
        valid = _manifests(self.spark, self.sink)[-1:]
        after = valid[0] if valid else -1
        deltas = [n for n in epochs(self.spark, f"{self.sink}/delta")
                  if n > after and (until is None or n <= until)]
        return valid, deltas

    def rows(self, until: int | None = None) -> DataFrame:
        """The current rows of every key, with the epoch that wrote them."""
        base, deltas = self.parts(until)
        both = self._read("base", base).unionByName(self._read("delta", deltas))
        return latest_rows(both, self.keys, keep_epoch=True)

    def table(self) -> DataFrame:
        return self.rows().drop(EPOCH)

    def write(self, batch: DataFrame, epoch: int) -> None:
        """One epoch (for ``foreachBatch``)."""
        batch.write.mode("overwrite").parquet(f"{self.sink}/delta/{EPOCH}={epoch}")
        base, deltas = self.parts(until=epoch)
        if len(deltas) >= self.every:
            self.compact(epoch, base)

    def compact(self, epoch: int, before: list[int]) -> None:
        """Fold base and deltas up to ``epoch`` into a new base and switch to it."""
        self.rows(until=epoch).write.mode("overwrite").parquet(f"{self.sink}/base/{EPOCH}={epoch}")
        switch(self.spark, self.sink, epoch)
        # What the base before this one replaced; nobody starts reading that any more.
        oldest = before[0] if before else -1
        drop_epochs(self.spark, f"{self.sink}/delta", before=oldest + 1)
        drop_epochs(self.spark, f"{self.sink}/base", before=oldest)


def start_upsert(stream: DataFrame, keys: Sequence[str], *, sink: str, checkpoint: str,
                 every: int = 8, processing_time: str | None = None) -> StreamingQuery:
    target = UpsertSink(stream.sparkSession, sink, keys, stream.schema, every=every)
    return start(stream, mode="update", sink=sink, checkpoint=checkpoint,
                 processing_time=processing_time, per_batch=target.write)


def run_upsert(stream: DataFrame, keys: Sequence[str], *, label: str = "upsert",
               sink: str | None = None, checkpoint: str | None = None, every: int = 8) -> UpsertSink:
    """Drain the stream into the sink; returns it."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    await_end(start_upsert(stream, keys, sink=sink, every=every,
                           checkpoint=checkpoint or fresh_dir(spark, f"{label}-ckpt")))
    return UpsertSink(spark, sink, keys, stream.schema, every=every)
