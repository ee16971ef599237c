"""Run streaming DataFrames to a durable sink and read the result back.

Sinks and checkpoints live in the shared folder, so a restarted driver or a
lost executor resumes from the checkpoint (offsets, commits, state) and the
sink's own commit log keeps the output exactly-once.

* append mode   -> parquet file sink (only committed files are read back)
* complete mode -> ``foreachBatch`` writing the whole result table of each epoch
                   to a folder of its own (``epoch_id=N``); readers take the last
                   one, and all but the last two are removed
* update mode   -> ``foreachBatch`` writing each epoch's changed rows to its
                   own partition folder (``epoch_id=N``, overwritten on retry);
                   ``latest_rows`` folds them to the current table
* ``carried``   -> a table goes from epoch to epoch (running state kept by batch
                   operators); a missing one stops the query
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tramline.session import fresh_dir

EPOCH = "epoch_id"


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """Replace a window struct by zone-less ``window_start`` / ``window_end``."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").cast("timestamp_ntz").alias("window_start"),
                     F.col(f"{col}.end").cast("timestamp_ntz").alias("window_end"), *rest)


def _writer(stream: DataFrame, *, mode: str, sink: str, checkpoint: str,
            per_batch: Callable[[DataFrame, int], None] | None):
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if per_batch is not None:
        return writer.foreachBatch(per_batch)
    if mode == "append":
        return writer.format("parquet").option("path", sink)
    spark = stream.sparkSession

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        # One partition folder per epoch, overwritten on retry: idempotent.
        batch.write.mode("overwrite").parquet(f"{sink}/{EPOCH}={epoch}")
        if mode == "complete":
            drop_epochs(spark, sink, before=epoch - 1)
    return writer.foreachBatch(write_epoch)


def epochs(spark: SparkSession, sink: str) -> list[int]:
    """Epochs that have a folder in the sink, in order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sink)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.removeprefix(f"{EPOCH}=")) for n in names if n.startswith(f"{EPOCH}="))


def drop_epochs(spark: SparkSession, sink: str, *, before: int) -> None:
    """Remove the folders of old epochs (a retried epoch needs the one before)."""
    jvm = spark.sparkContext._jvm
    for epoch in epochs(spark, sink):
        if epoch < before:
            path = jvm.org.apache.hadoop.fs.Path(f"{sink}/{EPOCH}={epoch}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def start(stream: DataFrame, *, mode: str = "append", sink: str, checkpoint: str,
          processing_time: str | None = None,
          per_batch: Callable[[DataFrame, int], None] | None = None,
          name: str | None = None, state_partitions: int | None = None,
          conf: dict[str, str] | None = None) -> StreamingQuery:
    """Start a query; ``processing_time`` (e.g. "10 seconds") for a live
    feed, otherwise it drains what is available now and stops.

    ``state_partitions`` is the number of state-store partitions of the
    stateful operators; a checkpoint keeps it for good. Default: the session's
    shuffle width, which does not depend on the executors there at the start.
    It and ``conf`` (settings of this query alone) are set for the moment the
    query starts, which takes a copy of the session's settings."""
    spark = stream.sparkSession
    writer = _writer(stream, mode=mode, sink=sink, checkpoint=checkpoint, per_batch=per_batch)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    writer = writer.trigger(**trigger)
    settings = dict(conf or {})
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_sink(spark: SparkSession, sink: str, schema, *, mode: str = "append") -> DataFrame:
    """The sink's table; in complete mode that of the last epoch."""
    if mode == "complete":
        there = epochs(spark, sink)
        sink = f"{sink}/{EPOCH}={there[-1]}" if there else sink
    try:
        return spark.read.schema(schema).parquet(sink)
    except AnalysisException:
        # No epoch wrote anything (empty input): an empty table.
        return spark.createDataFrame([], schema)


def run(stream: DataFrame, *, mode: str = "append", label: str = "stream",
        sink: str | None = None, checkpoint: str | None = None) -> tuple[DataFrame, StreamingQuery]:
    """Drain the stream (``availableNow``) into a sink; return the sink table
    and the finished query (for its progress metrics)."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")
    query = start(stream, mode=mode, sink=sink, checkpoint=checkpoint)
    await_end(query)
    schema = stream.schema
    if mode == "update":
        schema = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
    return read_sink(spark, sink, schema, mode=mode), query


def run_latest(stream: DataFrame, keys: Sequence[str], *, label: str = "stream",
               sink: str | None = None, checkpoint: str | None = None
               ) -> tuple[DataFrame, StreamingQuery]:
    """Drain in update mode and fold to the current rows of each key: every
    window is there, also those the watermark has not closed yet."""
    table, query = run(stream, mode="update", label=label, sink=sink, checkpoint=checkpoint)
    return latest_rows(table, keys), query


def carried(stream: DataFrame, step: Callable[[DataFrame, DataFrame | None], dict[str, DataFrame]],
            *, sink: str, checkpoint: str, processing_time: str | None = None,
            conf: dict[str, str] | None = None, mode: str = "append") -> StreamingQuery:
    """Run ``step(batch, carry)`` on every micro-batch. It returns tables by
    name, or functions of those written before; each is written to
    ``sink/<name>/epoch_id=N``, and ``carry`` is handed to the next epoch (only
    its last two are kept). A retried epoch starts from the same carry and
    rewrites its folders. An epoch after the first whose carry is missing
    raises: its sink does not belong to the checkpoint."""
    spark = stream.sparkSession

    def per_batch(batch: DataFrame, epoch: int) -> None:
        carry = None
        if epoch > 0:
            if epoch - 1 not in epochs(spark, f"{sink}/carry"):
                raise RuntimeError(f"{sink} has no state of epoch {epoch - 1}: it is not the sink "
                                   "this checkpoint was run with")
            carry = spark.read.parquet(f"{sink}/carry/{EPOCH}={epoch - 1}")
        written: dict[str, DataFrame] = {}

        def write(name: str, table: DataFrame) -> None:
            path = f"{sink}/{name}/{EPOCH}={epoch}"
            table.write.mode("overwrite").parquet(path)
            written[name] = spark.read.schema(table.schema).parquet(path)

        batch.persist()
        try:
            tables = step(batch, carry)
            direct = {n: t for n, t in tables.items() if not callable(t)}
            # These do not need each other: their jobs run side by side.
            with ThreadPoolExecutor(max(1, len(direct))) as pool:
                run_one = inheritable_thread_target(spark)(write)
                for job in [pool.submit(run_one, n, t) for n, t in direct.items()]:
                    job.result()
            for name, of_written in tables.items():
                if name not in direct:
                    write(name, of_written(written))
        finally:
            batch.unpersist()
        # Spark commits the epoch after this: until then it may be run again, from
        # the carry of the epoch before.
        drop_epochs(spark, f"{sink}/carry", before=epoch - 1)

    return start(stream, mode=mode, sink=sink, checkpoint=checkpoint,
                 processing_time=processing_time, per_batch=per_batch, conf=conf)


def run_carried(stream: DataFrame, step, *, label: str, sink: str | None = None,
                checkpoint: str | None = None) -> str:
    """Drain a ``carried`` query; returns its sink."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    query = carried(stream, step, sink=sink, checkpoint=checkpoint or fresh_dir(spark, f"{label}-ckpt"))
    await_end(query)
    return sink


def run_per_batch(stream: DataFrame, batch_op: Callable[[DataFrame], DataFrame], *,
                  label: str = "per-batch", sink: str | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Apply a batch operator to every micro-batch on its own (the result of
    a batch does not depend on earlier batches) and keep each batch's output
    in its own folder (``batch_id=N``, overwritten if the batch is retried).
    Returns all batches' outputs with their ``batch_id``."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        batch_op(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={epoch}")

    query = start(stream, sink=sink, checkpoint=checkpoint, per_batch=per_batch)
    await_end(query)
    if not there(spark, sink):
        empty = batch_op(spark.createDataFrame([], stream.schema))
        return empty.withColumn("batch_id", F.lit(None).cast("int"))
    return spark.read.parquet(sink)


def there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def latest_rows(table: DataFrame, keys: Sequence[str], *, keep_epoch: bool = False) -> DataFrame:
    """Fold update-mode epochs to the current rows per key (those of its last
    epoch; a key may have several rows; a NULL key is a key like any other)."""
    rank = Window.partitionBy(*keys).orderBy(F.desc(EPOCH))
    last = table.withColumn("__rank", F.rank().over(rank)).where("__rank = 1").drop("__rank")
    return last if keep_epoch else last.drop(EPOCH)


# Late rows by run and epoch: a query itself keeps its last progress entries only.
_DROPS: dict[str, dict[int, int]] = {}


def _note_drops(query: StreamingQuery) -> dict[int, int]:
    seen = _DROPS.setdefault(str(query.runId), {})
    for progress in query.recentProgress:
        seen[progress.batchId] = sum(int(op.numRowsDroppedByWatermark or 0)
                                     for op in progress.stateOperators)
    return seen


def await_end(query: StreamingQuery, poll_seconds: float = 0.5) -> None:
    """Wait for a query's end, noting its progress on the way; raise its error."""
    while not query.awaitTermination(poll_seconds):
        _note_drops(query)
    _note_drops(query)
    if query.exception():
        raise query.exception()


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows the stateful operators dropped in this run, over all epochs
    that ``await_end`` has seen."""
    return sum(_note_drops(query).values())
