"""Event-time reorder buffer: readings arrive in any order and leave in order.

The state is keyed by time slice and a bucket of the series. Readings are held in
the list state of their slice; an event-time timer at the slice's end fires when
the watermark gets there, the slice leaves in order, and its state is cleared.

Readings travel in blocks. Before the shuffle each task sorts its readings by key
and packs those of one key as an Arrow stream; the state holds the blocks as they
are, a slice that leaves is sorted by Arrow, and blocks are unpacked behind the
state. So calls of the state, which cost the same for one reading as for thousands,
grow with blocks. A block of a few readings only is held reading by reading.

All slices released in one epoch lie before all those of later epochs, so a
batch operator that carries the last reading of each series from epoch to epoch
(``carried``) sees every series in time order, whatever the order of arrival
was. A key holds what some series send in ``slice_seconds``, so a hot vehicle is
as many keys as it has slices, and state never outlives the watermark.

A reading whose slice has already left is late. Late readings are not dropped:
they leave at once, tagged, and so do readings without a time. Each reading
comes out once, with one of three kinds::

    in_order + late + undated = input

What is still held when a feed ends can be read from the checkpoint
(``held_rows``), so a finished feed has the whole batch answer (``finished``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tramline.session import fresh_dir
from tramline.streaming.runner import EPOCH, await_end, carried, epochs

KIND, IN_ORDER, LATE, UNDATED = "kind", "in_order", "late", "undated"
_BUCKET, _SLICE_END, _COUNT, _BLOCK = "__bucket", "__slice_end_ms", "__count", "__block"
_HELD, _HELD_BLOCKS = "held", "held_blocks"
#: Slice end of readings without a time.
_NEVER = -2 ** 63

#: Readings that a task packs at once (or so many bytes), and most of one block.
PACK_ROWS, PACK_BYTES, BLOCK_ROWS = 1 << 17, 32 << 20, 8192
#: Smaller blocks are held reading by reading.
FEW = 32

#: State variables with timers need this store.
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _plain(schema: T.StructType) -> T.StructType:
    """Timestamps as microseconds: no time zone on the way through Python."""
    return T.StructType([T.StructField(f.name, T.LongType() if isinstance(
        f.dataType, T.TimestampType) else f.dataType) for f in schema.fields])


def _to_plain(df: DataFrame) -> list:
    return [F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]


def _from_plain(schema: T.StructType) -> list:
    return [F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in schema.fields]


def _arrow(spark: SparkSession, columns: T.StructType) -> pa.Schema:
    return spark.createDataFrame([], columns).toArrow().schema


# Functions below go to Spark's workers by value, as local ones do: workers on the
# driver do not see shipped packages.

def block_codec() -> tuple[Callable, Callable]:
    """(to a block's bytes, from them) of an Arrow table."""
    def write(table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def read(block: bytes) -> pa.Table:
        return pa.ipc.open_stream(block).read_all()

    return write, read


def packer(columns: pa.Schema) -> Callable:
    """Rows of ``columns`` with their key to blocks, each with its key."""
    write, _ = block_codec()
    rows_at_once, bytes_at_once, most = PACK_ROWS, PACK_BYTES, BLOCK_ROWS

    def blocks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        import numpy as np
        import pyarrow.compute  # noqa: F401

        table = pa.Table.from_batches(batches)
        table = table.take(pa.compute.sort_indices(table, sort_keys=[
            (_BUCKET, "ascending"), (_SLICE_END, "ascending")])).combine_chunks()
        bucket, end = table[_BUCKET].to_numpy(), table[_SLICE_END].to_numpy()
        first = np.append(True, (bucket[1:] != bucket[:-1]) | (end[1:] != end[:-1]))
        first = np.append(np.flatnonzero(first), len(bucket)).tolist()
        cuts = [(at, min(most, z - at)) for a, z in zip(first, first[1:])
                for at in range(a, z, most)]
        rows, at = table.select(columns.names).cast(columns), [a for a, _ in cuts]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[at], pa.int32()), pa.array(end[at], pa.int64()),
             pa.array([n for _, n in cuts], pa.int32()),
             pa.array([write(rows.slice(a, n)) for a, n in cuts], pa.binary())],
            names=[_BUCKET, _SLICE_END, _COUNT, _BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows, size = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= rows_at_once or size >= bytes_at_once:
                yield blocks(kept)
                kept, rows, size = [], 0, 0
        if kept:
            yield blocks(kept)

    return run


def unpacker() -> Callable:
    """Blocks with their kind to rows, each with the kind."""
    _, read = block_codec()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, block in zip(batch.column(KIND).to_pylist(), batch.column(_BLOCK)):
                for rows in read(block.as_buffer()).to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array([kind] * rows.num_rows, pa.string())],
                        names=[*rows.schema.names, KIND])

    return run


def unpacked(blocks: DataFrame, plain: T.StructType) -> DataFrame:
    return blocks.mapInArrow(unpacker(), _with_kind(plain))


def _with_kind(plain: T.StructType) -> T.StructType:
    return T.StructType([*plain.fields, T.StructField(KIND, T.StringType())])


def slice_buffer(columns: T.StructType, arrow: pa.Schema, order: Sequence[str]
                 ) -> StatefulProcessor:
    """The state of one (bucket of series, slice)."""
    write, read = block_codec()
    nested = any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
                 for f in columns.fields)
    few, most, at_once = 0 if nested else FEW, BLOCK_ROWS, PACK_BYTES
    never = _NEVER
    told = Row(KIND, _BLOCK)

    class SliceBuffer(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.held = handle.getListState(_HELD, columns)
            self.blocks = handle.getListState(_HELD_BLOCKS, f"{_BLOCK} binary")

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            end = key[-1]
            gone = end <= timerValues.getCurrentWatermarkInMs()
            single, blocks, size, fresh = [], [], 0, False
            for row in rows:
                block = bytes(row[_BLOCK])
                if gone:
                    yield told(UNDATED if end == never else LATE, block)
                    continue
                fresh = True
                if row[_COUNT] < few:
                    single.extend(zip(*[c.to_pylist() for c in read(block).columns]))
                    if len(single) >= most:
                        self.held.appendList(single)
                        single = []
                else:
                    blocks.append((block,))
                    size += len(block)
                    if size >= at_once:
                        self.blocks.appendList(blocks)
                        blocks, size = [], 0
            if single:
                self.held.appendList(single)
            if blocks:
                self.blocks.appendList(blocks)
            if fresh:
                self.handle.registerTimer(end)  # the same one however often

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            import pyarrow.compute  # noqa: F401

            tables = [read(bytes(block)) for (block,) in self.blocks.get()]
            single = [tuple(v) for v in self.held.get()]
            if single:
                tables.append(pa.Table.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*single), arrow.types)], schema=arrow))
            self.held.clear()
            self.blocks.clear()
            table = pa.concat_tables(tables)
            # Nulls first, as Spark sorts.
            table = table.take(pa.compute.sort_indices(
                table, sort_keys=[(n, "ascending") for n in order], null_placement="at_start"))
            for at in range(0, table.num_rows, most):
                yield told(IN_ORDER, write(table.slice(at, most).combine_chunks()))

        def close(self) -> None:
            pass

    return SliceBuffer()


def in_order(stream: DataFrame, series: Sequence[str], *, ts: str = "date",
             order: Sequence[str] = (), lateness: str = "1 hour",
             slice_seconds: int = 900, buckets: int = 16) -> DataFrame:
    """``stream`` with a column ``kind``; slices leave whole, their readings by
    series in order of (``ts``, *``order``). A key of the state is a slice of one
    of ``buckets`` of the series: more buckets spread a slice over more tasks,
    fewer make fewer calls. Start it with ``runner.start(conf=STORE)``."""
    plain = _plain(stream.schema)
    slice_ms = slice_seconds * 1000
    seconds = F.floor(F.col(ts) / F.lit(slice_seconds * 1_000_000)) + 1
    # The watermark follows ``ts``; what goes on is its number, which carries no
    # watermark, so that late readings reach the buffer instead of being dropped.
    rows = (stream.withWatermark(ts, lateness).select(*_to_plain(stream))
            .withColumn(_BUCKET, F.pmod(F.xxhash64(*series), F.lit(buckets)).cast("int"))
            .withColumn(_SLICE_END, F.coalesce((seconds * F.lit(slice_ms)).cast("long"),
                                               F.lit(_NEVER).cast("long"))))
    arrow = _arrow(stream.sparkSession, plain)
    blocks = rows.mapInArrow(
        packer(arrow), f"{_BUCKET} int, {_SLICE_END} long, {_COUNT} int, {_BLOCK} binary")
    told = blocks.groupBy(_BUCKET, _SLICE_END).transformWithState(
        slice_buffer(plain, arrow, [*series, ts, *order]), f"{KIND} string, {_BLOCK} binary",
        "append", "eventTime")
    return unpacked(told, plain).select(*_from_plain(stream.schema), KIND)


def held_rows(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The readings a stopped query holds, from its checkpoint."""
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(
            checkpoint).select("list_element.*")
    blocks = state(_HELD_BLOCKS).select(F.lit(IN_ORDER).alias(KIND), _BLOCK)
    rows = state(_HELD).unionByName(unpacked(blocks, _plain(schema)).drop(KIND))
    return rows.select(*_from_plain(schema))


def start_in_order(stream: DataFrame, series: Sequence[str], step, *, sink: str, checkpoint: str,
                   ts: str = "date", order: Sequence[str] = (), lateness: str = "1 hour",
                   slice_seconds: int = 900, buckets: int = 16,
                   processing_time: str | None = None) -> StreamingQuery:
    """Run a ``carried`` step on the readings in order; the others are written to
    the table ``aside`` of the sink, as they are."""
    ordered = in_order(stream, series, ts=ts, order=order, lateness=lateness,
                       slice_seconds=slice_seconds, buckets=buckets)

    def split(batch: DataFrame, carry: DataFrame | None) -> dict:
        tables = step(batch.where(F.col(KIND) == IN_ORDER).drop(KIND), carry)
        return {**tables, "aside": batch.where(F.col(KIND) != IN_ORDER)}

    return carried(ordered, split, sink=sink, checkpoint=checkpoint,
                   processing_time=processing_time, conf=STORE)


def run_in_order(stream: DataFrame, series: Sequence[str], step, *, label: str,
                 sink: str | None = None, checkpoint: str | None = None, **how) -> tuple[str, str]:
    """Drain the stream through ``start_in_order``; (sink, checkpoint)."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")
    await_end(start_in_order(stream, series, step, sink=sink, checkpoint=checkpoint, **how))
    return sink, checkpoint


def finished(spark: SparkSession, step, table: str, schema: T.StructType, *, sink: str,
             checkpoint: str) -> DataFrame:
    """``table`` of a drained query as if its feed had ended: what the sink has,
    and what the step makes of the readings still held. Nothing is written, so
    the query can go on later."""
    there = epochs(spark, f"{sink}/carry")
    if not there:
        return step(spark.createDataFrame([], schema), None)[table]
    carry = spark.read.parquet(f"{sink}/carry/{EPOCH}={there[-1]}")
    rest = step(held_rows(spark, checkpoint, schema), carry)[table]
    return spark.read.parquet(f"{sink}/{table}").drop(EPOCH).unionByName(rest)
