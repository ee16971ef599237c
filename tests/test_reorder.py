"""Reorder buffer: disordered feeds give the batch answer, nothing is lost."""

import os

import pytest
from pyspark.sql import functions as F

from test_streaming import line, uncommit_last, write_files
from tramline.sources.csv import bus_rows_stream, split_bus_lines
from tramline.sources.staging import FEED_FILES, write_feed
from tramline.sources.tables import telemetry
from tramline.streaming import forms
from tramline.streaming.reorder import STORE, finished, held_rows, in_order, run_in_order
from tramline.streaming.runner import await_end, start
from conftest import SF_SMALL

SERIES = ["vehicleID", "busLineID"]
STEP = forms.change_points_step(width="1 day")
COLS = ["window_start", "vehicleID", "busLineID", "date", "closerStopID", "delay"]


def rows_of(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def jitter(seconds):
    return F.pmod(F.xxhash64("reading_id"), F.lit(seconds))


@pytest.mark.parametrize("parts, slice_seconds", [(1, 900), (5, 900), (5, 7200)])
def test_disordered_feed_gives_the_batch_answer(spark, tmp_dir, parts, slice_seconds):
    src = os.path.join(tmp_dir, "src")
    rows = telemetry(spark, SF_SMALL).drop("day")
    write_feed(rows, src, parts=parts, delay_seconds=jitter(3600))
    stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=FEED_FILES)
    sink, ckpt = run_in_order(stream, SERIES, STEP, label="disordered", lateness="1 hour",
                              slice_seconds=slice_seconds)
    want = rows_of(STEP(rows, None)["changes"], COLS)
    got = finished(spark, STEP, "changes", stream.schema, sink=sink, checkpoint=ckpt)
    assert rows_of(got, COLS) == want and len(want) > 100
    assert spark.read.parquet(f"{sink}/aside").count() == 0
    # What has been told before the end is final: a part of the batch answer.
    told = rows_of(spark.read.parquet(f"{sink}/changes"), COLS)
    assert 0 < len(told) < len(want) and set(told) < set(want)


def feed(tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [
        [line("2024-01-08 07:00:00", stop=1), line("2024-01-08 07:50:00", stop=4)],
        [line("2024-01-08 07:20:00", stop=2), line("2024-01-08 07:10:00", stop=1),
         line("2024-01-08 07:20:00", stop=2)],
        [line("2024-01-08 09:00:00", stop=5)],
        [line("2024-01-08 07:05:00", stop=9), line("2024-01-08 07:59:59", stop=9),
         line("2024-01-08 08:00:00", stop=6)]])
    return src


def test_late_readings_are_kept(spark, tmp_dir):
    src = feed(tmp_dir)
    stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=1)
    sink, ckpt = run_in_order(stream, SERIES, STEP, label="late", lateness="1 hour",
                              slice_seconds=600)
    aside = spark.read.parquet(f"{sink}/aside")
    # Before the last file the watermark is at 08:00.
    assert sorted((r.date.strftime("%H:%M:%S"), r.kind, r.closerStopID)
                  for r in aside.collect()) == [("07:05:00", "late", 9), ("07:59:59", "late", 9)]
    stops = finished(spark, STEP, "changes", stream.schema, sink=sink, checkpoint=ckpt)
    assert [r.closerStopID for r in stops.orderBy("date").collect()] == [1, 2, 4, 6, 5]
    held = held_rows(spark, ckpt, stream.schema)
    assert sorted(r.date.strftime("%H:%M") for r in held.collect()) == ["08:00", "09:00"]


def test_restart_and_retried_epoch(spark, tmp_dir):
    """Held readings, and the carry, survive a stop and an epoch run twice."""
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    rows = telemetry(spark, SF_SMALL).drop("day")
    half = F.lit("2024-01-15").cast("timestamp")

    def go():
        stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=FEED_FILES)
        run_in_order(stream, SERIES, STEP, label="restart", sink=sink, checkpoint=ckpt)
        return stream.schema
    write_feed(rows.where(F.col("date") < half), src, parts=2, delay_seconds=jitter(3000))
    go()
    uncommit_last(ckpt)
    write_feed(rows.where(F.col("date") >= half), src, parts=2, delay_seconds=jitter(3000))
    schema = go()
    got = finished(spark, STEP, "changes", schema, sink=sink, checkpoint=ckpt)
    assert rows_of(got, COLS) == rows_of(STEP(rows, None)["changes"], COLS)


def test_nulls_and_an_empty_feed(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    stream, _ = bus_rows_stream(spark, src)
    sink, ckpt = run_in_order(stream, SERIES, STEP, label="empty")
    assert finished(spark, STEP, "changes", stream.schema, sink=sink, checkpoint=ckpt).count() == 0
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:10:00", stop=2)]])
    undated = stream.withColumn("date", F.when(F.col("closerStopID") == 1, F.col("date"))).withColumn(
        "busLineID", F.lit(None).cast("int"))
    sink, ckpt = run_in_order(undated, SERIES, STEP, label="nulls")
    aside = spark.read.parquet(f"{sink}/aside").collect()
    assert [(r.kind, r.date, r.closerStopID, r.busLineID) for r in aside] == [
        ("undated", None, 2, None)]
    got = finished(spark, STEP, "changes", undated.schema, sink=sink, checkpoint=ckpt)
    assert [(r.closerStopID, r.busLineID) for r in got.collect()] == [(1, None)]


def test_a_hot_series_is_many_keys(spark, tmp_dir):
    """One vehicle with all readings: its slices are dealt over the partitions."""
    src = os.path.join(tmp_dir, "src")
    lines = [line(f"2024-01-08 {h:02d}:{m:02d}:00", stop=m % 7) for h in range(24) for m in range(60)]
    write_files(src, [lines])
    stream, _ = bus_rows_stream(spark, src)
    sink, ckpt = run_in_order(stream, SERIES, STEP, label="hot", slice_seconds=900)
    state = (spark.read.format("statestore").option("stateVarName", "held").load(ckpt))
    spread = state.groupBy("partition_id").count().collect()
    assert len(spread) > 1
    # 23:59 less an hour is the watermark: later slices are held.
    assert state.count() == 60 + 15 - 1 + 1 or state.count() >= 60
    got = finished(spark, STEP, "changes", stream.schema, sink=sink, checkpoint=ckpt)
    assert got.count() == 24 * 60 - sum(1 for h in range(24) for m in range(60)
                                        if (h, m) > (0, 0) and m % 7 == ((m - 1) % 60) % 7)


def test_readings_are_held_in_blocks(spark, tmp_dir):
    """Calls of the state grow with blocks: many readings of a slice are one element,
    few are held one by one, and together they leave in order, nulls first."""
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    many = [line(f"2024-01-08 {7 + i % 2:02d}:{i * 7 % 60:02d}:{i * 11 % 60:02d}", stop=i % 5)
            for i in range(200)]
    few = [line("2024-01-08 06:00:00", stop=3), line("2024-01-08 07:30:00", stop=0),
           line("2024-01-08 09:00:00", stop=1)]
    last = [line(f"2024-01-11 07:{i % 60:02d}:00", stop=i % 5) for i in range(100)]
    write_files(src, [many, few, last])
    stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=1)
    stream = stream.withColumn("busLineID", F.when(F.col("closerStopID") != 3, F.col("busLineID")))
    ordered = in_order(stream, SERIES, slice_seconds=86400, buckets=1)
    await_end(start(ordered, sink=sink, checkpoint=ckpt, conf=STORE))
    cols = ["vehicleID", "busLineID", "date", "closerStopID"]
    told = spark.read.parquet(sink)
    out = [tuple(r) for r in told.select(*cols).collect()]
    assert out == sorted(out, key=lambda r: [(x is not None, x) for x in r[:3]])
    assert len(out) == 203 and {r.kind for r in told.collect()} == {"in_order"}
    got = told.drop("kind").unionByName(held_rows(spark, ckpt, stream.schema))
    want, _ = split_bus_lines(spark.read.text(src))
    want = want.withColumn("busLineID", F.when(F.col("closerStopID") != 3, F.col("busLineID")))
    assert rows_of(got, want.columns) == rows_of(want, want.columns)

    def state(name):
        return spark.read.format("statestore").option("stateVarName", name).load(ckpt)
    assert state("held_blocks").count() == 1 and state("held").count() == 0
