"""Streaming behaviour: window emission, late rows, restart, stream = batch."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pyspark.sql.utils import StreamingQueryException

from tramline.operators import bucket_histogram, path_distance
from tramline.sources.csv import bus_lines, bus_rows_stream, read_bus_csv_stream, typed
from tramline.sources.staging import FEED_FILES, write_feed
from tramline.sources.tables import telemetry
from tramline.streaming import forms
from tramline.streaming.runner import (
    await_end, epochs, flatten_window, latest_rows, rows_dropped_by_watermark, run, run_carried,
    run_latest, run_per_batch, start,
)
from tramline.streaming.state import histogram_per_batch, latest_histogram, path_distance_state
from conftest import SF_SMALL


def line(ts: str, stop: int = 1, vehicle: int = 1) -> str:
    return f"{ts},1,p,0,-6.25,53.35,0,{vehicle},{stop},1"


def write_files(folder: str, groups, start: int = 0):
    """One file per group of lines, with strictly increasing mtimes."""
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for i, lines in enumerate(groups, start=start):
        path = os.path.join(folder, f"part-{i:03d}.csv")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (now + i, now + i))


def counts(spark, folder, *, width, delay="0 seconds", mode="append", per_trigger=None,
           sink=None, checkpoint=None):
    stream = typed(read_bus_csv_stream(spark, folder, max_files_per_trigger=per_trigger))
    agg = flatten_window(forms.windowed_counts(stream, width=width, delay=delay))
    table, query = run(agg, mode=mode, sink=sink, checkpoint=checkpoint)
    if mode == "update":
        table = latest_rows(table, ["window_start", "window_end"])
    rows = sorted((r.window_start.strftime("%H:%M:%S"), r.n) for r in table.collect())
    return rows, query


def test_append_keeps_last_window_open_update_does_not(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:00:02"),
                       line("2024-01-08 07:00:04")]])
    appended, _ = counts(spark, src, width="2 seconds")
    assert appended == [("07:00:00", 1), ("07:00:02", 1)]
    updated, _ = counts(spark, src, width="2 seconds", mode="update")
    assert updated == [("07:00:00", 1), ("07:00:02", 1), ("07:00:04", 1)]


@pytest.mark.parametrize("delay,expected,dropped", [
    ("0 seconds", [("07:00:00", 1), ("07:00:20", 2)], 1),
    ("30 seconds", [("07:00:00", 2)], 0),
])
def test_late_rows(spark, tmp_dir, delay, expected, dropped):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line(f"2024-01-08 07:00:{s}")] for s in ("00", "20", "25", "01", "40")])
    got, query = counts(spark, src, width="10 seconds", delay=delay, per_trigger=1)
    assert got == expected
    assert rows_dropped_by_watermark(query) == dropped


def test_restart_on_same_checkpoint(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:00:05")]])
    first, _ = counts(spark, src, width="10 seconds", sink=sink, checkpoint=ckpt)
    assert first == []
    write_files(src, [[line("2024-01-08 07:00:12"), line("2024-01-08 07:00:31")]], start=1)
    second, _ = counts(spark, src, width="10 seconds", sink=sink, checkpoint=ckpt)
    assert second == [("07:00:00", 2), ("07:00:10", 1)]


def _stage_in_time_order(spark, folder, k):
    """Telemetry (sf0.001) as k CSV files of consecutive time ranges."""
    rows = telemetry(spark, SF_SMALL)
    bounds = rows.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    lo, hi = bounds.lo.timestamp(), bounds.hi.timestamp() + 1
    edges = [lo + (hi - lo) * i / k for i in range(k + 1)]
    for i in range(k):
        part = rows.where((F.unix_micros("date") >= int(edges[i] * 1e6))
                          & (F.unix_micros("date") < int(edges[i + 1] * 1e6)))
        bus_lines(part).coalesce(1).write.mode("append").text(folder)
        time.sleep(0.05)
    return rows


@pytest.mark.parametrize("k", [1, 4])
def test_congestion_stream_equals_batch(spark, tmp_dir, k):
    src = os.path.join(tmp_dir, "src")
    rows = _stage_in_time_order(spark, src, k)
    stream = typed(read_bus_csv_stream(spark, src, max_files_per_trigger=1))
    table, _ = run(flatten_window(forms.congestion_windows(stream, width="1 day")))
    batch = flatten_window(forms.congestion_windows(rows, width="1 day"))
    picked_max = rows.where(
        F.col("latitude").between(53.3343619, 53.3702027)
        & F.col("longitude").between(-6.2886331, -6.2043634)
        & (F.weekday("date") < 5) & F.hour("date").isin(7, 8, 9)).agg(F.max("date")).first()[0]
    batch = batch.where(F.col("window_end") <= F.lit(picked_max).cast("timestamp_ntz"))
    key = ["window_start", "hour"]
    assert sorted(map(tuple, table.orderBy(key).collect())) == \
        sorted(map(tuple, batch.select(*table.columns).orderBy(key).collect()))


@pytest.mark.parametrize("k", [1, 3])
def test_path_state_equals_batch(spark, tmp_dir, k):
    src = os.path.join(tmp_dir, "src")
    rows = _stage_in_time_order(spark, src, k)
    stream = typed(read_bus_csv_stream(spark, src, max_files_per_trigger=1))
    table, _ = run(path_distance_state(stream, max_speed=28.0), mode="update")
    got = {r.vehicleID: round(r.km, 6) for r in latest_rows(table, ["vehicleID"]).collect()}
    # The stream orders ties in time by position; the batch uses the same order.
    ordered = rows.withColumn("tb", F.struct("latitude", "longitude"))
    batch = path_distance(ordered, "vehicleID", "date", "tb", "latitude", "longitude",
                          max_speed=28.0)
    want = {r.vehicleID: round(r.km, 6) for r in batch.collect()}
    assert got == want


def _feed(spark, folder, parts):
    """Telemetry (sf0.001) staged as the registered streams stage it."""
    rows = telemetry(spark, SF_SMALL).drop("day")
    write_feed(rows, folder, parts=parts)
    stream, _ = bus_rows_stream(spark, folder, max_files_per_trigger=FEED_FILES)
    return rows, stream


def _rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


FORMS = {   # form, and the keys of its rows
    "counts": (lambda df: forms.windowed_counts(df, width="2 hours", slide="1 hour",
                                                delay="1 hour"), []),
    "congestion": (lambda df: forms.congestion_windows(df, width="1 day", delay="1 hour"),
                   ["hour"]),
    "vehicles_per_stop": (lambda df: forms.vehicles_per_stop_windows(
        df, start="2024-01-02 00:00:00", horizon=5 * 86400, width="6 hours", delay="1 hour"),
        ["stationID"]),
}


@pytest.mark.parametrize("k", [1, 4])
@pytest.mark.parametrize("form", sorted(FORMS))
def test_every_window_whatever_the_triggers(spark, tmp_dir, form, k):
    build, keys = FORMS[form]
    rows, stream = _feed(spark, os.path.join(tmp_dir, "src"), k)
    table, query = run_latest(flatten_window(build(stream)),
                              ["window_start", "window_end", *keys])
    assert query.lastProgress.batchId >= k - 1
    assert rows_dropped_by_watermark(query) == 0
    batch = flatten_window(build(rows))
    assert table.count() > 0
    assert _rows(table, table.columns) == _rows(batch, table.columns)


@pytest.mark.parametrize("k", [1, 4])
def test_busiest_whatever_the_triggers(spark, tmp_dir, k):
    rows, stream = _feed(spark, os.path.join(tmp_dir, "src"), k)
    table, _ = run(flatten_window(forms.vehicles_at_stops_windows(stream, width="6 hours")),
                   mode="update")
    got = forms.busiest_of_windows(table.drop("epoch_id").distinct())
    pairs = flatten_window(forms.vehicles_at_stops_windows(rows, width="6 hours"))
    assert _rows(got, got.columns) == _rows(forms.busiest_of_windows(pairs), got.columns)


@pytest.mark.parametrize("slide", [None, "6 hours"])
@pytest.mark.parametrize("k", [1, 4])
def test_change_points_whatever_the_triggers(spark, tmp_dir, k, slide):
    rows, stream = _feed(spark, os.path.join(tmp_dir, "src"), k)
    step = forms.change_points_step(width="1 day", slide=slide)
    sink = run_carried(stream, step, label="changes")
    want = step(rows, None)["changes"]
    got = spark.read.parquet(f"{sink}/changes")
    assert got.count() > 100
    assert _rows(got, want.columns) == _rows(want, want.columns)
    assert spark.read.parquet(f"{sink}/late").agg(F.sum("late_rows")).first()[0] == 0


def test_change_points_of_a_hot_series(spark):
    """A third of all readings in one series: no task sorts all of them."""
    rows = (spark.range(30_000).select(
        F.timestamp_seconds(F.lit(1704672000) + F.col("id") * 2).alias("date"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int")
        .alias("vehicleID"), F.lit(1).alias("busLineID"), F.lit(1).alias("atStop"),
        (F.col("id") % 7).cast("int").alias("closerStopID"), F.lit(0).alias("delay")))
    changes = forms.change_points_step(width="1 day")(rows, None)["changes"]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan and "collect_list" not in plan
    assert changes.where("vehicleID = 1").count() > 9_000


def test_late_readings_of_change_points(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:00:00", stop=1), line("2024-01-08 07:30:00", stop=2)],
                      [line("2024-01-08 07:10:00", stop=5), line("2024-01-08 07:40:00", stop=2)],
                      [line("2024-01-09 07:00:00", stop=2)], [line("2024-01-08 08:00:00", stop=9)]])
    stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=1)
    sink = run_carried(stream, forms.change_points_step(width="1 day"), label="late")
    got = spark.read.parquet(f"{sink}/changes")
    assert sorted(r.closerStopID for r in got.collect()) == [1, 2, 2]
    assert spark.read.parquet(f"{sink}/late").agg(F.sum("late_rows")).first()[0] == 2


def test_path_state_counts_late_readings(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [
        [line("2024-01-08 07:00:00").replace("-6.25,53.35", "-6.25,53.35"),
         line("2024-01-08 07:01:40").replace("-6.25,53.35", "-6.25,53.36")],
        [line("2024-01-08 07:00:50").replace("-6.25,53.35", "-6.25,53.40")],   # late
        [line("2024-01-08 07:03:20").replace("-6.25,53.35", "-6.25,53.35")],
    ])
    stream = typed(read_bus_csv_stream(spark, src, max_files_per_trigger=1))
    table, _ = run(path_distance_state(stream, max_speed=28.0), mode="update")
    row = latest_rows(table, ["vehicleID"]).collect()[0]
    assert row.late_rows == 1
    assert row.km == pytest.approx(2 * 1.1119508, abs=1e-6)


def test_live_trigger_and_per_batch(spark, tmp_dir):
    from tramline.streaming.runner import read_sink, run_per_batch, start
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:00:05")],
                      [line("2024-01-08 07:00:12")]])
    stream = typed(read_bus_csv_stream(spark, src))
    agg = flatten_window(forms.windowed_counts(stream, width="10 seconds"))
    query = start(agg, mode="complete", sink=sink, checkpoint=ckpt, processing_time="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted((r.window_start.strftime("%H:%M:%S"), r.n)
                 for r in read_sink(spark, sink, agg.schema, mode="complete").collect())
    assert got == [("07:00:00", 2), ("07:00:10", 1)]

    per_file = typed(read_bus_csv_stream(spark, src, max_files_per_trigger=1))
    out = run_per_batch(per_file, lambda b: b.groupBy().count())
    assert sorted((r.batch_id, r["count"]) for r in out.collect()) == [(0, 2), (1, 1)]


@pytest.mark.parametrize("k", [1, 4])
def test_histogram_per_batch_equals_batch(spark, tmp_dir, k):
    sink, ckpt = (os.path.join(tmp_dir, p) for p in ("sink", "ckpt"))
    rows, stream = _feed(spark, os.path.join(tmp_dir, "src"), k)
    await_end(histogram_per_batch(stream, max_speed=28.0, size=50, sink=sink, checkpoint=ckpt))
    ordered = rows.withColumn("tb", F.struct("latitude", "longitude"))
    km = path_distance(ordered, "vehicleID", "date", "tb", "latitude", "longitude", max_speed=28.0)
    want = bucket_histogram(km, "km", 50, count="numVehicles")
    got = latest_histogram(spark, sink)
    assert _rows(got, want.columns) == _rows(want, want.columns)
    last = max(epochs(spark, f"{sink}/histogram"))
    totals = {r.vehicleID: r for r in spark.read.parquet(f"{sink}/carry/epoch_id={last}").collect()}
    assert {v: round(r.metres / 1000, 6) for v, r in totals.items()} == \
        {r.vehicleID: round(r.km, 6) for r in km.collect()}
    assert all(r.late_rows == 0 for r in totals.values())
    # a histogram for each trigger; old totals are removed
    assert len(epochs(spark, f"{sink}/histogram")) == k
    assert len(epochs(spark, f"{sink}/carry")) <= 2


def test_totals_restart_and_wrong_sink(spark, tmp_dir):
    """A restart goes on with the totals; with another sink it fails loudly."""
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))

    def go(to):
        stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=1)
        await_end(histogram_per_batch(stream, max_speed=28.0, size=1, sink=to, checkpoint=ckpt))

    write_files(src, [[line("2024-01-08 07:00:00", vehicle=1)],
                      [line("2024-01-08 07:00:30", vehicle=2)]])
    go(sink)
    write_files(src, [[line("2024-01-08 07:00:40", vehicle=2),
                       line("2024-01-08 06:00:00", vehicle=1)]], start=5)
    go(sink)
    assert [r.numVehicles for r in latest_histogram(spark, sink).collect()] == [2]
    carry = spark.read.parquet(f"{sink}/carry/epoch_id=2")
    assert {r.vehicleID: r.late_rows for r in carry.collect()} == {1: 1, 2: 0}
    write_files(src, [[line("2024-01-08 07:00:50", vehicle=2)]], start=9)
    with pytest.raises(StreamingQueryException, match="not the sink"):
        go(os.path.join(tmp_dir, "other"))


CARRIED = {
    "changes": (forms.change_points_step(width="1 day"), "changes"),
    "arrivals": (forms.change_points_step(width="2 hours", slide="1 hour",
                                          partition=("busLineID",)), "changes"),
}


def uncommit_last(checkpoint: str) -> int:
    """Undo the commit of the last epoch, as if the driver had died before it."""
    commits = os.path.join(checkpoint, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    return last


@pytest.mark.parametrize("name", sorted(CARRIED))
def test_retried_epoch_of_a_carried_stream(spark, tmp_dir, name):
    """An epoch that wrote its tables but was not committed runs again, from the
    carry of the epoch before, and changes nothing."""
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    step, table = CARRIED[name]
    rows, stream = _feed(spark, src, 3)
    run_carried(stream, step, label="retry", sink=sink, checkpoint=ckpt)
    want = _rows(step(rows, None)[table], step(rows, None)[table].columns)
    for _ in range(2):
        last = uncommit_last(ckpt)
        assert epochs(spark, f"{sink}/carry") == [last - 1, last]
        run_carried(stream, step, label="retry", sink=sink, checkpoint=ckpt)
        got = spark.read.parquet(f"{sink}/{table}").drop("epoch_id")
        assert _rows(got, step(rows, None)[table].columns) == want


def test_retried_epoch_of_the_histogram(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    _, stream = _feed(spark, src, 3)

    def go():
        await_end(histogram_per_batch(stream, max_speed=28.0, size=50, sink=sink, checkpoint=ckpt))
        table = latest_histogram(spark, sink)
        return _rows(table, table.columns)
    want = go()
    for _ in range(2):
        last = uncommit_last(ckpt)
        assert go() == want and epochs(spark, f"{sink}/carry") == [last - 1, last]


def test_null_keys_and_places_do_not_stop_the_path_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:00:05").replace(",1,1,1", ",x,1,1"),
                       line("2024-01-08 07:00:10").replace("53.35", ""), line("2024-01-08 07:01:40")]])
    raw = typed(read_bus_csv_stream(spark, src))
    table, _ = run(path_distance_state(raw, max_speed=28.0), mode="update")
    assert [r.vehicleID for r in latest_rows(table, ["vehicleID"]).collect()] == [1]
    sink = os.path.join(tmp_dir, "sink")
    await_end(histogram_per_batch(raw, max_speed=28.0, size=1, sink=sink,
                                  checkpoint=os.path.join(tmp_dir, "ckpt")))
    assert [r.numVehicles for r in latest_histogram(spark, sink).collect()] == [1]


def test_complete_mode_keeps_whole_epochs(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    write_files(src, [[line("2024-01-08 07:00:00")], [line("2024-01-08 07:00:05", vehicle=2)],
                      [line("2024-01-08 07:00:06", vehicle=2)]])
    stream = typed(read_bus_csv_stream(spark, src, max_files_per_trigger=1))
    out = forms.running_totals(stream, key="vehicleID", value="closerStopID")
    table, _ = run(out, mode="complete", sink=sink, checkpoint=ckpt)
    assert sorted(map(tuple, table.collect())) == [(1, 1), (2, 2)]
    assert len(epochs(spark, sink)) == 2


def test_per_batch_of_an_empty_source(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    stream = typed(read_bus_csv_stream(spark, src))
    out = run_per_batch(stream, lambda b: b.groupBy("vehicleID").count())
    assert out.columns == ["vehicleID", "count", "batch_id"] and out.count() == 0


def test_drops_are_counted_over_many_epochs(spark, tmp_dir):
    """More epochs than a query keeps progress entries."""
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:00:00")], *[
        [line(f"2024-01-08 {8 + i // 30:02d}:{2 * (i % 30):02d}:00"), line("2024-01-08 06:00:00")]
        for i in range(14)]])
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        _, query = counts(spark, src, width="10 seconds", per_trigger=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert len(query.recentProgress) <= 4 and rows_dropped_by_watermark(query) >= 12


ARRIVAL_FORMS = {
    "counts": lambda df: forms.windowed_counts(df, width="1 hour", window_ts="arrival"),
    "arrivals": lambda df: forms.arrivals_sliding(df, vehicle=1, day="2024-01-08", width="2 hours",
                                                  slide="1 hour", window_ts="arrival"),
    "vehicles_at_stops": lambda df: forms.vehicles_at_stops_windows(df, width="1 hour",
                                                                    window_ts="arrival"),
    "vehicles_per_stop": lambda df: forms.vehicles_per_stop_windows(
        df, start="2024-01-08 00:00:00", horizon=86400, width="1 hour", window_ts="arrival"),
}


@pytest.mark.parametrize("form", sorted(ARRIVAL_FORMS))
def test_forms_on_arrival_time(spark, tmp_dir, form):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:10:00"), line("2024-01-08 12:00:00")]])
    stream, _ = bus_rows_stream(spark, src)
    out = flatten_window(ARRIVAL_FORMS[form](stream.withColumn("arrival", F.current_timestamp())))
    table, _ = run(out, mode="update")
    assert table.count() > 0
    assert table.where("window_start < timestamp_ntz'2025-01-01 00:00:00'").isEmpty()


def test_change_points_on_arrival_time(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:10:00"), line("2024-01-08 12:00:00", stop=2)]])
    stream, _ = bus_rows_stream(spark, src)
    sink = run_carried(stream.withColumn("arrival", F.current_timestamp()),
                       forms.change_points_step(width="1 day", window_ts="arrival"), label="arr")
    got = spark.read.parquet(f"{sink}/changes")
    assert got.count() == 2 and got.where("window_start < timestamp'2025-01-01'").isEmpty()


def test_arrival_time_windows(spark, tmp_dir):
    # Windows on arrival time (stamped when a batch is read), hours from the
    # readings' own time: every reading is counted once, in the current window.
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[line("2024-01-08 07:10:00"), line("2024-01-08 08:20:00"),
                       line("2024-01-08 09:30:00"), line("2024-01-08 12:00:00")]])
    stream = typed(read_bus_csv_stream(spark, src)).withColumn("arrival", F.current_timestamp())
    box = {"north": 90.0, "east": 180.0, "south": -90.0, "west": -180.0}
    out = forms.congestion_windows(stream, width="1 hour", box=box, window_ts="arrival")
    table, _ = run(flatten_window(out), mode="complete")
    got = sorted((r.hour, r.numMeasurements) for r in table.collect())
    assert got == [("07", 1), ("08", 1), ("09", 1)]


@pytest.mark.parametrize("given", [None, 3])
def test_state_partitions(spark, tmp_dir, given):
    """The session's shuffle width, or the width given; the session's is kept."""
    import glob
    import json
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    write_files(src, [[line("2024-01-08 07:00:00"), line("2024-01-08 07:00:12")]])
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    stream = typed(read_bus_csv_stream(spark, src))
    agg = flatten_window(forms.windowed_counts(stream, width="10 seconds"))
    await_end(start(agg, sink=sink, checkpoint=ckpt, state_partitions=given))
    assert spark.conf.get(key) == before
    first = sorted(glob.glob(os.path.join(ckpt, "offsets", "0")))[0]
    meta = json.loads(open(first).read().splitlines()[1])
    assert meta["conf"][key] == str(given or before)
