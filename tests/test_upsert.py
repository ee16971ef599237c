"""The compacting sink: one answer, few folders to read, crashes at any point."""

import os

import pytest
from pyspark.sql.utils import StreamingQueryException

from test_streaming import line, uncommit_last, write_files
from tramline.sources.csv import bus_rows_stream
from tramline.streaming import forms, upsert
from tramline.streaming.runner import epochs, flatten_window
from tramline.streaming.upsert import UpsertSink, run_upsert

KEYS = ["window_start", "window_end"]


def feed(folder, n, start=0):
    # Every file has a reading of the first hour and one of its own.
    write_files(folder, [[line("2024-01-08 00:00:10"), line(f"2024-01-08 {i % 24:02d}:30:00")]
                         for i in range(start, start + n)], start=start)


def hourly(spark, src):
    stream, _ = bus_rows_stream(spark, src, max_files_per_trigger=1)
    return flatten_window(forms.windowed_counts(stream, width="1 hour", delay="2 days"))


def counted(sink):
    return {r.window_start.hour: r.n for r in sink.table().collect()}


def want(n):
    out = {}
    for i in range(n):
        for h in (0, i % 24):
            out[h] = out.get(h, 0) + 1
    return out


def test_folders_stay_few(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    done = 0
    for stop in (5, 11):
        feed(src, stop - done, done)
        done = stop
        table = run_upsert(hourly(spark, src), KEYS, sink=sink, checkpoint=ckpt, every=3)
        assert counted(table) == want(stop)
        base, deltas = table.parts()
        assert len(base) == 1 and len(deltas) < 3
        # The last compaction's own parts are still there, older ones are not.
        assert len(epochs(spark, f"{sink}/delta")) <= 3 + 3
        assert len(epochs(spark, f"{sink}/base")) <= 2


@pytest.mark.parametrize("broken", ["switch", "drop_epochs"])
def test_crash_around_the_switch(spark, tmp_dir, monkeypatch, broken):
    """The base is written, and the manifest not; or both, and nothing removed."""
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    feed(src, 7)

    def fail(*args, **kwargs):
        raise RuntimeError("the driver dies here")
    with monkeypatch.context() as m:
        m.setattr(upsert, broken, fail)
        with pytest.raises(StreamingQueryException, match="dies here"):
            run_upsert(hourly(spark, src), KEYS, sink=sink, checkpoint=ckpt, every=3)
    stream = hourly(spark, src)
    half = UpsertSink(spark, sink, KEYS, stream.schema, every=3)
    assert counted(half) == want(3)
    table = run_upsert(stream, KEYS, sink=sink, checkpoint=ckpt, every=3)
    assert counted(table) == want(7)
    # An epoch that was not committed runs again.
    uncommit_last(ckpt)
    assert counted(run_upsert(hourly(spark, src), KEYS, sink=sink, checkpoint=ckpt, every=3)) == want(7)


def test_empty_sink(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    table = run_upsert(hourly(spark, src), KEYS, sink=os.path.join(tmp_dir, "sink"))
    assert table.table().count() == 0
