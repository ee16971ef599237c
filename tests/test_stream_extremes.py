"""Retractable extremes of running averages: batch results after every epoch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from test_streaming import uncommit_last, write_files
from tramline.operators.extremes import extreme_owners
from tramline.sources.csv import bike_rows, bike_rows_stream
from tramline.streaming.extremes import (
    extremes_after, rounded, run_extremes, side_by_side,
)


def reading(station, hour, bikes, second=0):
    return f"{station},2024-01-08 {hour:02d}:00:{second:02d},x,n,40,1,{bikes},Open,a,,"


def rows_of(df):
    return sorted(map(tuple, df.select("hrs", "which", "value", "owner").collect()), key=str)


def batch(readings):
    avgs = (readings.groupBy(F.hour("time").alias("hrs"), "station_id")
            .agg(F.round(F.avg("available_bikes"), 2).alias("bikes")))
    return rows_of(extreme_owners(avgs, "hrs", "station_id", "bikes"))


def stream_of(spark, src):
    good, _ = bike_rows_stream(spark, src, max_files_per_trigger=1)
    return good.withColumn("hrs", F.hour("time"))


@pytest.mark.parametrize("buckets", [1, 5])
def test_equals_batch_after_every_epoch(spark, tmp_dir, buckets):
    rng = random.Random(3)
    files = [[reading(rng.randrange(12), rng.choice([7, 8, 9]), rng.choice([0, 1, 5, 9, 10]))
              for _ in range(rng.choice([1, 8, 40]))] for _ in range(5)]
    src, sink, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "sink", "ckpt"))
    write_files(src, files)
    run_extremes(stream_of(spark, src), "hrs", "station_id", "available_bikes", label="x",
                 sink=sink, checkpoint=ckpt, buckets=buckets)
    for epoch in range(len(files)):
        so_far = os.path.join(tmp_dir, f"until-{epoch}")
        write_files(so_far, files[:epoch + 1])
        assert rows_of(extremes_after(spark, sink, epoch)) == batch(bike_rows(spark, so_far)[0])
    # A retried epoch, and a restart with more readings.
    uncommit_last(ckpt)
    write_files(src, [[reading(99, 7, 1000), reading(99, 10, 3), reading(98, 10, 3)]], start=20)
    run_extremes(stream_of(spark, src), "hrs", "station_id", "available_bikes", label="x",
                 sink=sink, checkpoint=ckpt, buckets=buckets)
    assert rows_of(extremes_after(spark, sink)) == batch(bike_rows(spark, src)[0])


def test_an_extreme_is_taken_back(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[reading(1, 7, 2), reading(2, 7, 4), reading(3, 7, 4)],
                      [reading(1, 7, 12)],                      # 1 rises from 2 to 7
                      [reading(1, 7, 1), reading(1, 7, 1)]])    # and falls to 4: a tie of all
    sink = run_extremes(stream_of(spark, src), "hrs", "station_id", "available_bikes", label="back")
    held = [rows_of(extremes_after(spark, sink, e)) for e in range(3)]
    assert held[0] == [(7, "max", 4.0, 2), (7, "max", 4.0, 3), (7, "min", 2.0, 1)]
    assert held[1] == [(7, "max", 7.0, 1), (7, "min", 4.0, 2), (7, "min", 4.0, 3)]
    assert held[2] == [(7, w, 4.0, s) for w in ("max", "min") for s in (1, 2, 3)]
    assert side_by_side(extremes_after(spark, sink), "hrs").count() == 9


def test_nulls_and_fine_averages(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_files(src, [[reading(1, 7, 2), reading(2, 7, 1), reading(2, 7, 2), reading(2, 7, 2)]])
    bare = stream_of(spark, src).withColumn(
        "available_bikes", F.when(F.col("station_id") == 2, F.col("available_bikes"))).withColumn(
        "hrs", F.lit(None).cast("int"))
    sink = run_extremes(bare, "hrs", "station_id", "available_bikes", label="null")
    # Station 1 has readings but no value.
    assert rows_of(extremes_after(spark, sink)) == [(None, "max", 1.67, 2), (None, "min", 1.67, 2)]


def test_rounds_as_spark(spark):
    rng = random.Random(1)
    pairs = [(float(rng.randrange(10_000)), rng.choice([1, 3, 7, 8, 16, 40, 64, 200, 800]))
             for _ in range(2000)]
    df = spark.createDataFrame(pairs, "t double, n int").select("t", "n", F.round(F.col("t") / F.col("n"), 2))
    assert all(rounded(t, n, 2) == v for t, n, v in df.collect())
