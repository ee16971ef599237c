"""Side tables: same answers as the plain forms, by plans that read or shuffle less."""

import datetime as dt
import os
import random
import uuid

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from test_plans import exchanges, executed
from tramline.functions.predicates import in_box
from tramline.operators import busiest_with_ties, path_distance
from tramline.operators.cells import BITS, cell, cover, in_box_clustered
from tramline.operators.segments import folded, path_distance_folded, segments
from tramline.operators.sketches import (
    busiest_bounded, distinct_sketched, hourly_sketches, may_be_busiest, whole_hours,
)
from tramline.plans import registry
from tramline.plans.transit import CITY_BOX
from tramline.sources.side_tables import CELL, SLICE, store_by_cell, store_by_slice
from tramline.sources.tables import telemetry
from conftest import SF_SMALL

QUERIES = registry.queries()
PATH = ("date", "reading_id", "latitude", "longitude")


def km_of(df):
    return {r.vehicleID: round(r.km, 6) for r in df.collect()}


# ---------------------------------------------------------------- segments

@pytest.mark.parametrize("name", ["path_distance_folded", "path_distance_all_days"])
def test_only_segments_are_shuffled(spark, name):
    """No exchange above the scan but of segments: what aggregates by (vehicle,
    slice) have made of the rows."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        final = executed(QUERIES[name](spark, SF_SMALL)).split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Bucketed: true" in final
    fed = exchanges(final)
    assert fed and all(x in ("HashAggregate", "SortAggregate", "Window") for x in fed), final
    below = final[final.rindex("Exchange"):]
    assert "HashAggregate" in below and "slice" in below and "Window" in below


def test_segments_in_any_slicing(spark, tmp_dir):
    """Folding is associative: slices, and runs of slices, of any width."""
    rows = telemetry(spark, SF_SMALL).drop("day")
    want = km_of(path_distance(rows, "vehicleID", *PATH, max_speed=28.0))
    for seconds in (600, 86_400, 10 ** 9):
        sliced = rows.withColumn(SLICE, F.floor(F.unix_seconds("date") / F.lit(seconds)))
        for coarse in (None, 1, 7):
            assert km_of(path_distance_folded(sliced, "vehicleID", SLICE, *PATH, max_speed=28.0,
                                              coarse_slices=coarse)) == want
    stored = store_by_slice(rows, os.path.join(tmp_dir, uuid.uuid4().hex), seconds=3600, buckets=3)
    assert km_of(path_distance_folded(stored, "vehicleID", SLICE, *PATH, max_speed=28.0)) == want
    whole = folded(segments(stored, ["vehicleID"], SLICE, *PATH, max_speed=28.0), ["vehicleID"],
                   SLICE, "date", "latitude", "longitude", max_speed=28.0)
    counts = {r.vehicleID: r["count"] for r in rows.groupBy("vehicleID").count().collect()}
    assert {r.vehicleID: r.readings for r in whole.collect()} == counts


def test_segments_with_nulls_and_ties(spark):
    base = dt.datetime(2024, 1, 8)
    rng = random.Random(4)
    data = [(i, rng.choice([None, 1, 2]), base + dt.timedelta(seconds=rng.choice([0, 0, 50, 4000])),
             53.3 + rng.random() / 100, -6.2) for i in range(60)]
    rows = spark.createDataFrame(data, "reading_id long, vehicleID int, date timestamp, "
                                       "latitude double, longitude double")
    sliced = rows.withColumn(SLICE, F.floor(F.unix_seconds("date") / F.lit(60)))
    args = {"max_speed": 28.0}
    assert km_of(path_distance_folded(sliced, "vehicleID", SLICE, *PATH, **args)) == km_of(
        path_distance(rows, "vehicleID", *PATH, **args))
    assert path_distance_folded(sliced.limit(0), "vehicleID", SLICE, *PATH, **args).count() == 0


# ---------------------------------------------------------------- cells

BOXES = [CITY_BOX, {"north": 53.36, "south": 53.36, "east": -6.25, "west": -6.25},
         {"north": 90.0, "south": -90.0, "east": 180.0, "west": -180.0},
         {"north": 53.31, "south": 53.3, "east": -6.2, "west": -6.3}]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("most", [4, 32, 200])
def test_cover_holds_the_box(spark, box, most):
    ranges = cover(**box, most=most)
    assert 1 <= len(ranges) <= most
    assert all(a <= b for a, b in ranges) and all(
        x[1] + 1 < y[0] for x, y in zip(ranges, ranges[1:]))
    rng = random.Random(2)
    points = [(rng.uniform(box["south"], box["north"]), rng.uniform(box["west"], box["east"]))
              for _ in range(300)]
    points += [(box[a], box[b]) for a in ("north", "south") for b in ("east", "west")]
    df = spark.createDataFrame(points, "lat double, lon double")
    for r in df.select(cell("lat", "lon").alias("c")).collect():
        assert any(a <= r.c <= b for a, b in ranges)
    # A finer cover has less outside the box.
    area = sum(b - a + 1 for a, b in ranges)
    assert area >= sum(b - a + 1 for a, b in cover(**box, most=200))


def test_cells_are_interleaved_bits(spark):
    rng = random.Random(6)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    got = [r.c for r in spark.createDataFrame(points, "lat double, lon double").coalesce(1).select(
        cell("lat", "lon").alias("c")).collect()]
    top = (1 << BITS) - 1
    for (lat, lon), c in zip(points, got):
        y = min(top, int((lat + 90) / 180 * 2 ** BITS))
        x = min(top, int((lon + 180) / 360 * 2 ** BITS))
        assert c == sum(((x >> k & 1) << 2 * k) | ((y >> k & 1) << 2 * k + 1) for k in range(BITS))


def test_box_reads_fewer_row_groups(spark, tmp_dir):
    rows = spark.range(0, 200_000, 1, 4).select(
        F.col("id").alias("reading_id"),
        (F.lit(53.0) + F.pmod(F.xxhash64("id"), F.lit(6000)) / 10_000).alias("latitude"),
        (F.lit(-6.6) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7000)) / 10_000).alias("longitude"))
    path = store_by_cell(rows, os.path.join(tmp_dir, "cells"), parts=8,
                         **{"parquet.block.size": 65_536, "parquet.page.size": 8_192})
    table = spark.read.parquet(path)
    picked = table.where(in_box_clustered(CELL, "latitude", "longitude", **CITY_BOX))
    want = rows.where(in_box("latitude", "longitude", **CITY_BOX))
    assert sorted(r.reading_id for r in picked.collect()) == sorted(
        r.reading_id for r in want.collect())
    plan = picked._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "Or(" in pushed and "And(GreaterThanOrEqu" in pushed
    ranges = cover(**CITY_BOX)
    met = groups = 0
    for fragment in ds.dataset(path).get_fragments():
        for group in fragment.row_groups:
            stats = group.statistics[CELL]
            groups += 1
            met += any(a <= stats["max"] and b >= stats["min"] for a, b in ranges)
    assert groups >= 8 and met <= groups / 2
    # What the scan itself has read.
    scanned = read_by_scan(picked)
    assert scanned < 100_000


def read_by_scan(df) -> int:
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    nodes = [node]
    while nodes:
        node = nodes.pop()
        if "Scan parquet" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        kids = node.children()
        nodes += [kids.apply(i) for i in range(kids.size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
    raise AssertionError("no scan")


def test_places_without_coordinates(spark, tmp_dir):
    rows = spark.createDataFrame([(1, None, -6.25), (2, 53.35, None), (3, 53.35, -6.25)],
                                 "reading_id int, latitude double, longitude double")
    table = spark.read.parquet(store_by_cell(rows, os.path.join(tmp_dir, "c"), parts=1))
    got = table.where(in_box_clustered(CELL, "latitude", "longitude", **CITY_BOX)).collect()
    assert [r.reading_id for r in got] == [3] and table.count() == 3


# ---------------------------------------------------------------- sketches

HORIZONS = [("2024-01-08 06:00:00", 21_600), ("2024-01-08 06:20:30", 21_600),
            ("2024-01-08 06:20:00", 600), ("2024-01-01 00:00:00", 30 * 86_400)]


@pytest.mark.parametrize("start, seconds", HORIZONS)
def test_sketches_of_any_horizon(spark, start, seconds):
    rows = telemetry(spark, SF_SMALL).where("atStop = 1")
    side = hourly_sketches(rows, "closerStopID", "vehicleID")
    end = F.lit(start).cast("timestamp") + F.make_dt_interval(secs=F.lit(seconds))
    picked = rows.where(F.col("date").between(F.lit(start).cast("timestamp"), end))
    want = {r.closerStopID: r.n for r in picked.groupBy("closerStopID").agg(
        F.count_distinct("vehicleID").alias("n")).collect()}
    got = distinct_sketched(side, "closerStopID", start=start, seconds=seconds, readings=rows,
                            member="vehicleID")
    assert {r.closerStopID: r.n for r in got.collect()} == want   # small sets are exact
    best = busiest_bounded(picked, side, "closerStopID", "vehicleID", start=start, seconds=seconds)
    plain = busiest_with_ties(picked, "closerStopID", "vehicleID")
    assert sorted(map(tuple, best.select(*plain.columns).collect())) == sorted(
        map(tuple, plain.collect()))


def test_sketches_within_their_error(spark):
    rows = spark.range(200_000).select(
        F.timestamp_seconds(F.lit(1704672000) + F.col("id") % 36_000).alias("date"),
        (F.col("id") % 3).alias("g"), (F.col("id") * 7 % 50_021).alias("m"))
    side = hourly_sketches(rows, "g", "m")
    got = distinct_sketched(side, "g", start="2024-01-08 00:00:00", seconds=36_000)
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("m").alias("n")).collect()}
    for r in got.collect():   # 1.6 % standard error: four of them
        assert abs(r.n - want[r.g]) <= 0.065 * want[r.g]


def test_hopeless_groups_are_dropped(spark):
    """One group has 500 members in one hour; hundreds have a few each."""
    rows = spark.range(20_000).select(
        F.timestamp_seconds(F.lit(1704672000) + F.col("id") % 7200).alias("date"),
        F.when(F.col("id") < 4000, 0).otherwise(1 + F.col("id") % 700).alias("g"),
        F.when(F.col("id") < 4000, F.col("id") % 500).otherwise(F.col("id") % 3).alias("m"))
    side = hourly_sketches(rows, "g", "m")
    how = {"start": "2024-01-08 00:00:00", "seconds": 7200}
    assert [r.g for r in may_be_busiest(side, "g", **how).collect()] == [0]
    best = busiest_bounded(rows, side, "g", "m", **how)
    assert [(r.g, r.n_members) for r in best.collect()] == [(0, 500)]


def test_whole_hours():
    at = dt.datetime(2024, 1, 8, 6)
    hour = dt.timedelta(hours=1)
    assert whole_hours("2024-01-08 06:00:00", 7200) == (at, at + 2 * hour)
    assert whole_hours("2024-01-08 06:00:01", 7200) == (at + hour, at + 2 * hour)
    assert whole_hours("2024-01-08 06:10:00", 60) == (at + hour, at + hour)
