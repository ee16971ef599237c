"""Tiny literal tables with known answers (FIXTURES.md §6)."""

import pytest

from helpers import at, telemetry_rows
from tramline.functions.predicates import in_box
from tramline.operators import (
    bucket_histogram, busiest_with_ties, extremes_with_owners, path_distance,
)
from tramline.plans import transit
from tramline.sources.csv import parse_bus_lines, split_bus_lines


@pytest.mark.parametrize("slice_seconds", [None, 30, 3600])
def test_change_points_with_on_time_flag(spark, slice_seconds):
    rows = telemetry_rows(spark, [
        {"busLineID": 1, "date": at("08:00:00"), "closerStopID": 10, "delay": 30},
        {"busLineID": 1, "date": at("08:01:00"), "closerStopID": 10, "delay": 95},
        {"busLineID": 1, "date": at("08:02:00"), "closerStopID": 11, "delay": -60},
        {"busLineID": 1, "date": at("08:03:00"), "closerStopID": 10, "delay": -61},
        {"busLineID": 2, "date": at("08:00:30"), "closerStopID": 10, "delay": 0},
    ])
    out = transit.vehicle_arrivals(rows, vehicle=1, day="2024-01-08", delay_limit=60,
                                   slice_seconds=slice_seconds)
    assert [tuple(r) for r in out.collect()] == [
        (1, 10, "08:00:00", 1), (2, 10, "08:00:30", 1), (1, 11, "08:02:00", 1),
        (1, 10, "08:03:00", 0)]


def test_change_points_carry_across_empty_slices(spark):
    # Same stop an hour apart, with empty slices in between: still a repeat.
    rows = telemetry_rows(spark, [
        {"date": at("06:00:00"), "closerStopID": 5},
        {"date": at("09:30:00"), "closerStopID": 5},
        {"date": at("09:30:10"), "closerStopID": 6},
    ])
    for slice_seconds in (None, 60):
        out = transit.stop_changes(rows, slice_seconds=slice_seconds)
        assert sorted(r.reading_id for r in out.collect()) == [0, 2]


def test_busiest_with_ties(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 4), (2, 9), (2, 8), (3, 7)], "stop int, v int")
    out = busiest_with_ties(df, "stop", "v").orderBy("stop")
    assert [tuple(r) for r in out.collect()] == [(1, "4,5", 2), (2, "8,9", 2)]


def test_busiest_empty_input(spark):
    df = spark.createDataFrame([], "stop int, v int")
    assert busiest_with_ties(df, "stop", "v").count() == 0


@pytest.mark.parametrize("bound", [None, 24])
def test_extremes_with_owners_tie_product(spark, bound):
    df = spark.createDataFrame([(7, 1, 2.0), (7, 2, 2.0), (7, 3, 9.0), (8, 1, 4.0)],
                               "hour int, station int, avg double")
    out = extremes_with_owners(df, "hour", "station", "avg")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(7, 2.0, 9.0, 1, 3), (7, 2.0, 9.0, 2, 3), (8, 4.0, 4.0, 1, 1)]


@pytest.mark.parametrize("slice_seconds", [None, 50, 3600])
def test_path_length_noise_and_zero_gap(spark, slice_seconds):
    base = at("08:00:00")
    import datetime as dt
    rows = telemetry_rows(spark, [
        {"date": base, "latitude": 53.35, "longitude": -6.25},
        {"date": base + dt.timedelta(seconds=100), "latitude": 53.36, "longitude": -6.25},
        {"date": base + dt.timedelta(seconds=110), "latitude": 53.35, "longitude": -6.25},
        {"date": base + dt.timedelta(seconds=110), "latitude": 53.36, "longitude": -6.25},
    ])
    out = path_distance(rows, "vehicleID", "date", "reading_id", "latitude", "longitude",
                        max_speed=28.0, slice_seconds=slice_seconds).collect()
    assert len(out) == 1 and out[0].km == pytest.approx(1.1119508, abs=1e-7)


def test_single_reading_travels_zero(spark):
    rows = telemetry_rows(spark, [{"vehicleID": 3}])
    out = path_distance(rows, "vehicleID", "date", "reading_id", "latitude", "longitude",
                        max_speed=28.0).collect()
    assert [(r.vehicleID, r.km) for r in out] == [(3, 0.0)]


def test_bucket_labels(spark):
    df = spark.createDataFrame([(0.0,), (0.999,), (1.0,)], "v double")
    out = bucket_histogram(df, "v", 1).orderBy("bucket")
    assert [tuple(r) for r in out.collect()] == [(0, "0_1", 2), (1, "1_2", 1)]


def test_box_is_closed(spark):
    box = transit.CITY_BOX
    pts = [(box["north"], box["west"]), (box["south"], box["east"]),
           (box["north"], box["east"]), (box["south"], box["west"]),
           (box["north"] + 1e-6, box["east"]), (box["south"], box["west"] - 1e-6)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    assert df.where(in_box("lat", "lon", **box)).count() == 4


def test_bad_lines(spark):
    good = "2013-01-07 08:00:00,7,027B1001,0,-6.26,53.35,90,33304,7486,1"
    lines = [
        good,
        "2013-01-07 08:00:00,7,027B1001,0,-6.26,53.35,90,33304,7486",        # 9 fields
        good + ",1",                                                           # 11 fields
        "2013-01-07 08:00:00,7,027B1001,x,-6.26,53.35,90,33304,7486,1",       # congestion
        "2013-01-07 8 o'clock,7,027B1001,0,-6.26,53.35,90,33304,7486,1",      # date
        "2013-01-07 08:00:00,7,,0,-6.26,53.35,90,33304,-1,0",                 # empty pattern
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    status = [r.status for r in parse_bus_lines(df).collect()]
    assert status == ["good", "field_count", "field_count", "bad_value", "bad_value", "good"]
    ok, bad = split_bus_lines(df)
    rows = ok.orderBy("closerStopID").collect()
    assert [r.busLinePatternID for r in rows] == ["", "027B1001"]
    assert rows[0].closerStopID == -1 and rows[1].delay == 90
    assert bad.count() == 4


def test_hour_range_is_closed_and_weekdays_are_mon_to_fri(spark):
    from tramline.functions.predicates import hour_between, is_weekday
    times = ["2024-01-08 06:59:59", "2024-01-08 07:00:00", "2024-01-08 19:59:59",
             "2024-01-08 20:00:00", "2024-01-12 12:00:00", "2024-01-13 12:00:00",
             "2024-01-14 12:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").selectExpr(
        "t", "cast(t as timestamp) as ts")
    kept = [r.t for r in df.where(hour_between("ts", 7, 19) & is_weekday("ts")).collect()]
    assert kept == ["2024-01-08 07:00:00", "2024-01-08 19:59:59", "2024-01-12 12:00:00"]


def test_bike_extremes_filters_closed_stations_and_weekends(spark):
    from tramline.plans.bikes import bike_extremes_by_hour
    rows = [(1, "2024-01-08 07:10:00", 4, "Open"), (2, "2024-01-08 07:20:00", 9, "Open"),
            (3, "2024-01-08 07:30:00", 0, "Close"),           # closed: ignored
            (3, "2024-01-13 07:30:00", 1, "Open"),            # Saturday: ignored
            (1, "2024-01-08 20:00:00", 7, "Open")]            # after 19:59: ignored
    df = spark.createDataFrame(rows, "station_id int, time string, available_bikes int, "
                                     "status string").selectExpr(
        "station_id", "cast(time as timestamp) as time", "available_bikes", "status")
    out = [tuple(r) for r in bike_extremes_by_hour(df).collect()]
    assert out == [(7, 4.0, 9.0, 1, 2)]


def test_null_members_are_not_counted(spark):
    from tramline.operators import distinct_count, distinct_members
    df = spark.createDataFrame([(1, 5), (1, None), (1, 5), (2, None)], "g int, m int")
    exact = {r.g: r.n for r in distinct_count(df, "g", "m", out="n").collect()}
    assert exact == {1: 1, 2: 0}
    lists = {r.g: (r.members, r.n_members) for r in distinct_members(df, "g", "m").collect()}
    assert lists == {1: ("5", 1), 2: ("", 0)}
    top = [tuple(r) for r in busiest_with_ties(df, "g", "m").collect()]
    assert top == [(1, "5", 1)]
