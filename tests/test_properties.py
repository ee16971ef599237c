"""Properties against brute force on small generated series."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramline.functions.geo import EARTH_RADIUS_M
from tramline.functions.predicates import in_box
from tramline.operators import bucket_histogram, change_points, path_distance

BASE = dt.datetime(2024, 1, 8)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

reading = st.tuples(
    st.integers(0, 2),              # vehicle
    st.integers(0, 1),              # line
    st.integers(0, 4 * 3600),       # seconds after BASE
    st.integers(0, 3),              # stop
    st.floats(53.30, 53.40),        # lat
    st.floats(-6.30, -6.20),        # lon
)


def frame(spark, rows):
    data = [(i, v, ln, BASE + dt.timedelta(seconds=s), stop, lat, lon)
            for i, (v, ln, s, stop, lat, lon) in enumerate(rows)]
    return spark.createDataFrame(
        data, "reading_id long, vehicleID int, busLineID int, date timestamp, "
              "closerStopID int, latitude double, longitude double")


def brute_change_points(rows):
    kept, last = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1], rows[i][2], i))
    for i in order:
        v, ln, _, stop, _, _ = rows[i]
        if last.get((v, ln)) != stop or (v, ln) not in last:
            kept.add(i)
        last[(v, ln)] = stop
    return kept


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(a))


def brute_km(rows, max_speed):
    out = {}
    by_vehicle = {}
    for i, r in enumerate(rows):
        by_vehicle.setdefault(r[0], []).append((r[2], i, r[4], r[5]))
    for v, pts in by_vehicle.items():
        pts.sort()
        metres = 0.0
        for (t0, _, la0, lo0), (t1, _, la1, lo1) in zip(pts, pts[1:]):
            d, dtime = haversine(la0, lo0, la1, lo1), t1 - t0
            if dtime > 0 and d / dtime <= max_speed:
                metres += d
        out[v] = metres / 1000.0
    return out


@SETTINGS
@given(st.lists(reading, min_size=0, max_size=40))
def test_change_points_match_brute_force(spark, rows):
    df = frame(spark, rows)
    want = brute_change_points(rows)
    for slice_seconds in (None, 600, 3600):
        got = change_points(df, ["vehicleID", "busLineID"], "date", "reading_id", "closerStopID",
                            slice_seconds=slice_seconds)
        assert {r.reading_id for r in got.collect()} == want


@SETTINGS
@given(st.lists(reading, min_size=0, max_size=40), st.sampled_from([5.0, 28.0, 1e9]))
def test_path_length_matches_brute_force(spark, rows, max_speed):
    df = frame(spark, rows)
    want = brute_km(rows, max_speed)
    for slice_seconds in (None, 900):
        got = path_distance(df, "vehicleID", "date", "reading_id", "latitude", "longitude",
                            max_speed=max_speed, slice_seconds=slice_seconds)
        got = {r.vehicleID: r.km for r in got.collect()}
        assert got.keys() == want.keys()
        for v in want:
            assert math.isclose(got[v], want[v], rel_tol=1e-9, abs_tol=1e-9)


def test_path_length_ignores_row_order_and_partitioning(spark):
    from tramline.sources.tables import telemetry
    from conftest import SF_SMALL
    t = telemetry(spark, SF_SMALL)
    base = path_distance(t, "vehicleID", "date", "reading_id", "latitude", "longitude",
                         max_speed=28.0)
    shuffled = t.orderBy(F.rand(7)).repartition(13)
    other = path_distance(shuffled, "vehicleID", "date", "reading_id", "latitude", "longitude",
                          max_speed=28.0, slice_seconds=1800)
    a = {r.vehicleID: round(r.km, 9) for r in base.collect()}
    b = {r.vehicleID: round(r.km, 9) for r in other.collect()}
    assert a == b and len(a) > 0


def test_histogram_counts_add_up(spark):
    from tramline.sources.tables import telemetry
    from conftest import SF_SMALL
    km = path_distance(telemetry(spark, SF_SMALL), "vehicleID", "date", "reading_id",
                       "latitude", "longitude", max_speed=28.0)
    hist = bucket_histogram(km, "km", 10)
    assert hist.agg(F.sum("n")).first()[0] == km.count()


@SETTINGS
@given(st.floats(0.0, 0.05), st.floats(0.0, 0.05))
def test_box_filter_is_monotone(spark, grow_lat, grow_lon):
    from tramline.plans.transit import CITY_BOX
    from tramline.sources.tables import telemetry
    from conftest import SF_SMALL
    t = telemetry(spark, SF_SMALL)
    big = {"north": CITY_BOX["north"] + grow_lat, "south": CITY_BOX["south"] - grow_lat,
           "east": CITY_BOX["east"] + grow_lon, "west": CITY_BOX["west"] - grow_lon}
    inner = t.where(in_box("latitude", "longitude", **CITY_BOX)).select("reading_id")
    outer = t.where(in_box("latitude", "longitude", **big)).select("reading_id")
    assert inner.subtract(outer).count() == 0


keyed = st.tuples(st.sampled_from([None, 0, 1]), st.sampled_from([None, 0]),
                  st.one_of(st.none(), st.integers(0, 9000)), st.sampled_from([None, 1, 2]))


@SETTINGS
@given(rows=st.lists(keyed, max_size=14), seconds=st.sampled_from([None, 600, 3600]))
def test_change_points_with_null_keys_and_times(spark, rows, seconds):
    """A NULL key is a key like any other; NULL times come first in a series."""
    data = [(i, v, ln, None if s is None else BASE + dt.timedelta(seconds=s), stop)
            for i, (v, ln, s, stop) in enumerate(rows)]
    df = spark.createDataFrame(data, "reading_id long, vehicleID int, busLineID int, "
                                     "date timestamp, closerStopID int")
    got = {r.reading_id for r in change_points(
        df, ["vehicleID", "busLineID"], "date", "reading_id", "closerStopID",
        slice_seconds=seconds).collect()}
    want, last = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (-1 if rows[i][2] is None else rows[i][2], i)):
        v, ln, _, stop = rows[i]
        if (v, ln) not in last or last[v, ln] != stop:
            want.add(i)
        last[v, ln] = stop
    assert got == want
