"""Bus-telemetry analyses, each a ``DataFrame -> DataFrame`` function.

Input: typed telemetry rows (``date`` a timestamp, plus the ten bus columns
and a unique ``reading_id`` that breaks ties in time).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.predicates import hour_in, in_box, is_weekday, on_day, within_horizon
from tramline.functions.scalars import clock_text, hour_text, on_time_flag
from tramline.operators.extremes import busiest_with_ties
from tramline.operators.grouped import bucket_histogram, distinct_count, share_by
from tramline.operators.ordered import DEFAULT_SLICE_SECONDS, change_points, path_distance

TS = "date"
TIE = "reading_id"


def day_col(df: DataFrame) -> str | None:
    """The stored day column, when the frame has one (partition pruning)."""
    return "day" if "day" in df.columns else None


# The city-centre box and the morning peak hours the congestion
# analysis is defined with.
CITY_BOX = {"north": 53.3702027, "east": -6.2043634, "south": 53.3343619, "west": -6.2886331}
PEAK_HOURS = ["07", "08", "09"]


def congestion_by_hour(df: DataFrame, *, box: dict = CITY_BOX,
                       hours: Iterable = PEAK_HOURS, ts: str = TS) -> DataFrame:
    """Per hour of day (weekdays, inside the box, listed hours): congestion
    share in percent, number of measurements, congested measurements.
    Sorted by share, highest first."""
    picked = df.where(in_box("latitude", "longitude", **box)
                      & is_weekday(ts, day_col=day_col(df)) & hour_in(ts, hours))
    out = share_by(picked.select(hour_text(ts).alias("hour"), "congestion"), "hour", "congestion")
    return out.orderBy(F.col("percentage").desc(), "hour")


def at_stop_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("atStop") != 0)


def stop_changes(df: DataFrame, *, slice_seconds: int | None = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """At-stop readings with consecutive repeats of the same stop collapsed,
    per (vehicle, line) series in time order."""
    return change_points(at_stop_rows(df), ["vehicleID", "busLineID"], TS, TIE, "closerStopID",
                         slice_seconds=slice_seconds)


def vehicle_arrivals(df: DataFrame, *, vehicle: int, day: str, delay_limit: int,
                     slice_seconds: int | None = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """One vehicle's stop arrivals on a day: repeats of a stop within a line
    collapsed, with the arrival time of day and an on-time flag."""
    rows = at_stop_rows(df).where((F.col("vehicleID") == vehicle)
                                  & on_day(TS, day, day_col=day_col(df)))
    kept = change_points(rows, ["busLineID"], TS, TIE, "closerStopID", slice_seconds=slice_seconds)
    return (kept.orderBy(TS, TIE)
            .select(F.col("busLineID").alias("lineID"),
                    F.col("closerStopID").alias("stationID"),
                    clock_text(TS).alias("arrivalTime"),
                    on_time_flag("delay", delay_limit).alias("onTime")))


def vehicle_arrivals_distinct(df: DataFrame, *, vehicle: int, day: str) -> DataFrame:
    """One vehicle's distinct (time of day, line, stop) at-stop triples on a
    day, no collapsing, in time order."""
    rows = at_stop_rows(df).where((F.col("vehicleID") == vehicle)
                                  & on_day(TS, day, day_col=day_col(df)))
    return (rows.select(clock_text(TS).alias("arrival_time"),
                        F.col("busLineID").alias("lineID"),
                        F.col("closerStopID").alias("stationID"))
            .distinct()
            .orderBy("arrival_time", "lineID", "stationID"))


def horizon_stops(df: DataFrame, *, start: str, horizon: int) -> DataFrame:
    return df.where((F.col("atStop") == 1)
                    & within_horizon(TS, start, horizon, day_col=day_col(df)))


def vehicles_per_stop(df: DataFrame, *, start: str, horizon: int, exact: bool = True) -> DataFrame:
    """Distinct vehicles per stop among at-stop readings in [start, start+horizon]."""
    picked = horizon_stops(df, start=start, horizon=horizon)
    picked = picked.select(F.col("closerStopID").alias("stationID"), "vehicleID")
    return distinct_count(picked, "stationID", "vehicleID", out="numVehicles", exact=exact)


def busiest_stops(df: DataFrame, *, start: str, horizon: int) -> DataFrame:
    """Stop(s) with the most distinct vehicles in the horizon, ties kept,
    with the sorted vehicle list."""
    picked = horizon_stops(df, start=start, horizon=horizon)
    picked = picked.select(F.col("closerStopID").alias("stationID"), "vehicleID")
    return busiest_with_ties(picked, "stationID", "vehicleID",
                             members_out="vehicles", count_out="numVehicles").orderBy("stationID")


def stops_per_vehicle(df: DataFrame, *, day: str, exact: bool = True) -> DataFrame:
    """Distinct stops per vehicle on a day, vehicle descending."""
    picked = df.where(on_day(TS, day, day_col=day_col(df))).select("vehicleID", "closerStopID")
    return (distinct_count(picked, "vehicleID", "closerStopID", out="numStations", exact=exact)
            .orderBy(F.col("vehicleID").desc()))


def vehicle_distances(df: DataFrame, *, day: str, max_speed: float, segment: str | None = None,
                      slice_seconds: int | None = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """Kilometres per vehicle on a day, speed-noise filtered."""
    picked = df.where(on_day(TS, day, day_col=day_col(df)))
    return path_distance(picked, "vehicleID", TS, TIE, "latitude", "longitude",
                         max_speed=max_speed, segment=segment, slice_seconds=slice_seconds)


def distance_histogram(df: DataFrame, *, day: str, max_speed: float, size: float) -> DataFrame:
    """How many vehicles travelled each ``size``-km band on a day."""
    km = vehicle_distances(df, day=day, max_speed=max_speed)
    return bucket_histogram(km, "km", size, count="numVehicles").orderBy("bucket")
