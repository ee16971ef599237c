"""Queries over side tables: the same answers as their plain forms, read from
storage that fits the question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.predicates import on_day
from tramline.operators.cells import in_box_clustered
from tramline.operators.segments import path_distance_folded
from tramline.operators.sketches import busiest_bounded, distinct_sketched
from tramline.plans import transit
from tramline.plans.batch_queries import (
    BOX_SQL, DAY, DAY_SQL, HORIZON_SECONDS, HORIZON_SQL, HORIZON_START, MAX_SPEED, _busiest_sql,
    _steps_ctes,
)
from tramline.plans.oracle import with_tables
from tramline.plans.registry import register
from tramline.sources.side_tables import (
    CELL, SLICE, stop_sketches, telemetry_by_cell, telemetry_by_slice,
)
from tramline.sources.tables import telemetry


@register("path_distance_folded", with_tables(
    "SELECT vehicleID, round(km, 3) AS km FROM km", _steps_ctes(DAY_SQL)))
def q_path_distance_folded(spark: SparkSession, sf: str) -> DataFrame:
    rows = telemetry_by_slice(spark, sf).where(on_day("date", DAY))
    km = path_distance_folded(rows, "vehicleID", SLICE, "date", "reading_id", "latitude",
                              "longitude", max_speed=MAX_SPEED)
    return km.select("vehicleID", F.round("km", 3).alias("km"))


@register("path_distance_all_days", with_tables(
    "SELECT vehicleID, round(km, 3) AS km FROM km", _steps_ctes("TRUE")))
def q_path_distance_all_days(spark: SparkSession, sf: str) -> DataFrame:
    """Kilometres over the whole table; slices are folded by weeks first."""
    km = path_distance_folded(telemetry_by_slice(spark, sf), "vehicleID", SLICE, "date",
                              "reading_id", "latitude", "longitude", max_speed=MAX_SPEED,
                              coarse_slices=28)
    return km.select("vehicleID", F.round("km", 3).alias("km"))


@register("filter_bbox_clustered", with_tables(
    f"SELECT reading_id, vehicleID FROM telemetry WHERE {BOX_SQL}"))
def q_filter_bbox_clustered(spark: SparkSession, sf: str) -> DataFrame:
    rows = telemetry_by_cell(spark, sf)
    return rows.where(in_box_clustered(CELL, "latitude", "longitude", **transit.CITY_BOX)).select(
        "reading_id", "vehicleID")


@register("vehicles_per_stop_sketched", with_tables(f"""
SELECT closerStopID AS stationID, count(DISTINCT vehicleID) AS numVehicles
FROM telemetry WHERE atStop = 1 AND {HORIZON_SQL} GROUP BY 1"""))
def q_vehicles_per_stop_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """From the side table, and the readings of the horizon's last instant."""
    at_stop = telemetry(spark, sf).where(F.col("atStop") == 1)
    return distinct_sketched(stop_sketches(spark, sf), "closerStopID", start=HORIZON_START,
                             seconds=HORIZON_SECONDS, readings=at_stop, member="vehicleID",
                             out="numVehicles").withColumnRenamed("closerStopID", "stationID")


@register("busiest_stops_bounded", _busiest_sql(
    "closerStopID", "stationID", "vehicleID", "vehicleID", f"atStop = 1 AND {HORIZON_SQL}",
    "numVehicles", "vehicles"))
def q_busiest_stops_bounded(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    picked = transit.horizon_stops(t, start=HORIZON_START, horizon=HORIZON_SECONDS)
    return busiest_bounded(picked, stop_sketches(spark, sf), "closerStopID", "vehicleID",
                           start=HORIZON_START, seconds=HORIZON_SECONDS, members_out="vehicles",
                           count_out="numVehicles").withColumnRenamed("closerStopID", "stationID")
