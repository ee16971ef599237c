"""Scan queries: CSV and text sources over files Spark stages from the
driver tables (the whole telemetry table, written as bus CSV lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans import bikes
from tramline.plans.batch_queries import BIKE_AVG_SQL, ts_text
from tramline.plans.oracle import texted, with_tables
from tramline.plans.registry import register
from tramline.plans.transit import congestion_by_hour
from tramline.sources.csv import (
    bike_rows, bus_rows, parse_bus_lines, read_bus_csv, read_lines, split_bus_lines, typed,
)
from tramline.sources.staging import staged_bike_csv, staged_bus_csv

BUS_OUT = ["date", "busLineID", "busLinePatternID", "congestion", "longitude", "latitude",
           "delay", "vehicleID", "closerStopID", "atStop"]

SCAN_SQL = texted(with_tables(f"SELECT {', '.join(BUS_OUT)} FROM telemetry"), ["date"])


def bus_out(df: DataFrame) -> DataFrame:
    return df.select(*[ts_text(c).alias(c) if c == "date" else F.col(c) for c in BUS_OUT])


@register("scan_csv_batch", SCAN_SQL)
def q_scan_csv_batch(spark: SparkSession, sf: str) -> DataFrame:
    return bus_out(typed(read_bus_csv(spark, staged_bus_csv(spark, sf))))


@register("scan_text_parse", SCAN_SQL)
def q_scan_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = split_bus_lines(read_lines(spark, staged_bus_csv(spark, sf)))
    return bus_out(good)


@register("scan_bad_records", with_tables("""
SELECT CASE WHEN congestion = 1 THEN 'field_count'
            WHEN delay = -50 THEN 'bad_value' ELSE 'good' END AS status,
       count(*) AS n
FROM telemetry GROUP BY 1"""))
def q_scan_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_bus_lines(read_lines(spark, staged_bus_csv(spark, sf, dirty=True)))
    return parsed.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("congestion_of_dirty_lines", with_tables("""
SELECT strftime(date, '%H') AS hour, 0.0::DOUBLE AS percentage, count(*) AS numMeasurements,
       CAST(0 AS BIGINT) AS congestionMeasurements
FROM telemetry
WHERE latitude BETWEEN 53.3343619 AND 53.3702027 AND longitude BETWEEN -6.2886331 AND -6.2043634
  AND isodow(date) <= 5 AND hour(date) IN (7, 8, 9) AND congestion = 0 AND delay <> -50
GROUP BY 1"""))
def q_congestion_of_dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Congestion over a dirty feed: lines of eleven fields (those taken in
    congestion) and lines without a number for the delay do not count."""
    good, _ = bus_rows(spark, staged_bus_csv(spark, sf, dirty=True))
    return congestion_by_hour(good)


@register("scan_bike_csv", with_tables("""
SELECT e.hrs AS HOUR, e.min_bike, e.max_bike,
       a.station_id AS min_bike_station_id, b.station_id AS max_bike_station_id
FROM ext e
JOIN avgs a ON a.hrs = e.hrs AND a.bikes = e.min_bike
JOIN avgs b ON b.hrs = e.hrs AND b.bikes = e.max_bike""", BIKE_AVG_SQL))
def q_scan_bike_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The bike extremes job on its own source format: an 11-column CSV."""
    good, _ = bike_rows(spark, staged_bike_csv(spark, sf))
    return bikes.bike_extremes_by_hour(good)
