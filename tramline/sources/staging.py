"""Files Spark writes from the driver tables, for scans and streams to read.

Staged files live in the shared folder (``tramline.session.shared_dir``).
A staged copy of a table is written once per application and reused;
streams that add files get a fresh folder of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import fresh_dir
from tramline.sources.csv import bike_lines, bus_fields, bus_lines
from tramline.sources.tables import bike_readings, telemetry

_STAGED: dict[tuple[str, str, str], str] = {}


def write_lines(lines: DataFrame, path: str) -> str:
    """Append text lines (column ``value``) under ``path``."""
    lines.write.mode("append").text(path)
    return path


#: Parts that a feed staged in time order arrives in, and files in each.
FEED_PARTS = 4
FEED_FILES = 2


def write_feed(rows: DataFrame, path: str, *, parts: int = FEED_PARTS,
               files: int = FEED_FILES, delay_seconds: Column | None = None) -> str:
    """Write telemetry as a feed delivers it: ``parts`` consecutive stretches
    of time, each as ``files`` CSV files, one stretch after the other. A stream
    that takes ``files`` files per trigger sees one stretch in each. The time is
    that of arrival: a reading's own, and ``delay_seconds`` (whole) on top."""
    arrival = F.unix_micros("date")
    if delay_seconds is not None:
        arrival = arrival + delay_seconds.cast("long") * 1_000_000
    return _write_by_arrival(rows, arrival, bus_lines, path, parts, files)


def write_bike_feed(rows: DataFrame, path: str, *, parts: int = FEED_PARTS,
                    files: int = FEED_FILES) -> str:
    """Write bike readings as a feed delivers them, like ``write_feed``."""
    return _write_by_arrival(rows, F.unix_micros("time"), bike_lines, path, parts, files)


def _write_by_arrival(rows: DataFrame, arrival: Column, lines, path: str, parts: int,
                      files: int) -> str:
    bounds = rows.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first()
    if bounds.lo is None:
        return write_lines(lines(rows), path)
    width = (bounds.hi - bounds.lo) // parts + 1
    part = F.floor((arrival - F.lit(bounds.lo)) / F.lit(width))
    for i in range(parts):
        write_lines(lines(rows.where(part == i)).repartition(files), path)
    return path


def staged_feed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of bus CSV files in time order, for streams (cached)."""
    key = (spark.sparkContext.applicationId, sf_dir, "feed")
    if key not in _STAGED:
        _STAGED[key] = write_feed(telemetry(spark, sf_dir), fresh_dir(spark, "bus-feed"))
    return _STAGED[key]


def dirty_bus_lines(rows: DataFrame) -> DataFrame:
    """Telemetry as text lines with the defects a field feed shows:
    readings taken in congestion carry an eleventh diagnostics field, and a
    missing delay (raw value below one second) is written as ``n/a``."""
    delay = F.when(F.col("delay") == -50, F.lit("n/a")).otherwise(F.col("delay").cast("string"))
    line = F.concat_ws(",", *bus_fields({"delay": delay}))
    line = F.when(F.col("congestion") == 1,
                  F.concat(line, F.lit(","), F.col("closerStopID").cast("string"))).otherwise(line)
    return rows.select(line.alias("value"))


def staged_bus_csv(spark: SparkSession, sf_dir: str, *, dirty: bool = False) -> str:
    """Folder of bus CSV files holding the whole telemetry table (cached)."""
    key = (spark.sparkContext.applicationId, sf_dir, "dirty" if dirty else "clean")
    if key not in _STAGED:
        rows = telemetry(spark, sf_dir)
        lines = dirty_bus_lines(rows) if dirty else bus_lines(rows)
        _STAGED[key] = write_lines(lines, fresh_dir(spark, f"bus-csv-{key[2]}"))
    return _STAGED[key]


def staged_bike_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder of bike-station CSV files holding all bike readings (cached)."""
    key = (spark.sparkContext.applicationId, sf_dir, "bikes")
    if key not in _STAGED:
        _STAGED[key] = write_lines(bike_lines(bike_readings(spark, sf_dir)),
                                   fresh_dir(spark, "bike-csv"))
    return _STAGED[key]


def staged_bike_feed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of bike-station CSV files in time order, for streams (cached)."""
    key = (spark.sparkContext.applicationId, sf_dir, "bike-feed")
    if key not in _STAGED:
        _STAGED[key] = write_bike_feed(bike_readings(spark, sf_dir), fresh_dir(spark, "bike-feed"))
    return _STAGED[key]
