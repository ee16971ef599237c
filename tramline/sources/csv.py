"""Typed CSV and text scans of bus telemetry, with a bad-record split.

* ``read_bus_csv`` / ``read_bus_csv_stream``: the CSV reader with the
  declared schema (comma, quoting off, no header) — batch and streaming.
* ``parse_bus_lines``: raw text lines to typed rows with a reason column;
  a line is good when it has exactly ten fields, every numeric field parses,
  and the date parses. ``split_bus_lines`` returns (good, bad).
* ``bus_lines``: the text form of telemetry rows (for staging files).

Parsing is column expressions only (``split``, ``try_cast``,
``try_to_timestamp``): no Python per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.scalars import parse_time
from tramline.sources.schemas import (
    BIKE_SCHEMA, BUS_COLUMNS, BUS_FIELD_COUNT, BUS_SCHEMA, TIME_FORMAT,
)

CSV_OPTIONS = {"sep": ",", "quote": "", "header": "false", "mode": "PERMISSIVE"}

GOOD = "good"
BAD_FIELD_COUNT = "field_count"
BAD_VALUE = "bad_value"


def read_bus_csv(spark: SparkSession, path: str) -> DataFrame:
    """Batch CSV scan with the declared 10-column schema (``date`` as text)."""
    return spark.read.options(**CSV_OPTIONS).schema(BUS_SCHEMA).csv(path)


def read_bus_csv_stream(spark: SparkSession, path: str, *,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV directory scan with the declared schema."""
    reader = spark.readStream.options(**CSV_OPTIONS).schema(BUS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def read_bike_csv(spark: SparkSession, path: str) -> DataFrame:
    """Batch CSV scan of bike-station readings (11 declared columns);
    ``time`` is parsed to a timestamp."""
    raw = spark.read.options(**CSV_OPTIONS).schema(BIKE_SCHEMA).csv(path)
    return raw.withColumn("time", parse_time("time"))


def bus_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a folder of bus CSV files. Good rows have a
    ``reading_id`` from file name and line, so that ties in time are broken
    alike however the files are packed into tasks; rows equal in it are equal."""
    lines = read_lines(spark, path).withColumn(
        "reading_id", F.xxhash64(F.input_file_name(), "value"))
    return split_bus_lines(lines, keep=("reading_id",))


def bus_rows_stream(spark: SparkSession, path: str, *,
                    max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a streamed folder of bus CSV files."""
    return split_bus_lines(read_lines(spark, path, stream=True,
                                      max_files_per_trigger=max_files_per_trigger))


def bike_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a folder of bike-station CSV files: a good line has
    eleven fields, a station, a time and a number of bikes that parse."""
    return split_bike_lines(read_lines(spark, path))


def bike_rows_stream(spark: SparkSession, path: str, *,
                     max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a streamed folder of bike-station CSV files."""
    return split_bike_lines(read_lines(spark, path, stream=True,
                                       max_files_per_trigger=max_files_per_trigger))


def split_bike_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, bad raw lines with their reason)."""
    fields = F.split(F.trim("value"), ",", -1)
    names = [f.name for f in BIKE_SCHEMA.fields]
    cols = []
    for i, f in enumerate(BIKE_SCHEMA.fields):
        raw = F.get(fields, i)
        text = f.dataType.simpleString() == "string"
        cols.append((parse_time(raw, TIME_FORMAT) if f.name == "time" else
                     raw if text else raw.try_cast(f.dataType)).alias(f.name))
    parsed = lines.select("value", F.size(fields).alias("__n"), *cols)
    reason = (F.when(F.col("__n") != len(names), F.lit(BAD_FIELD_COUNT))
              .when(F.col("station_id").isNull() | F.col("time").isNull()
                    | F.col("available_bikes").isNull(), F.lit(BAD_VALUE)))
    marked = parsed.withColumn("reason", reason)
    return (marked.where("reason IS NULL").select(*names),
            marked.where("reason IS NOT NULL").select(F.col("value").alias("line"), "reason"))


def bike_lines(readings: DataFrame) -> DataFrame:
    """Bike readings (station_id, time, available_bikes, status, and any of
    the other layout columns) as CSV text lines; absent columns are derived
    from the station (name, address, stands) or left empty."""
    have = set(readings.columns)
    station = F.col("station_id").cast("string")

    def pick(name: str, fallback):
        return F.col(name).cast("string") if name in have else fallback

    fields = [
        station,
        F.date_format("time", TIME_FORMAT),
        pick("last_updated", F.date_format("time", TIME_FORMAT)),
        pick("name", F.concat(F.lit("STATION "), station)),
        pick("bike_stands", F.lit("40")),
        pick("available_bike_stands", (F.lit(40) - F.col("available_bikes")).cast("string")),
        F.col("available_bikes").cast("string"),
        F.col("status"),
        pick("address", F.concat(F.lit("Street "), station)),
        pick("latitude", F.lit("")),
        pick("longitude", F.lit("")),
    ]
    return readings.select(F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
                           .alias("value"))


def read_lines(spark: SparkSession, path: str, *, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines (column ``value``), batch or streaming."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def typed(df: DataFrame) -> DataFrame:
    """Replace the ``date`` text by a timestamp (NULL when unparsable)."""
    return df.withColumn("date", parse_time("date"))


def parse_bus_lines(lines: DataFrame, value: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines -> typed bus columns plus ``status`` (good / reason) and the
    columns of ``lines`` named in ``keep``."""
    fields = F.split(F.trim(F.col(value)), ",", -1)
    cols: list[Column] = []
    for i, (name, dtype) in enumerate(BUS_COLUMNS):
        raw = F.get(fields, i)  # NULL past the end (short lines)
        if name == "date":
            cols.append(parse_time(raw, TIME_FORMAT).alias(name))
        elif dtype.simpleString() == "string":
            cols.append(raw.alias(name))
        else:
            cols.append(raw.try_cast(dtype).alias(name))
    parsed = lines.select(F.size(fields).alias("__n"), F.col(value).alias("line"), *cols, *keep)
    names = [n for n, _ in BUS_COLUMNS if n != "busLinePatternID"]
    values_ok = F.lit(True)
    for n in names:
        values_ok = values_ok & F.col(n).isNotNull()
    status = (F.when(F.col("__n") != BUS_FIELD_COUNT, F.lit(BAD_FIELD_COUNT))
              .when(~values_ok, F.lit(BAD_VALUE))
              .otherwise(F.lit(GOOD)))
    return parsed.withColumn("status", status).drop("__n")


def split_bus_lines(lines: DataFrame, value: str = "value",
                    keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, bad raw lines with their reason)."""
    parsed = parse_bus_lines(lines, value, keep)
    good = parsed.where(F.col("status") == GOOD).drop("status", "line")
    bad = parsed.where(F.col("status") != GOOD).select("line", F.col("status").alias("reason"))
    return good, bad


def bus_lines(telemetry: DataFrame) -> DataFrame:
    """Telemetry rows as CSV text lines (column ``value``), fields in order."""
    return telemetry.select(F.concat_ws(",", *bus_fields()).alias("value"))


def bus_fields(overrides: dict[str, Column] | None = None) -> list[Column]:
    """The ten text fields of a telemetry row (NULL written as empty)."""
    overrides = overrides or {}
    out = []
    for name, _ in BUS_COLUMNS:
        if name in overrides:
            out.append(overrides[name])
        elif name == "date":
            out.append(F.date_format("date", TIME_FORMAT))
        else:
            out.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return out
