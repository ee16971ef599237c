"""Declared input schemas (never inferred).

Fixed values: column order, names and meaning must equal the telemetry and
bike-station CSV layouts the analyses are defined on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Bus telemetry CSV, comma separated, no quoting, no header.
#  0 date              string "yyyy-MM-dd HH:mm:ss"
#  1 busLineID         int
#  2 busLinePatternID  string, may be empty
#  3 congestion        int 0/1
#  4 longitude         double
#  5 latitude          double
#  6 delay             int, seconds, negative if early
#  7 vehicleID         int
#  8 closerStopID      int, -1 if none
#  9 atStop            int 0/1
BUS_COLUMNS = [
    ("date", T.StringType()),
    ("busLineID", T.IntegerType()),
    ("busLinePatternID", T.StringType()),
    ("congestion", T.IntegerType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("delay", T.IntegerType()),
    ("vehicleID", T.IntegerType()),
    ("closerStopID", T.IntegerType()),
    ("atStop", T.IntegerType()),
]

BUS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in BUS_COLUMNS])
BUS_FIELD_COUNT = len(BUS_COLUMNS)

# Bike station CSV (snake_case names for the original headers
# STATION ID, TIME, LAST UPDATED, NAME, BIKE STANDS, AVAILABLE BIKE STAND,
# AVAILABLE BIKES, STATUS, ADDRESS, LATTITUDE, LONGITUDE).
BIKE_COLUMNS = [
    ("station_id", T.IntegerType()),
    ("time", T.StringType()),
    ("last_updated", T.StringType()),
    ("name", T.StringType()),
    ("bike_stands", T.IntegerType()),
    ("available_bike_stands", T.IntegerType()),
    ("available_bikes", T.IntegerType()),
    ("status", T.StringType()),
    ("address", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
]

BIKE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in BIKE_COLUMNS])

# Fixed value: the timestamp text format of both layouts.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed value: the bike status that counts as open.
STATUS_OPEN = "Open"
