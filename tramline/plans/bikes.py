"""Bike-station analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.predicates import hour_between, is_weekday
from tramline.operators.extremes import extremes_with_owners
from tramline.sources.schemas import STATUS_OPEN

def hourly_station_average(df: DataFrame, *, first_hour: int = 7, last_hour: int = 19,
                           ts: str = "time") -> DataFrame:
    """Average available bikes per (station, hour of day), rounded to 2 digits,
    over weekday readings of open stations within [first_hour, last_hour]."""
    day_col = "day" if "day" in df.columns else None
    picked = df.where(is_weekday(ts, day_col=day_col) & (F.col("status") == STATUS_OPEN)
                      & hour_between(ts, first_hour, last_hour))
    return (picked.groupBy("station_id", F.hour(ts).alias("hrs"))
            .agg(F.round(F.avg("available_bikes"), 2).alias("bikes")))


def bike_extremes_by_hour(df: DataFrame, *, first_hour: int = 7, last_hour: int = 19,
                          ts: str = "time") -> DataFrame:
    """Per hour: lowest and highest station average and the station(s) having
    them (ties give every min-station with every max-station)."""
    avg = hourly_station_average(df, first_hour=first_hour, last_hour=last_hour, ts=ts)
    ext = extremes_with_owners(avg, "hrs", "station_id", "bikes",
                               min_out="min_bike", max_out="max_bike",
                               min_owner="min_bike_station_id", max_owner="max_bike_station_id")
    return ext.select(F.col("hrs").alias("HOUR"), "min_bike", "max_bike",
                      "min_bike_station_id", "max_bike_station_id")


def extremes_columns(ext: DataFrame) -> DataFrame:
    """The columns of ``bike_extremes_by_hour`` from running extremes by HOUR."""
    return ext.select("HOUR", F.col("min_value").alias("min_bike"),
                      F.col("max_value").alias("max_bike"),
                      F.col("min_owner").alias("min_bike_station_id"),
                      F.col("max_owner").alias("max_bike_station_id"))
