import datetime as dt

from pyspark.sql import functions as F

BASE = dt.datetime(2024, 1, 8)


def at(clock: str) -> dt.datetime:
    h, m, s = (int(x) for x in clock.split(":"))
    return BASE.replace(hour=h, minute=m, second=s)


def telemetry_rows(spark, rows):
    """rows: dicts with any of the telemetry columns; the rest get defaults."""
    defaults = {"reading_id": None, "date": BASE, "busLineID": 1, "busLinePatternID": "p",
                "congestion": 0, "longitude": -6.25, "latitude": 53.35, "delay": 0,
                "vehicleID": 1, "closerStopID": 1, "atStop": 1}
    full = []
    for i, r in enumerate(rows):
        row = dict(defaults, **r)
        if row["reading_id"] is None:
            row["reading_id"] = i
        full.append(row)
    schema = ("reading_id long, date string, busLineID int, busLinePatternID string, "
              "congestion int, longitude double, latitude double, delay int, vehicleID int, "
              "closerStopID int, atStop int")
    data = [tuple(r[k] if k != "date" else r[k].strftime("%Y-%m-%d %H:%M:%S")
                  for k in ["reading_id", "date", "busLineID", "busLinePatternID", "congestion",
                            "longitude", "latitude", "delay", "vehicleID", "closerStopID",
                            "atStop"]) for r in full]
    df = spark.createDataFrame(data, schema)
    return df.withColumn("date", F.to_timestamp("date"))
