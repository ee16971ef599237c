"""Batch queries on the driver tables, each with its DuckDB oracle.

Parameters follow FIXTURES.md §5: box and peak hours of the congestion
analysis; day 2024-01-08 (a Monday); vehicle 7; horizon 2024-01-08 06:00:00
plus 21600 s; maximum speed 28 m/s; 10 km distance buckets; delay limit 60 s.
Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m
from tramline.functions.predicates import (
    contains, hour_between, hour_in, in_box, is_weekday, on_day, within_horizon,
)
from tramline.functions.scalars import clock_text, hour_text, on_time_flag, parse_time
from tramline.operators.extremes import busiest_with_ties, extreme_owners, extremes_with_owners
from tramline.operators.grouped import (
    bucket_histogram, distinct_count, distinct_members, share_by,
)
from tramline.operators.ordered import with_previous
from tramline.plans import bikes, transit
from tramline.plans.oracle import haversine, texted, with_tables
from tramline.plans.registry import register
from tramline.sources.csv import read_lines, split_bus_lines
from tramline.sources.schemas import TIME_FORMAT
from tramline.sources.staging import staged_bus_csv
from tramline.sources.tables import bike_readings, telemetry

# Query parameters on the derived tables.
DAY = "2024-01-08"
NEXT_DAY = "2024-01-09"
VEHICLE = 7
HORIZON_START = "2024-01-08 06:00:00"
HORIZON_SECONDS = 21600
HORIZON_END = "2024-01-08 12:00:00"
MAX_SPEED = 28.0
BUCKET_KM = 10
DELAY_LIMIT = 60
DELAY_BUCKET = 10

BOX_SQL = ("latitude BETWEEN 53.3343619 AND 53.3702027 "
           "AND longitude BETWEEN -6.2886331 AND -6.2043634")
DAY_SQL = f"date >= TIMESTAMP '{DAY}' AND date < TIMESTAMP '{NEXT_DAY}'"
HORIZON_SQL = f"date BETWEEN TIMESTAMP '{HORIZON_START}' AND TIMESTAMP '{HORIZON_END}'"


def ts_text(col: str | Column) -> Column:
    """Timestamp as ISO text "yyyy-MM-dd HH:mm:ss" (registered outputs carry
    times as text so their value hashes do not depend on timestamp units)."""
    return F.date_format(col, TIME_FORMAT)


def as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: ts_text(c) for c in cols})


# ---------------------------------------------------------------- composites

@register("congestion_by_hour", with_tables(f"""
SELECT strftime(date, '%H') AS hour,
       round(100.0::DOUBLE * count_if(congestion = 1) / count(*), 2) AS percentage,
       count(*) AS numMeasurements,
       CAST(count_if(congestion = 1) AS BIGINT) AS congestionMeasurements
FROM telemetry
WHERE {BOX_SQL} AND isodow(date) <= 5 AND hour(date) IN (7, 8, 9)
GROUP BY 1"""))
def q_congestion_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return transit.congestion_by_hour(telemetry(spark, sf))


CHANGE_SQL = """
SELECT {cols}
FROM (SELECT *,
             lag(closerStopID) OVER w AS prev_stop,
             row_number() OVER w AS rn
      FROM telemetry WHERE {where}
      WINDOW w AS (PARTITION BY {part} ORDER BY date, reading_id))
WHERE rn = 1 OR prev_stop IS DISTINCT FROM closerStopID"""


@register("change_points", texted(with_tables(CHANGE_SQL.format(
    cols="reading_id, vehicleID, busLineID, closerStopID, date",
    where="atStop <> 0", part="vehicleID, busLineID")), ["date"]))
def q_change_points(spark: SparkSession, sf: str) -> DataFrame:
    kept = transit.stop_changes(telemetry(spark, sf))
    return kept.select("reading_id", "vehicleID", "busLineID", "closerStopID",
                       ts_text("date").alias("date"))


@register("vehicle_arrivals", with_tables(CHANGE_SQL.format(
    cols=f"busLineID AS lineID, closerStopID AS stationID, strftime(date, '%H:%M:%S') AS arrivalTime, "
         f"CASE WHEN abs(delay) <= {DELAY_LIMIT} THEN 1 ELSE 0 END AS onTime",
    where=f"atStop <> 0 AND vehicleID = {VEHICLE} AND {DAY_SQL}", part="busLineID")))
def q_vehicle_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return transit.vehicle_arrivals(telemetry(spark, sf), vehicle=VEHICLE, day=DAY,
                                    delay_limit=DELAY_LIMIT)


@register("vehicle_arrivals_distinct", with_tables(f"""
SELECT DISTINCT strftime(date, '%H:%M:%S') AS arrival_time, busLineID AS lineID,
       closerStopID AS stationID
FROM telemetry WHERE atStop <> 0 AND vehicleID = {VEHICLE} AND {DAY_SQL}"""))
def q_vehicle_arrivals_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return transit.vehicle_arrivals_distinct(telemetry(spark, sf), vehicle=VEHICLE, day=DAY)


@register("vehicles_per_stop", with_tables(f"""
SELECT closerStopID AS stationID, count(DISTINCT vehicleID) AS numVehicles
FROM telemetry WHERE atStop = 1 AND {HORIZON_SQL} GROUP BY 1"""))
def q_vehicles_per_stop(spark: SparkSession, sf: str) -> DataFrame:
    return transit.vehicles_per_stop(telemetry(spark, sf), start=HORIZON_START,
                                     horizon=HORIZON_SECONDS, exact=True)


@register("vehicles_per_stop_approx", with_tables(f"""
SELECT closerStopID AS stationID, TRUE AS approx_within_15pct
FROM telemetry WHERE atStop = 1 AND {HORIZON_SQL} GROUP BY 1"""))
def q_vehicles_per_stop_approx(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    approx = transit.vehicles_per_stop(t, start=HORIZON_START, horizon=HORIZON_SECONDS,
                                       exact=False).withColumnRenamed("numVehicles", "approx")
    exact = transit.vehicles_per_stop(t, start=HORIZON_START, horizon=HORIZON_SECONDS, exact=True)
    both = approx.join(exact, "stationID")
    ok = F.abs(F.col("approx") - F.col("numVehicles")) <= F.col("numVehicles") * F.lit(0.15)
    return both.select("stationID", ok.alias("approx_within_15pct"))


BUSIEST_CTES = """
pairs AS (SELECT DISTINCT {g} AS {gname}, {m} AS {mname} FROM {src} WHERE {where}),
counts AS (SELECT {gname}, count(*) AS {cname},
                  string_agg(CAST({mname} AS VARCHAR), ',' ORDER BY {mname}) AS {lname}
           FROM pairs GROUP BY {gname})"""
BUSIEST_BODY = """SELECT {gname}, {lname}, {cname} FROM counts
WHERE {cname} = (SELECT max({cname}) FROM counts)"""


def _busiest_sql(g, gname, m, mname, where, cname, lname, src="telemetry"):
    fmt = dict(g=g, gname=gname, m=m, mname=mname, where=where, cname=cname, lname=lname, src=src)
    return with_tables(BUSIEST_BODY.format(**fmt), BUSIEST_CTES.format(**fmt))


@register("busiest_stops", _busiest_sql("closerStopID", "stationID", "vehicleID", "vehicleID",
                                        f"atStop = 1 AND {HORIZON_SQL}", "numVehicles", "vehicles"))
def q_busiest_stops(spark: SparkSession, sf: str) -> DataFrame:
    return transit.busiest_stops(telemetry(spark, sf), start=HORIZON_START, horizon=HORIZON_SECONDS)


@register("busiest_with_ties", _busiest_sql("closerStopID", "stationID", "vehicleID", "vehicleID",
                                            "atStop = 1", "numVehicles", "vehicles"))
def q_busiest_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(F.col("atStop") == 1)
    t = t.select(F.col("closerStopID").alias("stationID"), "vehicleID")
    return busiest_with_ties(t, "stationID", "vehicleID", members_out="vehicles",
                             count_out="numVehicles")


@register("stops_per_vehicle", with_tables(f"""
SELECT vehicleID, count(DISTINCT closerStopID) AS numStations
FROM telemetry WHERE {DAY_SQL} GROUP BY 1"""))
def q_stops_per_vehicle(spark: SparkSession, sf: str) -> DataFrame:
    return transit.stops_per_vehicle(telemetry(spark, sf), day=DAY, exact=True)


STEPS_CTES = """
pts AS (SELECT vehicleID, date, latitude, longitude, {segment} AS segment,
               lag(date) OVER w AS pdate, lag(latitude) OVER w AS plat,
               lag(longitude) OVER w AS plon
        FROM telemetry WHERE {where}
        WINDOW w AS (PARTITION BY vehicleID{segpart} ORDER BY date, reading_id)),
steps AS (SELECT vehicleID, segment, pdate, date,
                 {hav} AS d,
                 (epoch_us(date) - epoch_us(pdate)) / 1000000.0::DOUBLE AS dt
          FROM pts),
km AS (SELECT vehicleID,
              sum(CASE WHEN pdate IS NOT NULL AND dt > 0 AND d / dt <= {vmax} THEN d ELSE 0.0 END)
                / 1000.0::DOUBLE AS km
       FROM steps GROUP BY vehicleID)"""


def _steps_ctes(where: str, segment: str | None = None) -> str:
    return STEPS_CTES.format(
        where=where, vmax=MAX_SPEED,
        segment=segment or "NULL", segpart=", segment" if segment else "",
        hav=haversine("plat", "plon", "latitude", "longitude"))


@register("path_distance", with_tables(
    "SELECT vehicleID, round(km, 3) AS km FROM km", _steps_ctes(DAY_SQL)))
def q_path_distance(spark: SparkSession, sf: str) -> DataFrame:
    km = transit.vehicle_distances(telemetry(spark, sf), day=DAY, max_speed=MAX_SPEED)
    return km.select("vehicleID", F.round("km", 3).alias("km"))


@register("path_distance_segmented", with_tables(
    "SELECT vehicleID, round(km, 3) AS km FROM km",
    _steps_ctes(DAY_SQL, segment="date_trunc('hour', date)")))
def q_path_distance_segmented(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).withColumn("segment", F.date_trunc("hour", "date"))
    km = transit.vehicle_distances(t, day=DAY, max_speed=MAX_SPEED, segment="segment")
    return km.select("vehicleID", F.round("km", 3).alias("km"))


@register("distance_histogram", with_tables(f"""
SELECT CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) AS bucket,
       CAST(CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) * {BUCKET_KM} AS VARCHAR) || '_' ||
       CAST(CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) * {BUCKET_KM} + {BUCKET_KM} AS VARCHAR)
         AS bucket_range,
       count(*) AS numVehicles
FROM km GROUP BY 1, 2""", _steps_ctes(DAY_SQL)))
def q_distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return transit.distance_histogram(telemetry(spark, sf), day=DAY, max_speed=MAX_SPEED,
                                      size=BUCKET_KM)


@register("haversine_pairs", with_tables(f"""
SELECT reading_id, round({haversine('plat', 'plon', 'latitude', 'longitude')}, 3) AS step_m
FROM (SELECT reading_id, latitude, longitude,
             lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon
      FROM telemetry WINDOW w AS (PARTITION BY vehicleID ORDER BY date, reading_id))
WHERE plat IS NOT NULL"""))
def q_haversine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    marked = with_previous(t, ["vehicleID"], "date", "reading_id", ["latitude", "longitude"])
    d = haversine_m("prev.latitude", "prev.longitude", "latitude", "longitude")
    return (marked.where(F.col("prev").isNotNull())
            .select("reading_id", F.round(d, 3).alias("step_m")))


BIKE_AVG_SQL = """
avgs AS (SELECT station_id, CAST(hour(time) AS INTEGER) AS hrs,
                round(avg(available_bikes), 2) AS bikes
         FROM bike_readings
         WHERE isodow(time) <= 5 AND status = 'Open' AND hour(time) BETWEEN 7 AND 19
         GROUP BY 1, 2),
ext AS (SELECT hrs, min(bikes) AS min_bike, max(bikes) AS max_bike FROM avgs GROUP BY hrs)"""


@register("bike_extremes_by_hour", with_tables("""
SELECT e.hrs AS HOUR, e.min_bike, e.max_bike,
       a.station_id AS min_bike_station_id, b.station_id AS max_bike_station_id
FROM ext e
JOIN avgs a ON a.hrs = e.hrs AND a.bikes = e.min_bike
JOIN avgs b ON b.hrs = e.hrs AND b.bikes = e.max_bike""", BIKE_AVG_SQL))
def q_bike_extremes_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return bikes.bike_extremes_by_hour(bike_readings(spark, sf))


@register("extremes_with_owners", with_tables("""
SELECT e.hr, e.min_value, e.max_value, a.vehicleID AS min_owner, b.vehicleID AS max_owner
FROM ext e
JOIN avgs a ON a.hr = e.hr AND a.avg_delay = e.min_value
JOIN avgs b ON b.hr = e.hr AND b.avg_delay = e.max_value""", """
avgs AS (SELECT CAST(hour(date) AS INTEGER) AS hr, vehicleID, round(avg(delay), 2) AS avg_delay
         FROM telemetry GROUP BY 1, 2),
ext AS (SELECT hr, min(avg_delay) AS min_value, max(avg_delay) AS max_value FROM avgs GROUP BY hr)"""))
def q_extremes_with_owners(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    avgs = (t.groupBy(F.hour("date").alias("hr"), "vehicleID")
            .agg(F.round(F.avg("delay"), 2).alias("avg_delay")))
    return extremes_with_owners(avgs, "hr", "vehicleID", "avg_delay")


@register("extreme_owners", with_tables("""
SELECT DISTINCT e.hr, which, a.avg_delay AS value, a.vehicleID AS owner
FROM (SELECT hr, 'min' AS which, min(avg_delay) AS v FROM avgs GROUP BY hr
      UNION ALL SELECT hr, 'max', max(avg_delay) FROM avgs GROUP BY hr) e
JOIN avgs a ON a.hr = e.hr AND a.avg_delay = e.v""", """
avgs AS (SELECT CAST(hour(date) AS INTEGER) AS hr, vehicleID, round(avg(delay), 2) AS avg_delay
         FROM telemetry GROUP BY 1, 2)"""))
def q_extreme_owners(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    avgs = (t.groupBy(F.hour("date").alias("hr"), "vehicleID")
            .agg(F.round(F.avg("delay"), 2).alias("avg_delay")))
    return extreme_owners(avgs, "hr", "vehicleID", "avg_delay")


@register("on_time_flag", with_tables(f"""
SELECT reading_id, CASE WHEN abs(delay) <= {DELAY_LIMIT} THEN 1 ELSE 0 END AS onTime
FROM telemetry WHERE atStop <> 0"""))
def q_on_time_flag(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(F.col("atStop") != 0)
    return t.select("reading_id", on_time_flag("delay", DELAY_LIMIT).alias("onTime"))


# ---------------------------------------------------------------- projections

@register("project_alias", with_tables("""
SELECT reading_id, strftime(date, '%H') AS hour, congestion AS cong, vehicleID AS vehicle,
       CAST(vehicleID AS VARCHAR) || '-' || CAST(busLineID AS VARCHAR) AS vehicle_line
FROM telemetry"""))
def q_project_alias(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    t = t.withColumn("vehicle_line", F.concat_ws("-", "vehicleID", "busLineID"))
    return t.select("reading_id", hour_text("date").alias("hour"), F.col("congestion").alias("cong"),
                    F.col("vehicleID").alias("vehicle"), "vehicle_line")


@register("project_retype", with_tables("""
SELECT reading_id,
       CAST(epoch(strptime(strftime(date, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) AS BIGINT)
         AS epoch_s
FROM telemetry"""))
def q_project_retype(spark: SparkSession, sf: str) -> DataFrame:
    text = telemetry(spark, sf).select("reading_id",
                                       F.date_format("date", TIME_FORMAT).alias("date"))
    return text.select("reading_id", F.unix_seconds(parse_time("date")).alias("epoch_s"))


# ---------------------------------------------------------------- filters

@register("filter_bbox", with_tables(f"SELECT reading_id, vehicleID FROM telemetry WHERE {BOX_SQL}"))
def q_filter_bbox(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    return (t.where(in_box("latitude", "longitude", **transit.CITY_BOX))
            .select("reading_id", "vehicleID"))


@register("filter_weekday", with_tables(
    "SELECT reading_id, CAST(isodow(date) AS INTEGER) AS iso_dow FROM telemetry WHERE isodow(date) <= 5"))
def q_filter_weekday(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    t = t.where(is_weekday("date", day_col=transit.day_col(t)))
    return t.select("reading_id", (F.weekday("date") + 1).alias("iso_dow"))


@register("filter_in_list", with_tables(
    "SELECT reading_id, strftime(date, '%H') AS hour FROM telemetry WHERE hour(date) IN (7, 8, 9)"))
def q_filter_in_list(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(hour_in("date", transit.PEAK_HOURS))
    return t.select("reading_id", hour_text("date").alias("hour"))


@register("filter_hour_between", with_tables(
    "SELECT station_id, CAST(hour(time) AS INTEGER) AS hrs, available_bikes FROM bike_readings "
    "WHERE hour(time) BETWEEN 7 AND 19"))
def q_filter_hour_between(spark: SparkSession, sf: str) -> DataFrame:
    b = bike_readings(spark, sf).where(hour_between("time", 7, 19))
    return b.select("station_id", F.hour("time").alias("hrs"), "available_bikes")


@register("filter_eq", with_tables(
    f"SELECT reading_id, closerStopID FROM telemetry WHERE vehicleID = {VEHICLE} AND atStop <> 0"))
def q_filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where((F.col("vehicleID") == VEHICLE) & (F.col("atStop") != 0))
    return t.select("reading_id", "closerStopID")


@register("filter_day", with_tables(f"SELECT reading_id, vehicleID FROM telemetry WHERE {DAY_SQL}"))
def q_filter_day(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    return (t.where(on_day("date", DAY, day_col=transit.day_col(t)))
            .select("reading_id", "vehicleID"))


@register("filter_horizon", with_tables(
    f"SELECT reading_id, closerStopID FROM telemetry WHERE {HORIZON_SQL}"))
def q_filter_horizon(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    t = t.where(within_horizon("date", HORIZON_START, HORIZON_SECONDS, day_col=transit.day_col(t)))
    return t.select("reading_id", "closerStopID")


@register("filter_contains", with_tables(f"""
SELECT strftime(date, '%Y-%m-%d %H:%M:%S') AS date, vehicleID, closerStopID, delay
FROM telemetry WHERE contains(strftime(date, '%Y-%m-%d %H:%M:%S'), '{DAY}')"""))
def q_filter_contains(spark: SparkSession, sf: str) -> DataFrame:
    # Raw lines that hold the day's text, tested before they are parsed.
    lines = read_lines(spark, staged_bus_csv(spark, sf)).where(contains("value", DAY))
    good, _ = split_bus_lines(lines)
    return good.select(F.date_format("date", TIME_FORMAT).alias("date"), "vehicleID",
                       "closerStopID", "delay")


@register("filter_hidden_col", with_tables(
    "SELECT reading_id, vehicleID FROM telemetry WHERE atStop = 1 AND delay > 0"))
def q_filter_hidden_col(spark: SparkSession, sf: str) -> DataFrame:
    # The filter names columns that the projection already dropped; the
    # analyzer resolves them below the projection.
    t = telemetry(spark, sf)
    return t.select("reading_id", "vehicleID").where((t["atStop"] == 1) & (t["delay"] > 0))


# ---------------------------------------------------------------- joins

@register("join_inner_two_keys", with_tables("""
SELECT e.hrs, e.min_bike, a.station_id
FROM ext e JOIN avgs a ON a.hrs = e.hrs AND a.bikes = e.min_bike""", BIKE_AVG_SQL))
def q_join_inner_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    avgs = bikes.hourly_station_average(bike_readings(spark, sf))
    ext = avgs.groupBy("hrs").agg(F.min("bikes").alias("min_bike"))   # at most 24 rows
    a = avgs.alias("a")
    joined = F.broadcast(ext).alias("e").join(
        a, (F.col("a.hrs") == F.col("e.hrs")) & (F.col("a.bikes") == F.col("e.min_bike")), "inner")
    return joined.select(F.col("e.hrs"), F.col("e.min_bike"), F.col("a.station_id"))


@register("join_inner_one_key", with_tables("""
SELECT mn.hrs AS min_hrs, mn.station_id AS min_bike_station_id,
       mx.station_id AS max_bike_station_id
FROM (SELECT a.hrs, a.station_id FROM avgs a JOIN ext e ON a.hrs = e.hrs AND a.bikes = e.min_bike) mn
JOIN (SELECT a.hrs, a.station_id FROM avgs a JOIN ext e ON a.hrs = e.hrs AND a.bikes = e.max_bike) mx
  ON mn.hrs = mx.hrs""", BIKE_AVG_SQL))
def q_join_inner_one_key(spark: SparkSession, sf: str) -> DataFrame:
    avgs = bikes.hourly_station_average(bike_readings(spark, sf))
    ext = F.broadcast(avgs.groupBy("hrs")                     # at most 24 hours
                      .agg(F.min("bikes").alias("lo"), F.max("bikes").alias("hi")))
    tagged = avgs.join(ext, "hrs")
    mins = tagged.where(F.col("bikes") == F.col("lo")).select(
        F.col("hrs").alias("min_hrs"), F.col("station_id").alias("min_bike_station_id"))
    maxs = tagged.where(F.col("bikes") == F.col("hi")).select(
        F.col("hrs").alias("max_hrs"), F.col("station_id").alias("max_bike_station_id"))
    joined = mins.join(maxs, mins["min_hrs"] == maxs["max_hrs"], "inner")
    return joined.select("min_hrs", "min_bike_station_id", "max_bike_station_id")


@register("join_to_group_max", with_tables("""
SELECT stationID, numVehicles FROM counts
WHERE numVehicles = (SELECT max(numVehicles) FROM counts)""", f"""
counts AS (SELECT closerStopID AS stationID, count(DISTINCT vehicleID) AS numVehicles
           FROM telemetry WHERE atStop = 1 AND {HORIZON_SQL} GROUP BY 1)"""))
def q_join_to_group_max(spark: SparkSession, sf: str) -> DataFrame:
    counts = transit.vehicles_per_stop(telemetry(spark, sf), start=HORIZON_START,
                                       horizon=HORIZON_SECONDS, exact=True)
    top = counts.agg(F.max("numVehicles").alias("numVehicles"))     # one row
    return counts.join(F.broadcast(top), "numVehicles").select("stationID", "numVehicles")


# ---------------------------------------------------------------- aggregates

@register("agg_sum_count_avg", with_tables("""
SELECT strftime(date, '%H') AS hour,
       CAST(sum(congestion) AS BIGINT) AS congestionMeasurements,
       count(*) AS numMeasurements,
       round(avg(congestion) * 100, 2) AS percentage
FROM telemetry GROUP BY 1"""))
def q_agg_sum_count_avg(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).select(hour_text("date").alias("hour"), "congestion")
    return t.groupBy("hour").agg(
        F.sum("congestion").alias("congestionMeasurements"),
        F.count(F.lit(1)).alias("numMeasurements"),
        F.round(F.avg("congestion") * 100, 2).alias("percentage"),
    )


@register("agg_share", with_tables("""
SELECT busLineID,
       round(100.0::DOUBLE * count_if(congestion = 1) / count(*), 2) AS percentage,
       count(*) AS numMeasurements,
       CAST(count_if(congestion = 1) AS BIGINT) AS congestionMeasurements
FROM telemetry GROUP BY 1"""))
def q_agg_share(spark: SparkSession, sf: str) -> DataFrame:
    return share_by(telemetry(spark, sf), "busLineID", "congestion")


@register("agg_avg_round", with_tables("SELECT station_id, hrs, bikes FROM avgs", BIKE_AVG_SQL))
def q_agg_avg_round(spark: SparkSession, sf: str) -> DataFrame:
    return bikes.hourly_station_average(bike_readings(spark, sf))


@register("agg_min_max", with_tables("SELECT hrs, min_bike, max_bike FROM ext", BIKE_AVG_SQL))
def q_agg_min_max(spark: SparkSession, sf: str) -> DataFrame:
    avgs = bikes.hourly_station_average(bike_readings(spark, sf))
    return avgs.groupBy("hrs").agg(F.min("bikes").alias("min_bike"),
                                   F.max("bikes").alias("max_bike"))


@register("agg_approx_distinct", with_tables(
    "SELECT vehicleID, TRUE AS within_tolerance FROM telemetry GROUP BY 1"))
def q_agg_approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    # Approximate values are never compared directly: each group reports
    # whether HLL++ is within 15 % of the exact distinct count, which is cheap
    # here (few stops; pairs fold before the shuffle).
    t = telemetry(spark, sf)
    approx = distinct_count(t, "vehicleID", "closerStopID", out="approx", exact=False)
    exact = distinct_count(t, "vehicleID", "closerStopID", out="exact", exact=True)
    both = approx.join(exact, "vehicleID")
    ok = F.abs(F.col("approx") - F.col("exact")) <= F.col("exact") * F.lit(0.15)
    return both.select("vehicleID", ok.alias("within_tolerance"))


@register("agg_distinct_sorted", with_tables("""
SELECT stationID, string_agg(CAST(vehicleID AS VARCHAR), ',' ORDER BY vehicleID) AS vehicles,
       count(*) AS numVehicles
FROM (SELECT DISTINCT closerStopID AS stationID, vehicleID FROM telemetry WHERE atStop = 1)
GROUP BY 1"""))
def q_agg_distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(F.col("atStop") == 1)
    t = t.select(F.col("closerStopID").alias("stationID"), "vehicleID")
    return distinct_members(t, "stationID", "vehicleID", out="vehicles", count="numVehicles")


@register("agg_collect_set", with_tables("""
SELECT vehicleID, CAST(CAST(date AS DATE) AS VARCHAR) AS day,
       string_agg(DISTINCT CAST(busLineID AS VARCHAR) || ',' || CAST(closerStopID AS VARCHAR), ';'
                  ORDER BY CAST(busLineID AS VARCHAR) || ',' || CAST(closerStopID AS VARCHAR))
         AS line_stops
FROM telemetry WHERE atStop <> 0 GROUP BY 1, 2"""))
def q_agg_collect_set(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(F.col("atStop") != 0)
    t = t.select("vehicleID", F.to_date("date").cast("string").alias("day"),
                 F.concat_ws(",", "busLineID", "closerStopID").alias("line_stop"))
    # De-duplicate first, so the set per group is built from distinct values.
    distinct = t.distinct()
    return distinct.groupBy("vehicleID", "day").agg(
        F.array_join(F.array_sort(F.collect_list("line_stop")), ";").alias("line_stops"))


@register("agg_max", with_tables(
    "SELECT vehicleID, max(delay) AS max_delay, min(delay) AS min_delay FROM telemetry GROUP BY 1"))
def q_agg_max(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry(spark, sf).groupBy("vehicleID").agg(
        F.max("delay").alias("max_delay"), F.min("delay").alias("min_delay"))


@register("bucket_histogram", with_tables(f"""
SELECT CAST(floor(delay / {DELAY_BUCKET}.0) AS BIGINT) AS bucket,
       CAST(CAST(floor(delay / {DELAY_BUCKET}.0) AS BIGINT) * {DELAY_BUCKET} AS VARCHAR) || '_' ||
       CAST(CAST(floor(delay / {DELAY_BUCKET}.0) AS BIGINT) * {DELAY_BUCKET} + {DELAY_BUCKET} AS VARCHAR)
         AS bucket_range,
       count(*) AS n
FROM telemetry GROUP BY 1, 2"""))
def q_bucket_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return bucket_histogram(telemetry(spark, sf), "delay", DELAY_BUCKET)


# ---------------------------------------------------------------- sorts

@register("sort_asc", with_tables("SELECT hrs, station_id, bikes FROM avgs ORDER BY hrs",
                                  BIKE_AVG_SQL))
def q_sort_asc(spark: SparkSession, sf: str) -> DataFrame:
    avgs = bikes.hourly_station_average(bike_readings(spark, sf))
    return avgs.select("hrs", "station_id", "bikes").orderBy("hrs", "station_id")


@register("sort_desc", with_tables("""
SELECT vehicleID, count(*) AS n FROM telemetry GROUP BY 1 ORDER BY n DESC, vehicleID"""))
def q_sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    return t.groupBy("vehicleID").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), "vehicleID")


@register("sort_multi", with_tables("""
SELECT reading_id, busLineID, strftime(date, '%Y-%m-%d %H:%M:%S') AS date
FROM telemetry ORDER BY busLineID, date, reading_id"""))
def q_sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    return t.orderBy("busLineID", "date", "reading_id").select(
        "reading_id", "busLineID", ts_text("date").alias("date"))


@register("array_sort", with_tables("""
SELECT vehicleID, CAST(CAST(date AS DATE) AS VARCHAR) AS day,
       string_agg(DISTINCT CAST(closerStopID AS VARCHAR), ',' ORDER BY CAST(closerStopID AS VARCHAR))
         AS stops
FROM telemetry WHERE atStop <> 0 GROUP BY 1, 2"""))
def q_array_sort(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf).where(F.col("atStop") != 0)
    pairs = t.select("vehicleID", F.to_date("date").cast("string").alias("day"),
                     F.col("closerStopID").cast("string").alias("stop")).distinct()
    return pairs.groupBy("vehicleID", "day").agg(
        F.array_join(F.array_sort(F.collect_list("stop")), ",").alias("stops"))


# ---------------------------------------------------------------- scalars

@register("scalar_string", with_tables("""
SELECT reading_id,
       substring(strftime(date, '%Y-%m-%d %H:%M:%S'), 12, 2) AS hour,
       substring(strftime(date, '%Y-%m-%d %H:%M:%S'), 1, 10) AS day,
       strftime(date, '%H:%M:%S') || ',' || CAST(busLineID AS VARCHAR) || ',' ||
         CAST(closerStopID AS VARCHAR) AS combined
FROM telemetry"""))
def q_scalar_string(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    text = F.date_format("date", TIME_FORMAT)
    return t.select("reading_id", F.substring(text, 12, 2).alias("hour"),
                    F.substring(text, 1, 10).alias("day"),
                    F.concat(clock_text("date"), F.lit(","), F.col("busLineID").cast("string"),
                             F.lit(","), F.col("closerStopID").cast("string")).alias("combined"))


@register("scalar_datetime", with_tables("""
SELECT reading_id, CAST(CAST(date AS DATE) AS VARCHAR) AS day, CAST(hour(date) AS INTEGER) AS hour,
       strftime(date, '%H:%M:%S') AS clock,
       CAST(isodow(date) % 7 + 1 AS INTEGER) AS day_of_week
FROM telemetry"""))
def q_scalar_datetime(spark: SparkSession, sf: str) -> DataFrame:
    t = telemetry(spark, sf)
    return t.select("reading_id", F.to_date("date").cast("string").alias("day"), F.hour("date").alias("hour"),
                    clock_text("date").alias("clock"), F.dayofweek("date").alias("day_of_week"))


@register("explode_split", with_tables(f"""
SELECT DISTINCT vehicleID, strftime(date, '%H:%M:%S') AS arrival_time,
       CAST(busLineID AS VARCHAR) AS lineID, CAST(closerStopID AS VARCHAR) AS stationID
FROM telemetry WHERE atStop <> 0 AND {DAY_SQL}"""))
def q_explode_split(spark: SparkSession, sf: str) -> DataFrame:
    # Collect "time,line,stop" texts per vehicle and hour (so that a set stays
    # small for a hot vehicle), explode them back to rows and split each.
    t = telemetry(spark, sf)
    t = t.where((F.col("atStop") != 0) & on_day("date", DAY, day_col=transit.day_col(t)))
    combined = F.concat_ws(",", clock_text("date"), "busLineID", "closerStopID")
    sets = t.groupBy("vehicleID", F.hour("date").alias("hour")).agg(
        F.collect_set(combined).alias("items"))
    rows = sets.select("vehicleID", F.explode("items").alias("item"))
    parts = F.split("item", ",")
    return rows.select("vehicleID", parts.getItem(0).alias("arrival_time"),
                       parts.getItem(1).alias("lineID"), parts.getItem(2).alias("stationID"))


# ---------------------------------------------------------------- SQL over a view

@register("sql_over_view", with_tables("SELECT station_id, hrs, bikes FROM avgs", BIKE_AVG_SQL))
def q_sql_over_view(spark: SparkSession, sf: str) -> DataFrame:
    readings = bike_readings(spark, sf)
    picked = readings.where(is_weekday("time", day_col="day") & (F.col("status") == "Open"))
    return spark.sql("""
        SELECT station_id, hrs, round(avg(available_bikes), 2) AS bikes
        FROM (SELECT station_id, hour(time) AS hrs, available_bikes FROM {picked}
              WHERE hour(time) BETWEEN :first AND :last)
        GROUP BY station_id, hrs""", args={"first": 7, "last": 19}, picked=picked)
