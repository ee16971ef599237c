"""Streaming queries: each drains a feed staged from the driver tables, in
several triggers, into a durable sink and returns the sink's table.

Windowed queries run in update mode and return every window, also those the
watermark has not closed, so their answers do not depend on the number of
triggers; the oracles are plain aggregates over all rows. Only
``stream_tumbling_append`` shows append mode, whose oracle keeps the windows
that the watermark has closed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.predicates import hour_between, is_weekday, on_day
from tramline.plans.batch_queries import (
    BIKE_AVG_SQL, BUCKET_KM, DAY, DAY_SQL, DELAY_LIMIT, HORIZON_SECONDS, HORIZON_SQL, HORIZON_START, MAX_SPEED, VEHICLE,
    as_text, haversine,
)
from tramline.plans.bikes import extremes_columns
from tramline.plans.oracle import texted, with_tables
from tramline.plans.registry import register
from tramline.plans.scan_queries import SCAN_SQL, bus_out
from tramline.plans.transit import congestion_by_hour
from tramline.session import fresh_dir
from tramline.sources.csv import (
    bike_rows_stream, bus_lines, bus_rows_stream, read_bus_csv_stream, read_lines, split_bus_lines, typed,
)
from tramline.sources.schemas import STATUS_OPEN
from tramline.sources.staging import (
    FEED_FILES, FEED_PARTS, staged_bike_feed, staged_bus_csv, staged_feed, write_feed, write_lines,
)
from tramline.sources.tables import telemetry
from tramline.streaming import forms
from tramline.streaming.extremes import extremes_after, run_extremes, side_by_side
from tramline.streaming.reorder import STORE, finished, held_rows, in_order, run_in_order
from tramline.streaming.runner import (
    EPOCH, await_end, flatten_window, latest_rows, read_sink, run, run_carried, run_latest,
    run_per_batch, start,
)
from tramline.streaming.state import histogram_per_batch, latest_histogram, path_distance_state
from tramline.streaming.upsert import run_upsert

#: How far readings may lag behind the newest one before they count as late.
LATENESS = "1 hour"
#: Slices of the reorder buffer, in microseconds.
SLICE_US = 6 * 3600 * 1_000_000


WINDOW = ["window_start", "window_end"]


def out_keys(out: DataFrame) -> list[str]:
    """All columns of a frame whose rows are keys (its window flattened)."""
    return [*WINDOW, *[c for c in out.columns if c != "window"]]


def register_windowed(name: str, sql: str, extra: tuple[str, ...] = ()):
    """Register a windowed stream query; window bounds (and ``extra``
    timestamp columns) are returned as ISO text on both sides."""
    cols = ["window_start", "window_end", *extra]

    def wrap(fn):
        def build(spark: SparkSession, sf: str) -> DataFrame:
            return as_text(fn(spark, sf), cols)
        build.__name__, build.__doc__ = fn.__name__, fn.__doc__
        register(name, texted(sql, cols))(build)
        return fn
    return wrap


def bus_stream(spark: SparkSession, sf: str, path: str | None = None) -> DataFrame:
    """Good readings of the feed, a stretch of time per trigger."""
    good, _ = bus_rows_stream(spark, path or staged_feed(spark, sf),
                              max_files_per_trigger=FEED_FILES)
    return good


def closed(end: str, rows: str = "telemetry") -> str:
    """Oracle condition: the window is closed by the watermark."""
    return f"{end} <= (SELECT max(date) FROM {rows}) - INTERVAL {LATENESS}"


# ---------------------------------------------------------------- sources

@register("scan_csv_stream", SCAN_SQL)
def q_scan_csv_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = typed(read_bus_csv_stream(spark, staged_feed(spark, sf), max_files_per_trigger=FEED_FILES))
    table, _ = run(bus_out(rows), label="scan-csv-stream")
    return table


@register("stream_text_parse", SCAN_SQL)
def q_stream_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_lines(spark, staged_bus_csv(spark, sf), stream=True)
    good, _ = split_bus_lines(lines)
    table, _ = run(bus_out(good), label="text-stream")
    return table


# ---------------------------------------------------------------- windows

@register_windowed("stream_tumbling_append", with_tables(f"""
SELECT window_start, window_end, n FROM (
  SELECT date_trunc('hour', date) AS window_start,
         date_trunc('hour', date) + INTERVAL 1 HOUR AS window_end, count(*) AS n
  FROM telemetry GROUP BY 1, 2)
WHERE {closed('window_end')}"""))
def q_stream_tumbling_append(spark: SparkSession, sf: str) -> DataFrame:
    counts = forms.windowed_counts(bus_stream(spark, sf), width="1 hour", delay=LATENESS)
    table, _ = run(flatten_window(counts), label="tumbling")
    return table


@register_windowed("stream_tumbling_all", with_tables("""
SELECT date_trunc('hour', date) AS window_start,
       date_trunc('hour', date) + INTERVAL 1 HOUR AS window_end, count(*) AS n
FROM telemetry GROUP BY 1, 2"""))
def q_stream_tumbling_all(spark: SparkSession, sf: str) -> DataFrame:
    counts = forms.windowed_counts(bus_stream(spark, sf), width="1 hour", delay=LATENESS)
    table, _ = run_latest(flatten_window(counts), WINDOW, label="tumbling-all")
    return table


@register_windowed("stream_sliding_append", with_tables("""
SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n
FROM (SELECT date_trunc('hour', date) AS window_start FROM telemetry
      UNION ALL
      SELECT date_trunc('hour', date) - INTERVAL 1 HOUR FROM telemetry)
GROUP BY 1"""))
def q_stream_sliding_append(spark: SparkSession, sf: str) -> DataFrame:
    counts = forms.windowed_counts(bus_stream(spark, sf), width="2 hours", slide="1 hour",
                                   delay=LATENESS)
    table, _ = run_latest(flatten_window(counts), WINDOW, label="sliding")
    return table


@register_windowed("stream_sliding_panes", with_tables(f"""
SELECT * FROM (
  SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n
  FROM (SELECT date_trunc('hour', date) AS window_start FROM telemetry
        UNION ALL
        SELECT date_trunc('hour', date) - INTERVAL 1 HOUR FROM telemetry)
  GROUP BY 1)
WHERE {closed('window_end')}"""))
def q_stream_sliding_panes(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding windows in append mode, from panes that are counted once."""
    counts = forms.windowed_counts_panes(bus_stream(spark, sf), width="2 hours", slide="1 hour",
                                         delay=LATENESS)
    table, _ = run(flatten_window(counts), label="panes")
    return table


@register_windowed("stream_congestion", with_tables("""
SELECT date_trunc('day', date) AS window_start,
         date_trunc('day', date) + INTERVAL 1 DAY AS window_end,
         strftime(date, '%H') AS hour,
         round(100.0::DOUBLE * sum(congestion) / count(*), 2) AS percentage,
         count(*) AS numMeasurements,
         CAST(sum(congestion) AS BIGINT) AS congestionMeasurements
  FROM picked GROUP BY 1, 2, 3""", """
picked AS (SELECT * FROM telemetry
           WHERE latitude BETWEEN 53.3343619 AND 53.3702027
             AND longitude BETWEEN -6.2886331 AND -6.2043634
             AND isodow(date) <= 5 AND hour(date) IN (7, 8, 9))"""))
def q_stream_congestion(spark: SparkSession, sf: str) -> DataFrame:
    out = forms.congestion_windows(bus_stream(spark, sf), width="1 day", delay=LATENESS)
    table, _ = run_latest(flatten_window(out), [*WINDOW, "hour"], label="congestion")
    return table


@register_windowed("stream_arrivals_sliding", with_tables("""
SELECT DISTINCT window_start, window_start + INTERVAL 2 HOUR AS window_end,
       strftime(date, '%H:%M:%S') AS arrival_time, busLineID AS lineID, closerStopID AS stationID
FROM (SELECT date_trunc('hour', date) AS window_start, * FROM picked
      UNION ALL
      SELECT date_trunc('hour', date) - INTERVAL 1 HOUR AS window_start, * FROM picked)""", f"""
picked AS (SELECT * FROM telemetry WHERE atStop <> 0 AND vehicleID = {VEHICLE} AND {DAY_SQL})"""))
def q_stream_arrivals_sliding(spark: SparkSession, sf: str) -> DataFrame:
    out = forms.arrivals_sliding(bus_stream(spark, sf), vehicle=VEHICLE, day=DAY,
                                 width="2 hours", slide="1 hour", delay=LATENESS)
    # A triple is told again whenever it is seen again.
    table, _ = run_latest(flatten_window(out), out_keys(out), label="arrivals")
    return table


CHANGES_SQL = with_tables("""
SELECT window_start, window_end, vehicleID, busLineID, date, closerStopID, delay
FROM (SELECT date_trunc('day', date) AS window_start,
             date_trunc('day', date) + INTERVAL 1 DAY AS window_end, *,
             lag(closerStopID) OVER w AS prev_stop, row_number() OVER w AS rn
      FROM picked
      WINDOW w AS (PARTITION BY vehicleID, busLineID, date_trunc('day', date)
                   ORDER BY date, closerStopID, delay))
WHERE rn = 1 OR prev_stop IS DISTINCT FROM closerStopID""",
    "picked AS (SELECT * FROM telemetry WHERE atStop <> 0)")


@register_windowed("stream_change_points", CHANGES_SQL, extra=("date",))
def q_stream_change_points(spark: SparkSession, sf: str) -> DataFrame:
    sink = run_carried(bus_stream(spark, sf), forms.change_points_step(width="1 day"),
                       label="change-points")
    return spark.read.parquet(f"{sink}/changes").drop(EPOCH)


def disordered_feed(spark: SparkSession, sf: str) -> str:
    """A feed whose readings arrive up to an hour after their time."""
    delay = F.pmod(F.xxhash64("reading_id"), F.lit(3600))
    return write_feed(telemetry(spark, sf), fresh_dir(spark, "disordered-feed"),
                      delay_seconds=delay)


@register_windowed("stream_change_points_disordered", CHANGES_SQL, extra=("date",))
def q_stream_change_points_disordered(spark: SparkSession, sf: str) -> DataFrame:
    # Every reading is up to an hour late; the reorder buffer puts them in order.
    # The feed ends, so what is still held is told as well.
    stream = bus_stream(spark, sf, disordered_feed(spark, sf))
    step = forms.change_points_step(width="1 day")
    sink, checkpoint = run_in_order(stream, ["vehicleID", "busLineID"], step, label="disordered",
                                    lateness=LATENESS, slice_seconds=SLICE_US // 1_000_000,
                                    buckets=4)
    return finished(spark, step, "changes", stream.schema, sink=sink, checkpoint=checkpoint)


#: Every 40th reading arrives this much after its time.
STRAGGLE_SECONDS = 10 * 86400

@register("stream_late_kept", with_tables("""
SELECT CASE WHEN part > slice_part THEN 'late' ELSE 'in_order' END AS kind,
       strftime(date, '%Y-%m-%d') AS day, count(*) AS n
FROM dealt GROUP BY 1, 2""", f"""
arrivals AS (SELECT *, epoch_us(date) + CASE WHEN reading_id % 40 = 0
                                             THEN {STRAGGLE_SECONDS * 1_000_000} ELSE 0 END AS arrival
             FROM telemetry),
bounds AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM arrivals),
parts AS (SELECT a.*, (arrival - lo) // ((hi - lo) // {FEED_PARTS} + 1) AS part
          FROM arrivals a, bounds),
marks AS (SELECT part, max(epoch_us(date)) AS newest FROM parts GROUP BY part),
ends AS (SELECT p.*, (epoch_us(date) // {SLICE_US} + 1) * {SLICE_US} AS slice_end FROM parts p),
dealt AS (SELECT e.*, coalesce((SELECT min(m.part) FROM marks m
                                WHERE m.newest - 3600000000 >= e.slice_end), 1000) AS slice_part
          FROM ends e)"""))
def q_stream_late_kept(spark: SparkSession, sf: str) -> DataFrame:
    """A feed in which some readings come ten days late: they are kept as rows of
    their own kind, beside those in order; with what is still held at the end,
    every reading is told once."""
    path = write_feed(telemetry(spark, sf), fresh_dir(spark, "straggling-feed"),
                      delay_seconds=F.when(F.col("reading_id") % 40 == 0, STRAGGLE_SECONDS)
                      .otherwise(0))
    stream = bus_stream(spark, sf, path)
    ordered = in_order(stream, ["vehicleID", "busLineID"], lateness=LATENESS,
                       slice_seconds=SLICE_US // 1_000_000, buckets=4)
    sink, checkpoint = fresh_dir(spark, "late-kept-sink"), fresh_dir(spark, "late-kept-ckpt")
    await_end(start(ordered, sink=sink, checkpoint=checkpoint, conf=STORE))
    told = read_sink(spark, sink, ordered.schema).select("kind", "date").unionByName(
        held_rows(spark, checkpoint, stream.schema).select(F.lit("in_order").alias("kind"), "date"))
    return told.groupBy("kind", F.date_format("date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"))


@register_windowed("stream_arrivals_collapsed", with_tables(f"""
SELECT window_start, window_end, busLineID AS lineID, closerStopID AS stationID,
       strftime(date, '%H:%M:%S') AS arrivalTime,
       CASE WHEN abs(delay) <= {DELAY_LIMIT} THEN 1 ELSE 0 END AS onTime
FROM (SELECT *, window_start + INTERVAL 2 HOUR AS window_end,
             lag(closerStopID) OVER w AS prev_stop, row_number() OVER w AS rn
      FROM (SELECT date_trunc('hour', date) AS window_start, * FROM picked
            UNION ALL
            SELECT date_trunc('hour', date) - INTERVAL 1 HOUR AS window_start, * FROM picked)
      WINDOW w AS (PARTITION BY window_start, busLineID ORDER BY date, closerStopID, delay))
WHERE rn = 1 OR prev_stop IS DISTINCT FROM closerStopID""", f"""
picked AS (SELECT * FROM telemetry WHERE atStop <> 0 AND vehicleID = {VEHICLE} AND {DAY_SQL})"""))
def q_stream_arrivals_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    picked = bus_stream(spark, sf).where((F.col("vehicleID") == VEHICLE) & on_day("date", DAY))
    step = forms.change_points_step(width="2 hours", slide="1 hour", partition=("busLineID",))
    sink = run_carried(picked, step, label="arrivals-collapsed")
    return forms.arrivals_of(spark.read.parquet(f"{sink}/changes"), DELAY_LIMIT)


@register_windowed("stream_busiest", with_tables("""
SELECT c.window_start, c.window_start + INTERVAL 6 HOUR AS window_end,
       c.stationID, c.vehicles, c.numVehicles
FROM counts c JOIN best b ON c.window_start = b.window_start AND c.numVehicles = b.top""", """
picked AS (SELECT * FROM telemetry WHERE atStop = 1),
pairs AS (SELECT DISTINCT date_trunc('day', date) + to_hours(CAST(hour(date) // 6 * 6 AS BIGINT))
                            AS window_start,
                          closerStopID AS stationID, vehicleID FROM picked),
counts AS (SELECT window_start, stationID, count(*) AS numVehicles,
                  string_agg(CAST(vehicleID AS VARCHAR), ',' ORDER BY vehicleID) AS vehicles
           FROM pairs GROUP BY 1, 2),
best AS (SELECT window_start, max(numVehicles) AS top FROM counts GROUP BY 1)"""))
def q_stream_busiest(spark: SparkSession, sf: str) -> DataFrame:
    pairs = flatten_window(forms.vehicles_at_stops_windows(bus_stream(spark, sf), width="6 hours",
                                                           delay=LATENESS))
    table, _ = run(pairs, mode="update", label="busiest")
    return forms.busiest_of_windows(table.drop(EPOCH).distinct())


@register_windowed("stream_vehicles_per_stop", with_tables("""
  SELECT date_trunc('hour', date) AS window_start,
         date_trunc('hour', date) + INTERVAL 1 HOUR AS window_end,
         closerStopID AS stationID, count(DISTINCT vehicleID) AS numVehicles,
         TRUE AS approx_within_15pct
  FROM picked GROUP BY 1, 2, 3""",
    f"picked AS (SELECT * FROM telemetry WHERE atStop = 1 AND {HORIZON_SQL})"))
def q_stream_vehicles_per_stop(spark: SparkSession, sf: str) -> DataFrame:
    out = forms.vehicles_per_stop_windows(bus_stream(spark, sf), start=HORIZON_START,
                                          horizon=HORIZON_SECONDS, width="1 hour",
                                          delay=LATENESS)
    table, _ = run_latest(flatten_window(out), [*WINDOW, "stationID"], label="vehicles-per-stop")
    return table.select("window_start", "window_end", "stationID", "numVehicles",
                        forms.within("numVehiclesApprox", "numVehicles")
                        .alias("approx_within_15pct"))


# ---------------------------------------------------------------- running state

@register("stream_complete_sorted", with_tables(f"""
SELECT vehicleID, count(DISTINCT closerStopID) AS numStations, TRUE AS approx_within_15pct
FROM telemetry WHERE {DAY_SQL} GROUP BY 1"""))
def q_stream_complete_sorted(spark: SparkSession, sf: str) -> DataFrame:
    out = forms.distinct_stops_running(bus_stream(spark, sf), day=DAY)
    table, _ = run(out, mode="complete", label="complete-sorted")
    return table.select("vehicleID", "numStations",
                        forms.within("numStationsApprox", "numStations")
                        .alias("approx_within_15pct")).orderBy(F.col("vehicleID").desc())


@register("stream_running_total", with_tables(
    "SELECT vehicleID, CAST(sum(delay) AS BIGINT) AS total FROM telemetry GROUP BY 1"))
def q_stream_running_total(spark: SparkSession, sf: str) -> DataFrame:
    out = forms.running_totals(bus_stream(spark, sf), key="vehicleID", value="delay")
    table, _ = run(out, mode="complete", label="running-total")
    return table


@register("stream_per_batch", with_tables(f"""
SELECT CAST((epoch_us(date) - lo) // ((hi - lo) // {FEED_PARTS} + 1) AS INTEGER) AS batch_id,
       strftime(date, '%H') AS hour,
       round(100.0::DOUBLE * count_if(congestion = 1) / count(*), 2) AS percentage,
       count(*) AS numMeasurements,
       CAST(count_if(congestion = 1) AS BIGINT) AS congestionMeasurements
FROM telemetry, (SELECT min(epoch_us(date)) AS lo, max(epoch_us(date)) AS hi FROM telemetry)
WHERE latitude BETWEEN 53.3343619 AND 53.3702027 AND longitude BETWEEN -6.2886331 AND -6.2043634
  AND isodow(date) <= 5 AND hour(date) IN (7, 8, 9)
GROUP BY 1, 2"""))
def q_stream_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    # Each micro-batch (a stretch of the feed) is analysed on its own by the
    # batch operator, as a per-interval report.
    return run_per_batch(bus_stream(spark, sf), congestion_by_hour, label="per-batch")


PATH_CTES = f"""
pts AS (SELECT vehicleID, date, latitude, longitude,
               lag(date) OVER w AS pdate, lag(latitude) OVER w AS plat,
               lag(longitude) OVER w AS plon
        FROM telemetry WHERE {DAY_SQL}
        WINDOW w AS (PARTITION BY vehicleID ORDER BY date, latitude, longitude)),
steps AS (SELECT vehicleID, pdate, {haversine('plat', 'plon', 'latitude', 'longitude')} AS d,
                 (epoch_us(date) - epoch_us(pdate)) / 1000000.0::DOUBLE AS dt FROM pts),
km AS (SELECT vehicleID,
              sum(CASE WHEN pdate IS NOT NULL AND dt > 0 AND d / dt <= {MAX_SPEED} THEN d ELSE 0.0 END)
                / 1000.0::DOUBLE AS km
       FROM steps GROUP BY vehicleID)"""


def _stream_km(spark: SparkSession, sf: str) -> DataFrame:
    day_rows = bus_stream(spark, sf).where(on_day("date", DAY))
    table, _ = run(path_distance_state(day_rows, max_speed=MAX_SPEED), mode="update",
                   label="path-state")
    return latest_rows(table, ["vehicleID"])


@register("stream_path_distance", with_tables(
    "SELECT vehicleID, round(km, 3) AS km FROM km", PATH_CTES))
def q_stream_path_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _stream_km(spark, sf).select("vehicleID", F.round("km", 3).alias("km"))


@register("stream_distance_histogram", with_tables(f"""
SELECT CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) AS bucket,
       CAST(CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) * {BUCKET_KM} AS VARCHAR) || '_' ||
       CAST(CAST(floor(km / {BUCKET_KM}.0) AS BIGINT) * {BUCKET_KM} + {BUCKET_KM} AS VARCHAR)
         AS bucket_range,
       count(*) AS numVehicles
FROM km GROUP BY 1, 2""", PATH_CTES))
def q_stream_distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    # Running kilometres by batch operators, and after every trigger the
    # histogram over all vehicles; the last epoch's is returned.
    day_rows = bus_stream(spark, sf).where(on_day("date", DAY))
    sink = fresh_dir(spark, "distance-histogram-sink")
    query = histogram_per_batch(day_rows, max_speed=MAX_SPEED, size=BUCKET_KM, sink=sink,
                                checkpoint=fresh_dir(spark, "distance-histogram-ckpt"))
    await_end(query)
    return latest_histogram(spark, sink)


@register("stream_bike_extremes", with_tables("""
SELECT e.hrs AS HOUR, e.min_bike, e.max_bike,
       a.station_id AS min_bike_station_id, b.station_id AS max_bike_station_id
FROM ext e
JOIN avgs a ON a.hrs = e.hrs AND a.bikes = e.min_bike
JOIN avgs b ON b.hrs = e.hrs AND b.bikes = e.max_bike""", BIKE_AVG_SQL))
def q_stream_bike_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """The bike extremes kept current over a feed: averages move both ways, and
    so do the extremes. Those told by the last epoch are returned."""
    good, _ = bike_rows_stream(spark, staged_bike_feed(spark, sf), max_files_per_trigger=FEED_FILES)
    picked = good.where(is_weekday("time") & (F.col("status") == STATUS_OPEN)
                        & hour_between("time", 7, 19)).withColumn("HOUR", F.hour("time"))
    sink = run_extremes(picked, "HOUR", "station_id", "available_bikes", label="bike-extremes",
                        buckets=4)
    return extremes_columns(side_by_side(extremes_after(spark, sink), "HOUR"))


# ---------------------------------------------------------------- restart, late rows

DAILY_SQL = with_tables("""
SELECT date_trunc('day', date) AS window_start,
       date_trunc('day', date) + INTERVAL 1 DAY AS window_end, count(*) AS n
FROM telemetry GROUP BY 1, 2""")

SPLIT_DAY = "2024-01-15"


@register_windowed("stream_upsert_compacted", DAILY_SQL)
def q_stream_upsert_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts in update mode, in a sink that folds every second epoch."""
    sink = run_upsert(_daily_counts(spark, staged_feed(spark, sf)), WINDOW, label="compacted",
                      every=2)
    return sink.table()


def _daily_counts(spark: SparkSession, source: str, delay: str = LATENESS) -> DataFrame:
    return flatten_window(forms.windowed_counts(bus_stream(spark, "", source), width="1 day",
                                                delay=delay))


@register_windowed("stream_restart", DAILY_SQL)
def q_stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Run on the first half of the days, stop, add the rest, restart on the
    same checkpoint: the sink equals a single run over everything."""
    source, sink, ckpt = (fresh_dir(spark, f"restart-{p}") for p in ("src", "sink", "ckpt"))
    rows = telemetry(spark, sf)
    split = F.lit(SPLIT_DAY).cast("timestamp")
    write_feed(rows.where(F.col("date") < split), source, parts=2)
    run_latest(_daily_counts(spark, source), WINDOW, sink=sink, checkpoint=ckpt)
    write_feed(rows.where(F.col("date") >= split), source, parts=2)
    table, _ = run_latest(_daily_counts(spark, source), WINDOW, sink=sink, checkpoint=ckpt)
    return table


@register_windowed("stream_late_rows", DAILY_SQL)
def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """After a run over all readings, the first day's readings arrive again
    (a late re-delivery). They are behind the watermark, dropped, and the daily
    counts do not change."""
    source, sink, ckpt = (fresh_dir(spark, f"late-{p}") for p in ("src", "sink", "ckpt"))
    rows = telemetry(spark, sf)
    write_feed(rows, source)
    run_latest(_daily_counts(spark, source), WINDOW, sink=sink, checkpoint=ckpt)
    first_day_end = F.lit("2024-01-02").cast("timestamp")
    write_lines(bus_lines(rows.where(F.col("date") < first_day_end)), source)
    table, _ = run_latest(_daily_counts(spark, source), WINDOW, sink=sink, checkpoint=ckpt)
    return table
