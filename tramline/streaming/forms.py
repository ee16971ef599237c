"""Streaming forms of the analyses (valid on streaming and batch frames).

Event time is the reading's own ``date``. Filters are applied before
``withWatermark`` so the watermark follows exactly the rows the aggregate
sees. ``window_ts`` names another time for windows and watermark, such as the
time of arrival. Order-dependent operators that cannot use window functions on
a stream run batch operators on each micro-batch and carry a small table on
(change points), or keep keyed state (path length). In append mode a window is
returned once the watermark has passed it; ``runner.run_latest`` returns every
window.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.predicates import hour_in, in_box, is_weekday, on_day, within_horizon
from tramline.functions.scalars import clock_text, hour_text, on_time_flag, percent
from tramline.operators.grouped import running_total
from tramline.operators.ordered import change_points
from tramline.plans.transit import CITY_BOX, PEAK_HOURS

TS = "date"


def _window(ts: str, width: str, slide: str | None = None):
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def windowed_counts(df: DataFrame, *, width: str, slide: str | None = None,
                    delay: str = "0 seconds", ts: str = TS,
                    window_ts: str | None = None) -> DataFrame:
    """Rows per event-time window (tumbling, or sliding with ``slide``)."""
    wt = window_ts or ts
    return (df.withWatermark(wt, delay).groupBy(_window(wt, width, slide).alias("window"))
            .agg(F.count(F.lit(1)).alias("n")))


def windowed_counts_panes(df: DataFrame, *, width: str, slide: str, delay: str = "0 seconds",
                          ts: str = TS, window_ts: str | None = None) -> DataFrame:
    """Rows per sliding window, from panes: tumbling windows of ``slide`` are
    counted first, and a closed pane (one row) goes into each window it is part
    of. A reading is not copied into ``width / slide`` windows, and there is state
    for a reading's pane, not for each of its windows. ``width`` must be a
    multiple of ``slide``. For append mode, in which a window is told once."""
    wt = window_ts or ts
    panes = (df.withWatermark(wt, delay).groupBy(_window(wt, slide).alias("pane"))
             .agg(F.count(F.lit(1)).alias("n")))
    return panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("window")).agg(
        F.sum("n").alias("n"))


def congestion_windows(df: DataFrame, *, width: str, box: dict = CITY_BOX,
                       hours: Iterable = PEAK_HOURS, delay: str = "0 seconds",
                       ts: str = TS, window_ts: str | None = None) -> DataFrame:
    """Congestion share per (window, hour of day). Weekday and hour come from
    the reading's time ``ts``; the window and watermark use ``window_ts``
    (default ``ts``; an arrival-time column gives arrival-time windows)."""
    wt = window_ts or ts
    picked = df.where(in_box("latitude", "longitude", **box) & is_weekday(ts) & hour_in(ts, hours))
    agg = (picked.withWatermark(wt, delay)
           .groupBy(F.window(wt, width).alias("window"), hour_text(ts).alias("hour"))
           .agg(F.count(F.lit(1)).alias("numMeasurements"),
                F.sum("congestion").alias("congestionMeasurements")))
    return agg.select("window", "hour", percent("congestionMeasurements", "numMeasurements")
                      .alias("percentage"), "numMeasurements", "congestionMeasurements")


def arrivals_sliding(df: DataFrame, *, vehicle: int, day: str, width: str, slide: str,
                     delay: str = "0 seconds", ts: str = TS,
                     window_ts: str | None = None) -> DataFrame:
    """A vehicle's distinct (time of day, line, stop) at-stop triples per
    sliding window; ints stay ints and the window is kept, so a triple seen
    in two windows appears once per window."""
    picked = df.where((F.col("atStop") != 0) & (F.col("vehicleID") == vehicle) & on_day(ts, day))
    triple = [clock_text(ts).alias("arrival_time"), F.col("busLineID").alias("lineID"),
              F.col("closerStopID").alias("stationID")]
    # The triples are keys of the state: no list of a window's triples is built.
    wt = window_ts or ts
    seen = (picked.withWatermark(wt, delay)
            .groupBy(F.window(wt, width, slide).alias("window"), *triple)
            .agg(F.count(F.lit(1)).alias("n")))
    return seen.drop("n")


def distinct_stops_running(df: DataFrame, *, day: str, rsd: float = 0.05,
                           ts: str = TS) -> DataFrame:
    """Distinct stops per vehicle on a day, running over the stream, vehicle
    descending (complete mode): HLL++ estimate (``numStationsApprox``) and
    the exact count (``size(collect_set)``; the set per vehicle is bounded by
    the number of stops)."""
    picked = df.where(on_day(ts, day))
    return (picked.groupBy("vehicleID")
            .agg(F.approx_count_distinct("closerStopID", rsd).alias("numStationsApprox"),
                 F.size(F.collect_set("closerStopID")).cast("long").alias("numStations"))
            .orderBy(F.col("vehicleID").desc()))


def running_totals(df: DataFrame, *, key: str, value: str, out: str = "total") -> DataFrame:
    """Running total per key (complete or update mode): the batch operator,
    kept incrementally by the streaming aggregate's state."""
    return running_total(df, key, value, out=out)


def change_points_step(*, width: str, slide: str | None = None,
                       partition: tuple[str, ...] = ("vehicleID", "busLineID"), ts: str = TS,
                       window_ts: str | None = None):
    """A step for ``runner.carried``: at-stop readings with consecutive repeats
    of a stop collapsed, per series (``partition``) inside each event-time
    window (tumbling, or sliding with ``slide``), ties ordered by stop and delay.

    The batch operator does the work, so a hot series is split into time
    slices; only the last reading of each open series is carried on. Readings
    older than that, or of windows that are over, are late: counted in
    ``late``, not used."""
    keys = ["window_start", "window_end", *partition]
    cols = [*keys, "date", "closerStopID", "delay"]

    def dated(rows: DataFrame) -> DataFrame:
        """Adds the order of readings of one time, as one number."""
        least = F.lit(-(1 << 31))
        stop, late_by = (F.coalesce(F.col(c), least).cast("long") for c in ("closerStopID", "delay"))
        return rows.select(*cols, (F.shiftleft(stop, 32) + late_by - least).alias("tie"))

    def step(batch: DataFrame, carry: DataFrame | None) -> dict[str, DataFrame]:
        wt = window_ts or ts
        # A window never holds a NULL time: such rows have no window.
        rows = (batch.where(F.col("atStop") != 0)
                .select(_window(wt, width, slide).alias("window"), *partition,
                        F.col(ts).alias("date"), "closerStopID", "delay")
                .select(F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"),
                        *partition, "date", "closerStopID", "delay"))
        first, newest = rows.agg(F.min(F.unix_micros("date")), F.max(F.unix_micros("date"))).first()
        late = rows.limit(0)
        if carry is not None:
            now = carry.agg(F.max(F.unix_micros("date"))).first()[0]
            # Only a batch that starts before the newest reading can have late ones.
            if None not in (now, first) and first < now:
                last = carry.select(*[F.col(c).alias(f"__{c}") for c in keys],
                                    F.col("date").alias("__last"))
                same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys))
                known = rows.join(last, same, "left")
                is_late = F.coalesce((F.col("date") < F.col("__last"))
                                     | (F.unix_micros("window_end") <= F.lit(now)), F.lit(False))
                late, rows = known.where(is_late), known.where(~is_late).select(*cols)
            newest = max((x for x in (now, newest) if x is not None), default=None)
            carry = dated(carry)
        rows = dated(rows)
        changes = change_points(rows, keys, "date", "tie", "closerStopID", before=carry)
        ends = rows.withColumn("new", F.lit(1))
        if carry is not None:
            ends = ends.unionByName(carry.withColumn("new", F.lit(0)))
        # Of one time, a reading of this epoch is after the one carried to it.
        wide = "decimal(38,0)"
        order = ((F.unix_micros("date").cast(wide) * 2 + F.col("new"))
                 * F.lit(Decimal(1 << 64)).cast(wide) + F.col("tie").cast(wide))
        ends = ends.withColumn("at", order).groupBy(*keys).agg(
            *[F.max_by(c, "at").alias(c) for c in ("date", "closerStopID", "delay")])
        still = ends.where(F.unix_micros("window_end") > F.lit(newest))
        return {"carry": still, "changes": changes.select(*cols),
                "late": late.groupBy().agg(F.count("*").alias("late_rows"))}

    return step


def arrivals_of(changes: DataFrame, delay_limit: int) -> DataFrame:
    """Collapsed readings as arrivals: line, stop, time of day, on-time flag."""
    return changes.select("window_start", "window_end", F.col("busLineID").alias("lineID"),
                          F.col("closerStopID").alias("stationID"),
                          clock_text("date").alias("arrivalTime"),
                          on_time_flag("delay", delay_limit).alias("onTime"))


def vehicles_at_stops_windows(df: DataFrame, *, width: str, delay: str = "0 seconds",
                              ts: str = TS, window_ts: str | None = None) -> DataFrame:
    """Distinct (window, stop, vehicle) at stop: one small state row each."""
    wt = window_ts or ts
    return (df.where(F.col("atStop") == 1).withWatermark(wt, delay)
            .groupBy(F.window(wt, width).alias("window"), F.col("closerStopID").alias("stationID"),
                     "vehicleID").agg(F.count(F.lit(1)).alias("n")).drop("n"))


def busiest_of_windows(pairs: DataFrame) -> DataFrame:
    """Per window (``window_start``, ``window_end``): the stop(s) with the most
    distinct vehicles, ties kept, with the sorted vehicle list, of the distinct
    (window, stop, vehicle) rows a stream has gathered."""
    window = ["window_start", "window_end"]
    per_stop = pairs.groupBy(*window, "stationID").agg(
        F.count("vehicleID").alias("numVehicles"),
        F.array_join(F.array_sort(F.collect_list("vehicleID")), ",").alias("vehicles"))
    top = per_stop.groupBy(*window).agg(F.max("numVehicles").alias("numVehicles"))
    return per_stop.join(top, [*window, "numVehicles"]).select(
        *window, "stationID", "vehicles", "numVehicles")


def vehicles_per_stop_windows(df: DataFrame, *, start: str, horizon: int, width: str,
                              delay: str = "0 seconds", rsd: float = 0.05, ts: str = TS,
                              window_ts: str | None = None) -> DataFrame:
    """Distinct vehicles at each stop per event-time window, inside the
    horizon [start, start + horizon]: HLL++ estimate (``numVehiclesApprox``)
    and the exact count (``size(collect_set)``, bounded by the fleet)."""
    wt = window_ts or ts
    picked = df.where((F.col("atStop") == 1) & within_horizon(ts, start, horizon))
    return (picked.withWatermark(wt, delay)
            .groupBy(F.window(wt, width).alias("window"), F.col("closerStopID").alias("stationID"))
            .agg(F.approx_count_distinct("vehicleID", rsd).alias("numVehiclesApprox"),
                 F.size(F.collect_set("vehicleID")).cast("long").alias("numVehicles")))


def within(approx: str, exact: str, tolerance: float = 0.15):
    """Boolean: an estimate is within ``tolerance`` of the exact value."""
    return F.abs(F.col(approx) - F.col(exact)) <= F.col(exact) * F.lit(tolerance)
