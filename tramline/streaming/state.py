"""Path length per vehicle over a stream, with keyed state.

State per vehicle: the last reading (time, lat, lon), metres so far and the
number of late readings ignored. Each trigger Spark groups the new readings
by vehicle (a shuffle on the key) and calls ``advance`` once per vehicle with
that vehicle's readings of the trigger — so a group is bounded by one
trigger's input (size triggers with ``maxFilesPerTrigger``). Inside, the
step distances are vectorised numpy, not a Python loop per row.

``histogram_per_batch`` keeps the same totals without Python and without one
vehicle's trigger in one task; use it where a vehicle's share may be large.

Readings older than the stored last reading are counted as late and skipped;
pairs with no elapsed time count 0 m; a pair faster than ``max_speed`` m/s is
noise and counts 0 m. With in-order input this equals the batch
``path_distance`` over the whole series (no loss at trigger borders).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tramline.functions.geo import EARTH_RADIUS_M
from tramline.operators.ordered import pair_distances
from tramline.session import ship_package

OUTPUT_SCHEMA = "vehicleID int, km double, late_rows long"
STATE_SCHEMA = "last_us long, lat double, lon double, metres double, late long"


def _haversine_np(lat1, lon1, lat2, lon2) -> np.ndarray:
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dphi, dlmb = np.radians(lat2 - lat1), np.radians(lon2 - lon1)
    a = np.sin(dphi / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dlmb / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(a))


def make_advance(max_speed: float):
    def advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        pdf = pdf.sort_values(["ts_us", "latitude", "longitude"], kind="mergesort")
        if state.exists:
            last_us, lat, lon, metres, late = state.get
        else:
            last_us, lat, lon, metres, late = None, None, None, 0.0, 0
        if last_us is not None:
            is_late = pdf["ts_us"].to_numpy() < last_us
            late += int(is_late.sum())
            pdf = pdf[~is_late]
        ts = pdf["ts_us"].to_numpy(dtype=np.int64)
        la = pdf["latitude"].to_numpy(dtype=float)
        lo = pdf["longitude"].to_numpy(dtype=float)
        if last_us is not None:
            ts = np.concatenate([[last_us], ts])
            la = np.concatenate([[lat], la])
            lo = np.concatenate([[lon], lo])
        if len(ts) >= 2:
            d = _haversine_np(la[:-1], lo[:-1], la[1:], lo[1:])
            dt = (ts[1:] - ts[:-1]) / 1_000_000.0
            with np.errstate(divide="ignore", invalid="ignore"):
                ok = (dt > 0) & (d / np.where(dt > 0, dt, 1.0) <= max_speed)
            metres += float(np.where(ok, d, 0.0).sum())
        if len(ts):
            state.update((int(ts[-1]), float(la[-1]), float(lo[-1]), metres, late))
        yield pd.DataFrame({"vehicleID": [int(key[0])], "km": [metres / 1000.0],
                            "late_rows": [late]})
    return advance


def path_distance_state(df: DataFrame, *, max_speed: float, ts: str = "date") -> DataFrame:
    """Running kilometres per vehicle (update mode)."""
    ship_package(df.sparkSession)     # the state function runs in Python workers
    readings = known(df.withColumn("date", F.col(ts))).select(
        "vehicleID", F.unix_micros("date").alias("ts_us"), "latitude", "longitude")
    return readings.groupBy("vehicleID").applyInPandasWithState(
        make_advance(max_speed), OUTPUT_SCHEMA, STATE_SCHEMA, "update",
        GroupStateTimeout.NoTimeout)


def _totals_step(max_speed: float, ts: str):
    """One epoch of running kilometres, by batch operators: the readings of the
    epoch follow the last known reading of their vehicle (``carry``)."""
    def step(batch: DataFrame, carry: DataFrame | None) -> dict[str, DataFrame]:
        rows = known(batch.select("vehicleID", F.col(ts).alias("date"), "latitude", "longitude"))
        fresh = rows.select("*", F.struct(F.lit(1).alias("new"), "latitude", "longitude")
                            .alias("tie"))
        late = None
        if carry is not None:
            last = carry.select("vehicleID", F.col("date").alias("__last"))
            dated = fresh.join(last, "vehicleID", "left")
            is_late = F.coalesce(F.col("date") < F.col("__last"), F.lit(False))
            late = dated.where(is_late).groupBy("vehicleID").agg(F.count("*").alias("late"))
            fresh = dated.where(~is_late).drop("__last").unionByName(
                carry.select("vehicleID", "date", "latitude", "longitude",
                             F.struct(F.lit(0).alias("new"), "latitude", "longitude").alias("tie")))
        steps = pair_distances(fresh, "vehicleID", "date", "tie", "latitude", "longitude",
                               max_speed=max_speed)
        order = F.struct("date", "tie")
        sums = steps.groupBy("vehicleID").agg(
            F.sum("step_m").alias("m"), F.max("date").alias("date"),
            F.max_by("latitude", order).alias("latitude"),
            F.max_by("longitude", order).alias("longitude"))
        if carry is None:
            return {"carry": sums.withColumnRenamed("m", "metres")
                    .withColumn("late_rows", F.lit(0).cast("long"))}
        return {"carry": sums.join(carry.select("vehicleID", "metres", "late_rows"), "vehicleID",
                                   "left").join(late, "vehicleID", "left").select(
            "vehicleID", (F.coalesce("metres", F.lit(0.0)) + F.col("m")).alias("metres"), "date",
            "latitude", "longitude",
            (F.coalesce("late_rows", F.lit(0)) + F.coalesce("late", F.lit(0))).alias("late_rows"))}
    return step


def known(rows: DataFrame) -> DataFrame:
    """Readings that have a vehicle, a time and a place (others are for the
    bad-record side of the scans)."""
    return rows.dropna(subset=["vehicleID", "date", "latitude", "longitude"])


def histogram_per_batch(readings: DataFrame, *, max_speed: float, size: float, sink: str,
                        checkpoint: str, processing_time: str | None = None, ts: str = "date"):
    """Keep a histogram of kilometres per vehicle current after every trigger.

    The totals (one row per vehicle: kilometres, last reading, late readings)
    are carried from epoch to epoch. Steps inside an epoch are computed by the
    batch operator, which splits a hot vehicle into time slices, so no task
    holds one vehicle's whole trigger. Late readings are counted and skipped."""
    from tramline.operators.grouped import bucket_histogram
    from tramline.streaming.runner import carried

    totals = _totals_step(max_speed, ts)

    def histogram(written: dict[str, DataFrame]) -> DataFrame:
        km = written["carry"].select("vehicleID", (F.col("metres") / F.lit(1000.0)).alias("km"))
        return bucket_histogram(km, "km", size, count="numVehicles")

    def step(batch: DataFrame, carry: DataFrame | None) -> dict:
        return {**totals(batch, carry), "histogram": histogram}

    return carried(readings, step, sink=sink, checkpoint=checkpoint,
                   processing_time=processing_time)


def latest_histogram(spark, sink: str) -> DataFrame:
    """The histogram written by the last epoch (only that one is read)."""
    from tramline.streaming.runner import EPOCH, epochs
    last = epochs(spark, f"{sink}/histogram")[-1]
    return spark.read.parquet(f"{sink}/histogram/{EPOCH}={last}")
