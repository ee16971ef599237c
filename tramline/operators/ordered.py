"""Operators over ordered series: previous row, change points, path length.

All of them need, for each row, the row before it in its series (same key,
ordered by time and a unique tie-breaker). A plain ``lag`` over
``Window.partitionBy(key)`` puts a whole series into one task, so one hot
vehicle holding a third of the data would be one task. ``with_previous``
splits every series into time slices instead:

1. the last row of every (key, slice) is found with a decomposable
   aggregate (``max_by`` on one numeric order of (ts, tie)), combined
   map-side, so the shuffle carries one row per key, slice and task;
2. a ``lag`` over that small slice table (per key, ordered by slice) moves
   each slice's last row to the next non-empty slice of its key;
3. the moved rows are added to the rows as markers that come first in their
   slice, and one ``lag`` inside each (key, slice) gives every row its
   predecessor; then the markers go. There is no join: the rows are shuffled
   and sorted once, by (key, slice), NULL keys are keys like any other, and a
   hot key fans out to as many tasks as it has slices.

The result is exact: the first row of a slice sees the last row of the
previous non-empty slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.geo import haversine_m, seconds_between

DEFAULT_SLICE_SECONDS = 3600

_SLICE = "__slice"
_LAST = "__last_of_slice"
_CARRY = "__carry"
_MARK = "__mark"
_SEED = "__seed"


def payload_names(ts: str, tiebreak: str, cols: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([ts, tiebreak, *cols]))


def _payload(ts: str, tiebreak: str, cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in payload_names(ts, tiebreak, cols)])


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def reading_order(ts: str, tiebreak: str) -> Column:
    """One number that orders readings by time and an integral tie-breaker. A
    NULL time counts as 0 (rows of NULL times are not mixed with others); a NULL
    tie-breaker comes before all others."""
    dec = "decimal(38,0)"
    return (F.coalesce(F.unix_micros(F.col(ts)), F.lit(0)).cast(dec)
            * F.lit(Decimal(10 ** 19)).cast(dec)
            + F.coalesce(F.col(tiebreak).cast(dec) + F.lit(Decimal(2 ** 63)).cast(dec),
                         F.lit(Decimal(-1)).cast(dec)))


def _slice_last(df: DataFrame, keys: list[str], ts: str, tiebreak: str,
                cols: Sequence[str]) -> DataFrame:
    """The last row (by ts, tiebreak) of every (key, slice), as a struct.

    With an integral tie-breaker the order is one DECIMAL(38,0) number,
    ``micros(ts) * 10^19 + (tiebreak + 2^63)``, and every field is taken with
    ``max_by(field, order)``: all buffers are fixed-width, so Spark runs a
    hash aggregate (partial, map-side). Otherwise ``max(struct)`` (a sort-
    based aggregate) is used."""
    names = payload_names(ts, tiebreak, cols)
    if isinstance(df.schema[tiebreak].dataType, _INTEGRAL):
        order = reading_order(ts, tiebreak)
        picked = df.withColumn("__order", order).groupBy(*keys, _SLICE).agg(
            *[F.max_by(c, "__order").alias(c) for c in names])
        return picked.select(*keys, _SLICE, F.struct(*names).alias(_LAST))
    return df.groupBy(*keys, _SLICE).agg(F.max(_payload(ts, tiebreak, cols)).alias(_LAST))


def with_previous(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
                  cols: Sequence[str], *, prev: str = "prev",
                  slice_seconds: int | None = DEFAULT_SLICE_SECONDS,
                  before: DataFrame | None = None) -> DataFrame:
    """Add struct column ``prev`` = (ts, tiebreak, *cols) of the previous row.

    The series is ``keys``, ordered by (``ts``, ``tiebreak``); ``tiebreak``
    must make the order total. NULL keys are a key like any other, and rows with
    a NULL time come first in their series, for every ``slice_seconds``;
    ``slice_seconds=None`` uses one window per key, for series known to be small.
    ``before`` has a row for each series that goes on from an earlier table: what
    stands before the first row here (it is not returned).
    """
    keys = list(keys)
    payload = _payload(ts, tiebreak, cols)
    if slice_seconds is None:
        if before is not None:
            raise ValueError("series that go on are read in slices")
        w = Window.partitionBy(*keys).orderBy(ts, tiebreak)
        return df.withColumn(prev, F.lag(payload).over(w))

    sliced = df.withColumn(_SLICE, F.floor(F.unix_seconds(F.col(ts)) / F.lit(slice_seconds)))
    lasts = _slice_last(sliced, keys, ts, tiebreak, cols)
    if before is not None:
        lasts = lasts.withColumn(_SEED, F.lit(False)).unionByName(before.select(
            *keys, payload.alias(_LAST), F.lit(True).alias(_SEED)), allowMissingColumns=True)
    else:
        lasts = lasts.withColumn(_SEED, F.lit(False))
    w_slices = Window.partitionBy(*keys).orderBy(F.desc(_SEED), _SLICE)
    moved = lasts.select(*keys, _SLICE, _SEED, F.lag(_LAST).over(w_slices).alias(_CARRY)).where(
        F.col(_CARRY).isNotNull() & ~F.col(_SEED))
    named = [c for c in payload_names(ts, tiebreak, cols) if c not in keys]
    markers = moved.select(*keys, _SLICE, *[F.col(f"{_CARRY}.{c}").alias(c) for c in named],
                           F.lit(True).alias(_MARK))
    rows = sliced.withColumn(_MARK, F.lit(False)).unionByName(markers, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _SLICE).orderBy(F.desc(_MARK), ts, tiebreak)
    return (rows.withColumn(prev, F.lag(payload).over(w))
            .where(~F.col(_MARK)).drop(_MARK, _SLICE))


def change_points(df: DataFrame, partition: Sequence[str], ts: str, tiebreak: str,
                  value: str, *, slice_seconds: int | None = DEFAULT_SLICE_SECONDS,
                  before: DataFrame | None = None) -> DataFrame:
    """Collapse consecutive repeats: keep rows whose ``value`` differs from
    the previous row of the series (the first row is always kept, unless the
    series goes on from a row of ``before``).

    Output rows are the kept input rows, unchanged.
    """
    marked = with_previous(df, partition, ts, tiebreak, [value], prev="__cp_prev",
                           slice_seconds=slice_seconds, before=before)
    changed = ~F.col(value).eqNullSafe(F.col(f"__cp_prev.{value}"))
    return marked.where(F.col("__cp_prev").isNull() | changed).drop("__cp_prev")


def pair_distances(df: DataFrame, entity: str, ts: str, tiebreak: str, lat: str, lon: str,
                   *, max_speed: float, segment: str | None = None,
                   slice_seconds: int | None = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """Per reading: metres from the previous reading of the same entity
    (and segment), kept only when time passed and the speed is at most
    ``max_speed`` m/s; otherwise 0 (noise). Adds ``step_m``.
    """
    keys = [entity] + ([segment] if segment else [])
    marked = with_previous(df, keys, ts, tiebreak, [lat, lon], prev="__pd_prev",
                           slice_seconds=slice_seconds)
    d = haversine_m(F.col(f"__pd_prev.{lat}"), F.col(f"__pd_prev.{lon}"), lat, lon)
    dt = seconds_between(F.col(f"__pd_prev.{ts}"), F.col(ts))
    keep = (dt > 0) & (F.try_divide(d, dt) <= F.lit(float(max_speed)))
    return marked.withColumn("step_m", F.when(keep, d).otherwise(F.lit(0.0))).drop("__pd_prev")


def path_distance(df: DataFrame, entity: str, ts: str, tiebreak: str, lat: str, lon: str,
                  *, max_speed: float, segment: str | None = None, out: str = "km",
                  slice_seconds: int | None = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """Kilometres travelled per entity, with speed-noise filtering.

    With ``segment`` the series is cut at segment borders (pairs across a
    border are not counted), which reproduces per-interval sums.
    The final sum is a partial (map-side) + final aggregate.
    """
    steps = pair_distances(df, entity, ts, tiebreak, lat, lon, max_speed=max_speed,
                           segment=segment, slice_seconds=slice_seconds)
    return steps.groupBy(entity).agg((F.sum("step_m") / F.lit(1000.0)).alias(out))
