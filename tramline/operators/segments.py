"""Path length as a fold of segments, for readings that are stored by slice.

What a stretch of a vehicle's readings adds to its path is summed up in four
things: the first reading, the last one, the metres between, and how many
readings there are. Two stretches that follow each other combine into one (the
step from the last reading of the one to the first of the other is added), and
it does not matter in which order the combining is done: an associative fold.

``segments`` sums up every (key, slice). On a table bucketed by these
(``sources.side_tables``) it runs inside each stored bucket: the window and the
aggregate both need the rows by (key, slice), which is how they lie, so no row
is shuffled. ``folded`` combines the segments of a key in time order; only they,
a row per key and slice, go through an exchange. With ``coarse_slices`` it folds
twice, runs of that many slices first, so that a key with years of slices is
combined in many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m, seconds_between
from tramline.operators.ordered import reading_order

FIRST, LAST, METRES, COUNT = "first", "last", "metres", "readings"


def _step(before: str, after: str, ts: str, lat: str, lon: str, max_speed: float) -> Column:
    """Metres from one reading (a struct) to the next, 0 if they are noise."""
    d = haversine_m(F.col(f"{before}.{lat}"), F.col(f"{before}.{lon}"),
                    F.col(f"{after}.{lat}"), F.col(f"{after}.{lon}"))
    dt = seconds_between(F.col(f"{before}.{ts}"), F.col(f"{after}.{ts}"))
    keep = (dt > 0) & (F.try_divide(d, dt) <= F.lit(float(max_speed)))
    return F.when(keep, d).otherwise(F.lit(0.0))


def segments(df: DataFrame, keys: Sequence[str], slice_col: str, ts: str, tiebreak: str, lat: str,
             lon: str, *, max_speed: float) -> DataFrame:
    """(keys, slice, first, last, metres, readings) of every (key, slice)."""
    here = F.struct(ts, lat, lon)
    w = Window.partitionBy(*keys, slice_col).orderBy(ts, tiebreak)
    steps = (df.select(*keys, slice_col, here.alias("here"), F.lag(here).over(w).alias("before"),
                       reading_order(ts, tiebreak).alias("at"))
             .withColumn("step", F.when(F.col("before").isNull(), 0.0).otherwise(
                 _step("before", "here", ts, lat, lon, max_speed))))
    # Field by field: the buffers have fixed widths, so Spark aggregates by hash.
    ends = [f(F.col(f"here.{c}"), F.col("at")).alias(f"{n}_{c}")
            for n, f in ((FIRST, F.min_by), (LAST, F.max_by)) for c in (ts, lat, lon)]
    summed = steps.groupBy(*keys, slice_col).agg(
        *ends, F.sum("step").alias(METRES), F.count(F.lit(1)).alias(COUNT))
    return summed.select(*keys, slice_col, *[
        F.struct(*[F.col(f"{n}_{c}").alias(c) for c in (ts, lat, lon)]).alias(n)
        for n in (FIRST, LAST)], METRES, COUNT)


def combined(parts: DataFrame, keys: Sequence[str], order: str, ts: str, lat: str, lon: str, *,
             max_speed: float, within: str | None = None) -> DataFrame:
    """Segments combined, in the order of ``order``, into one for each key (and
    value of ``within``, a column that does not fall as ``order`` rises)."""
    by = [*keys, *([within] if within else [])]
    w = Window.partitionBy(*by).orderBy(order)
    joined = parts.withColumn("__before", F.lag(LAST).over(w)).withColumn(
        METRES, F.col(METRES) + F.when(F.col("__before").isNull(), 0.0).otherwise(
            _step("__before", FIRST, ts, lat, lon, max_speed)))
    return joined.groupBy(*by).agg(
        F.min_by(FIRST, order).alias(FIRST), F.max_by(LAST, order).alias(LAST),
        F.sum(METRES).alias(METRES), F.sum(COUNT).alias(COUNT))


def folded(parts: DataFrame, keys: Sequence[str], slice_col: str, ts: str, lat: str, lon: str, *,
           max_speed: float, coarse_slices: int | None = None) -> DataFrame:
    """One segment for each key, of all its slices; ``coarse_slices`` folds runs
    of that many slices first."""
    if coarse_slices:
        coarse = parts.withColumn("__coarse", F.floor(F.col(slice_col) / F.lit(coarse_slices)))
        parts = combined(coarse, keys, slice_col, ts, lat, lon, max_speed=max_speed,
                         within="__coarse")
        slice_col = "__coarse"
    return combined(parts, keys, slice_col, ts, lat, lon, max_speed=max_speed)


def path_distance_folded(df: DataFrame, entity: str, slice_col: str, ts: str, tiebreak: str,
                         lat: str, lon: str, *, max_speed: float, out: str = "km",
                         coarse_slices: int | None = None) -> DataFrame:
    """Kilometres per entity, like ``path_distance``, of readings by slice."""
    parts = segments(df, [entity], slice_col, ts, tiebreak, lat, lon, max_speed=max_speed)
    whole = folded(parts, [entity], slice_col, ts, lat, lon, max_speed=max_speed,
                   coarse_slices=coarse_slices)
    return whole.select(entity, (F.col(METRES) / F.lit(1000.0)).alias(out))
