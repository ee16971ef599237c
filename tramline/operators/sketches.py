"""Distinct members per group and hour as mergeable sketches.

A side table has, for each (group, hour), a HyperLogLog sketch of the members,
their exact number, and the readings. Sketches of hours merge into the sketch of
any horizon, so a count over months reads a few kilobytes for a group and hour
and no reading. Where a horizon starts or ends within an hour, the readings of
those two hours alone are sketched as they are and merged in.

``busiest_bounded`` finds the groups with the most members over a horizon,
exactly, but builds member pairs only for groups that could win. What decides is
certain, not estimated: a group has at least the members of its best hour, and
at most the sum over its hours. A group whose sum is below the highest "at
least" cannot be first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.predicates import ts_literal, within_horizon
from tramline.operators.extremes import busiest_with_ties

HOUR, SKETCH, EXACT = "hour", "sketch", "exact"
#: 2^12 registers: a standard error of 1.6 %, exact for small sets.
LG_K = 12


def hourly_sketches(df: DataFrame, group: str, member: str, ts: str = "date", *,
                    lg_k: int = LG_K) -> DataFrame:
    """(group, hour, sketch, exact, readings), of all readings of ``df``. Members
    of a (group, hour) are made distinct first, so a hot one ships few rows."""
    distinct = df.groupBy(group, F.date_trunc("hour", ts).alias(HOUR), member).agg(
        F.count(F.lit(1)).alias("n"))
    return distinct.groupBy(group, HOUR).agg(
        F.hll_sketch_agg(member, lg_k).alias(SKETCH), F.count(member).alias(EXACT),
        F.sum("n").alias("readings"))


def whole_hours(start: str, seconds: int) -> tuple[dt.datetime, dt.datetime]:
    """First whole hour of the closed horizon, and the end of its last one."""
    first = dt.datetime.fromisoformat(start)
    last = first + dt.timedelta(seconds=seconds)
    up = first.replace(minute=0, second=0, microsecond=0)
    up += dt.timedelta(hours=1) if up < first else dt.timedelta()
    return up, max(up, last.replace(minute=0, second=0, microsecond=0))


def _text(at: dt.datetime) -> str:
    return at.isoformat(sep=" ")


def sketched_hours(sketches: DataFrame, start: str, seconds: int) -> DataFrame:
    """The stored rows of the whole hours of a horizon."""
    low, high = whole_hours(start, seconds)
    return sketches.where((F.col(HOUR) >= ts_literal(_text(low)))
                          & (F.col(HOUR) < ts_literal(_text(high))))


def edges(start: str, seconds: int, ts: str = "date", *, day_col: str | None = None) -> Column:
    """Readings of the horizon outside its whole hours."""
    low, high = (ts_literal(_text(x)) for x in whole_hours(start, seconds))
    return within_horizon(ts, start, seconds, day_col=day_col) & (
        (F.col(ts) < low) | (F.col(ts) >= high))


def distinct_sketched(sketches: DataFrame, group: str, *, start: str, seconds: int,
                      readings: DataFrame | None = None, member: str = "", ts: str = "date",
                      out: str = "n", lg_k: int = LG_K) -> DataFrame:
    """Estimated distinct members per group in [start, start + seconds], from the
    sketches; without ``readings`` the parts of an hour at its ends are left out."""
    rows = sketched_hours(sketches, start, seconds).select(group, SKETCH)
    if readings is not None:
        rest = readings.where(edges(start, seconds, ts))
        rows = rows.unionByName(rest.groupBy(group).agg(
            F.hll_sketch_agg(member, lg_k).alias(SKETCH)))
    return rows.groupBy(group).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(out))


def may_be_busiest(sketches: DataFrame, group: str, *, start: str, seconds: int,
                   readings: DataFrame | None = None, ts: str = "date") -> DataFrame:
    """The groups whose members, hour by hour, could be as many as those of the
    group that certainly has most: a column of few groups."""
    rows = sketched_hours(sketches, start, seconds).select(group, EXACT)
    if readings is not None:  # readings bound members from above
        rest = readings.where(edges(start, seconds, ts)).groupBy(group).agg(
            F.count(F.lit(1)).alias("__most"))
        rows = rows.withColumn("__most", F.col(EXACT)).unionByName(
            rest.withColumn(EXACT, F.lit(1).cast("long")))
    else:
        rows = rows.withColumn("__most", F.col(EXACT))
    bounds = rows.groupBy(group).agg(F.max(EXACT).alias("at_least"), F.sum("__most").alias("at_most"))
    floor = bounds.agg(F.max("at_least").alias("__floor"))  # one row
    return bounds.join(F.broadcast(floor), F.col("at_most") >= F.col("__floor")).select(group)


def busiest_bounded(readings: DataFrame, sketches: DataFrame, group: str, member: str, *,
                    start: str, seconds: int, ts: str = "date", **how) -> DataFrame:
    """``busiest_with_ties`` of the readings in the horizon, over the groups that
    the side table leaves in question. NULL groups have no members counted."""
    left = may_be_busiest(sketches, group, start=start, seconds=seconds, readings=readings, ts=ts)
    # Both sides are hashed by the group; AQE broadcasts the few groups.
    return busiest_with_ties(readings.join(left, group, "left_semi"), group, member, **how)
