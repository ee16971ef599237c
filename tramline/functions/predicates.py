"""Row predicates as Spark ``Column`` expressions.

All are built-in expressions (codegen, no Python per row). Time tests are
written as ranges on the timestamp column itself so that, when the column is
stored, Catalyst pushes them to the scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_literal(text: str) -> Column:
    """A timestamp literal parsed in the session zone (constant-folded)."""
    return F.lit(text).cast("timestamp")


def in_box(lat: str | Column, lon: str | Column, *, north: float, east: float,
           south: float, west: float) -> Column:
    """Closed bounding box: points on any border are inside."""
    return _c(lat).between(F.lit(south), F.lit(north)) & _c(lon).between(F.lit(west), F.lit(east))


def is_weekday(ts: str | Column, *, day_col: str | None = None) -> Column:
    """Monday to Friday (``weekday``: Monday = 0 ... Sunday = 6).

    With ``day_col`` (a stored ``to_date(ts)``, e.g. a partition column) the
    same test on it prunes weekend partitions."""
    cond = F.weekday(_c(ts)) < 5
    if day_col:
        cond = cond & (F.weekday(F.col(day_col)) < 5)
    return cond


def hour_in(ts: str | Column, hours: Iterable[int | str]) -> Column:
    """Hour of day in a list; accepts ints or zero-padded strings ("07")."""
    wanted = sorted({int(h) for h in hours})
    return F.hour(_c(ts)).isin(wanted)


def hour_between(ts: str | Column, first: int, last: int) -> Column:
    """Hour of day in the closed range [first, last] (19 keeps 19:59:59)."""
    return F.hour(_c(ts)).between(first, last)


def _days(col: str, first: dt.date, last: dt.date) -> Column:
    return F.col(col).between(F.lit(first.isoformat()).cast("date"),
                              F.lit(last.isoformat()).cast("date"))


def on_day(ts: str | Column, day: str, *, day_col: str | None = None) -> Column:
    """Timestamp falls on calendar day ``day`` (yyyy-MM-dd), as a range.

    ``day_col`` names a stored date column equal to ``to_date(ts)`` (e.g. the
    partition column of a day-partitioned table); the same day is then also
    required of it, which lets Spark prune partitions."""
    start = ts_literal(day)
    cond = (_c(ts) >= start) & (_c(ts) < start + F.expr("INTERVAL 1 DAY"))
    if day_col:
        d = dt.date.fromisoformat(day[:10])
        cond = cond & _days(day_col, d, d)
    return cond


def within_horizon(ts: str | Column, start: str, seconds: int, *,
                   day_col: str | None = None) -> Column:
    """Closed horizon ``[start, start + seconds]`` (``day_col`` as in ``on_day``)."""
    lo = ts_literal(start)
    cond = _c(ts).between(lo, lo + F.make_dt_interval(secs=F.lit(seconds)))
    if day_col:
        first = dt.datetime.fromisoformat(start)
        last = first + dt.timedelta(seconds=seconds)
        cond = cond & _days(day_col, first.date(), last.date())
    return cond


def contains(col: str | Column, text: str) -> Column:
    """Substring test, e.g. a day on a raw text line before parsing."""
    return _c(col).contains(text)
