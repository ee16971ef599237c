"""Scalar helpers: time text, flags, bucket labels, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.sources.schemas import TIME_FORMAT


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_time(text: str | Column, fmt: str = TIME_FORMAT) -> Column:
    """Text to timestamp; NULL (not an error) when it does not parse."""
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def hour_text(ts: str | Column) -> Column:
    """Zero-padded hour of day, "07"."""
    return F.date_format(_c(ts), "HH")


def clock_text(ts: str | Column) -> Column:
    """Time of day as "HH:mm:ss"."""
    return F.date_format(_c(ts), "HH:mm:ss")


def on_time_flag(delay: str | Column, limit: int) -> Column:
    """1 when |delay| <= |limit|, else 0."""
    return F.when(F.abs(_c(delay)) <= abs(limit), F.lit(1)).otherwise(F.lit(0))


def bucket_index(value: str | Column, size: float) -> Column:
    """Fixed-width bucket number, ``floor(value / size)``."""
    return F.floor(_c(value) / F.lit(float(size)))


def bucket_label(index: str | Column, size: float) -> Column:
    """Range label ``lo_hi`` of a bucket, e.g. 30_40 for index 3, size 10."""
    idx = _c(index)
    if float(size).is_integer():
        lo = idx * F.lit(int(size))
        return F.concat_ws("_", lo.cast("string"), (lo + F.lit(int(size))).cast("string"))
    lo = idx * F.lit(float(size))
    return F.concat_ws("_", lo.cast("string"), (lo + F.lit(float(size))).cast("string"))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``round(100 * part / whole, digits)``, half up; NULL for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * _c(part), _c(whole)), digits)
