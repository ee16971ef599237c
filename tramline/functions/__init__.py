from tramline.functions.geo import EARTH_RADIUS_M, haversine_m, seconds_between
from tramline.functions.predicates import (
    contains, hour_between, hour_in, in_box, is_weekday, on_day,
    ts_literal, within_horizon,
)
from tramline.functions.scalars import (
    bucket_index, bucket_label, clock_text, hour_text, on_time_flag, parse_time, percent,
)

__all__ = [
    "EARTH_RADIUS_M", "haversine_m", "seconds_between",
    "contains", "hour_between", "hour_in", "in_box", "is_weekday",
    "on_day", "ts_literal", "within_horizon",
    "bucket_index", "bucket_label", "clock_text", "hour_text", "on_time_flag", "parse_time",
    "percent",
]
