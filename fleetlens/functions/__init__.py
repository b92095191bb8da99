"""Column -> Column building blocks (all native Spark expressions, no Python UDFs)."""

from fleetlens.functions.morton import box_ranges, cell_in_box, cell_of
from fleetlens.functions.predicates import (
    flag_set,
    hour_in,
    in_box,
    in_window,
    is_weekday,
    on_day,
    on_time,
)
from fleetlens.functions.timefmt import (
    day_label,
    hour_label,
    instant_text,
    parse_day,
    parse_instant,
    time_of_day,
    window_bounds,
)

__all__ = [
    "box_ranges",
    "cell_in_box",
    "cell_of",
    "day_label",
    "flag_set",
    "hour_in",
    "hour_label",
    "in_box",
    "in_window",
    "instant_text",
    "is_weekday",
    "on_day",
    "on_time",
    "parse_day",
    "parse_instant",
    "time_of_day",
    "window_bounds",
]
