"""The questions, each a ``DataFrame -> DataFrame`` function over measurements."""

from fleetlens.operators.bitmaps import (
    busiest_stops_bitmap,
    max_vehicles_bitmap,
    vehicles_per_stop_bitmap,
)
from fleetlens.operators.congestion import (
    congestion_by_hour,
    hourly_counts_joined,
    reports_per_hour,
)
from fleetlens.operators.delays import (
    line_abs_delay_average,
    line_delay_average,
    line_delay_sum_count,
)
from fleetlens.operators.history import (
    history_hourly_counts,
    history_line_abs_delay_average,
    history_line_delay_average,
    history_vehicle_lists,
    history_vehicles_per_stop,
)
from fleetlens.operators.occupancy import busiest_stops, max_vehicles, vehicles_per_stop
from fleetlens.operators.selections import (
    at_stop_times,
    congested_reports,
    hour_in_list,
    in_box_reports,
    on_time_flag,
    time_window,
    vehicle_day,
    weekday_reports,
)
from fleetlens.operators.timetable import first_arrivals, first_arrivals_by_delay

__all__ = [
    "at_stop_times",
    "busiest_stops",
    "busiest_stops_bitmap",
    "congested_reports",
    "congestion_by_hour",
    "first_arrivals",
    "first_arrivals_by_delay",
    "history_hourly_counts",
    "history_line_abs_delay_average",
    "history_line_delay_average",
    "history_vehicle_lists",
    "history_vehicles_per_stop",
    "hour_in_list",
    "hourly_counts_joined",
    "in_box_reports",
    "line_abs_delay_average",
    "line_delay_average",
    "line_delay_sum_count",
    "max_vehicles",
    "max_vehicles_bitmap",
    "on_time_flag",
    "reports_per_hour",
    "time_window",
    "vehicle_day",
    "vehicles_per_stop",
    "vehicles_per_stop_bitmap",
    "weekday_reports",
]
