from tapemill.functions.numeric import (
    exact_mean_price,
    exact_volume,
    grouped_text,
    percent_text,
    table_price,
    usable_price,
    usable_qty,
)
from tapemill.functions.temporal import (
    display_time,
    event_time,
    floor_hour,
    instant,
    minute_label,
    parse_time,
    since,
    usable_time,
    utc_date,
    utc_hour,
)

__all__ = [
    "display_time",
    "event_time",
    "exact_mean_price",
    "exact_volume",
    "floor_hour",
    "grouped_text",
    "instant",
    "minute_label",
    "parse_time",
    "percent_text",
    "since",
    "table_price",
    "usable_time",
    "usable_price",
    "usable_qty",
    "utc_date",
    "utc_hour",
]
