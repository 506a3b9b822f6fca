from tapemill.streaming.hours import heartbeat, start_hour_stream
from tapemill.streaming.minutes import minute_updates, start_minute_stream
from tapemill.streaming.once import once_only
from tapemill.streaming.rolling import read_final_minutes, start_final_minutes, start_rolling_stream
from tapemill.streaming.routes import kept_records, late_records, route_ledger, start_late_route

__all__ = [
    "heartbeat",
    "kept_records",
    "late_records",
    "minute_updates",
    "once_only",
    "read_final_minutes",
    "route_ledger",
    "start_final_minutes",
    "start_hour_stream",
    "start_late_route",
    "start_minute_stream",
    "start_rolling_stream",
]
