"""Column functions built from Spark SQL expressions."""

from fleetframe.functions.names import exact, quoted
from fleetframe.functions.payload import elements, falsy_json, is_only_detail, payload_status
from fleetframe.functions.times import (
    LOADDATE_FORMAT,
    distance_us,
    load_day,
    loaddate_of,
    run_time,
    slot_of,
    to_us,
)

__all__ = [
    "LOADDATE_FORMAT",
    "distance_us",
    "elements",
    "exact",
    "falsy_json",
    "is_only_detail",
    "load_day",
    "loaddate_of",
    "payload_status",
    "quoted",
    "run_time",
    "slot_of",
    "to_us",
]
