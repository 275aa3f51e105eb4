"""Column expressions shared by the operators; all of them run inside the JVM."""

from skyledger.functions.columns import (
    arrival_minutes_or_zero,
    delimited,
    departure_minutes,
    fixed2,
    flight_label,
    hhmm_text,
    is_zero,
    none_if_empty,
    ontime_pct,
    result_line,
    to_number,
    to_time,
)

__all__ = [
    "arrival_minutes_or_zero", "delimited", "departure_minutes", "fixed2", "flight_label",
    "hhmm_text", "is_zero", "none_if_empty", "ontime_pct", "result_line", "to_number",
    "to_time",
]
