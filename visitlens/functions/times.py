"""Time expressions, in SQL. Clock times are those of the session time zone."""

from __future__ import annotations

# The formats times and dates are written in.
DATE = "yyyy-MM-dd"
TIME = "yyyy-MM-dd HH:mm:ss"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"
DATE_HOUR = "yyyy-MM-dd_HH"


def parse_time(text: str) -> str:
    """Text to timestamp. The hour may have one digit ("2019-04-22 5:08:33").

    A cast reads that and costs about half of a pattern parse per row. Text that is no
    time gives null, as a missing one does; ``operators.unreadable`` counts it.
    """
    return f"try_cast({text} as timestamp)"


def before(time: str, other: str) -> str:
    return f"({parse_time(time)} < {parse_time(other)})"


def after(time: str, other: str) -> str:
    return f"({parse_time(time)} > {parse_time(other)})"


def seconds_between(earlier: str, later: str) -> str:
    """Whole seconds from one timestamp to another."""
    return f"(unix_timestamp({later}) - unix_timestamp({earlier}))"


def format_time(ts: str) -> str:
    return f"date_format({ts}, '{TIME}')"


def format_date(ts: str) -> str:
    return f"date_format({ts}, '{DATE}')"


def date_key(ts: str) -> str:
    return f"date_format({ts}, '{DATE_KEY}')"


def minute_key(ts: str) -> str:
    return f"date_format({ts}, '{MINUTE_KEY}')"


def date_hour(ts: str) -> str:
    return f"date_format({ts}, '{DATE_HOUR}')"


def parse_date_key(text: str) -> str:
    return f"to_date({text}, '{DATE_KEY}')"


def today() -> str:
    return format_date("current_date()")


def yesterday() -> str:
    return format_date("date_sub(current_date(), 1)")
