"""Window bounds and minute-of-day arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# A profile has one slot per minute of day, slot 0 is 11:00.
MINUTES_PER_DAY = 1440
PROFILE_ANCHOR = 11 * 60

# Fixed format of window bounds.
BOUND_FORMAT = "%d/%m/%Y %H:%M"


def bound(value: str | datetime) -> datetime:
    """A window bound; text is read as day/month/year hour:minute with one- or two-digit parts."""
    return value if isinstance(value, datetime) else datetime.strptime(value, BOUND_FORMAT)


def window_minutes(start: str | datetime, end: str | datetime) -> int:
    """Whole minutes in [start, end); an empty or reversed window is an error."""
    minutes = int((bound(end) - bound(start)).total_seconds() // 60)
    if minutes <= 0:
        raise ValueError(f"window end {end} must be at least one minute after start {start}")
    return minutes


def slot_of(value: datetime, anchor: int = PROFILE_ANCHOR) -> int:
    return (value.hour * 60 + value.minute - anchor) % MINUTES_PER_DAY


def slot_column(ts: Column | str, anchor: int = PROFILE_ANCHOR) -> Column:
    return F.pmod(F.hour(ts) * 60 + F.minute(ts) - F.lit(anchor), F.lit(MINUTES_PER_DAY))


def ntz_literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


# Timestamp text is put together from the plain cast, which is `yyyy-MM-dd HH:mm:ss[.ffffff]`. date_format
# would first move a timestamp without time zone into the session's zone and so change hours that
# this zone skips.


def _plain(ts: Column | str) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("string")


def _day_text(ts: Column | str) -> Column:
    text = _plain(ts)
    return F.concat_ws("/", F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4))


def time_of_day(ts: Column | str) -> Column:
    """Hour and minute as HH:mm."""
    text = _plain(ts)
    return F.substring(text, 12, 5)


def bound_text(ts: Column | str) -> Column:
    """Bound of a window as dd/MM/yyyy HH:mm; two-digit parts keep labels of different days apart."""
    return F.concat_ws(" ", _day_text(ts), time_of_day(ts))


def timestamp_text(ts: Column | str) -> Column:
    """dd/MM/yyyy HH:mm:ss.SSS, cut to milliseconds."""
    text = _plain(ts)
    milliseconds = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(_day_text(ts), F.lit(" "), F.substring(text, 12, 8), F.lit("."), milliseconds)


def path_label(text: Column | str) -> Column:
    """Window bound as part of a path: a blank becomes `_`, `/` and `:` go away."""
    return F.translate(text, " /:", "_")


def path_text(text: str) -> str:
    """`path_label` of a text known to the caller: 23/6/2020 11:00 -> 2362020_1100."""
    return text.translate({ord(" "): "_", ord("/"): None, ord(":"): None})
