"""Date expressions."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern tokens of the source dialect, which reads them in either case.
_TOKENS = {"yyyy": "yyyy", "mmm": "MMM", "mm": "MM", "dd": "dd", "hh": "HH", "nn": "mm", "ss": "ss"}


def spark_pattern(pattern: str) -> str:
    """Spark pattern for one in the source dialect.

    Tokens are read without regard to case and hours run to 24. ``mm`` is the month, but the
    minutes when a colon stands before it.
    """

    def translate(found: re.Match) -> str:
        token = found.group(2).lower()
        if found.group(1) and token == "mm":
            return ":mm"
        return found.group(1) + _TOKENS[token]

    return re.sub(r"(:?)(yyyy|mmm|mm|dd|hh|nn|ss)", translate, pattern, flags=re.IGNORECASE)


# With a zone, an instant's wall time there is held as the timestamp that UTC would show as it, and taken
# apart by its microseconds. So neither the session's zone nor a change of clocks comes in.
_DAY = 86_400_000_000


def _wall(when: Column, zone: str) -> Column:
    """Microseconds since 1970 of the wall time in a zone."""
    return F.unix_micros(F.from_utc_timestamp(when, zone))


def date_fmt(when: Column, pattern: str, zone: str | None = None) -> Column:
    if zone is not None:
        seconds = (_wall(when, zone) / 1_000_000).cast("decimal(18,6)")
        when = F.expr("timestamp_ntz'1970-01-01'") + F.make_dt_interval(secs=seconds)
    return F.date_format(when, spark_pattern(pattern))


def day_of(when: Column, zone: str | None = None) -> Column:
    if zone is None:
        return F.to_date(when)
    micros = _wall(when, zone)
    return F.date_from_unix_date(((micros - F.pmod(micros, F.lit(_DAY))) / _DAY).cast("int"))


def month_of(when: Column, zone: str | None = None) -> Column:
    return F.date_format(day_of(when, zone), "yyyy-MM")


def day_start(day: Column, zone: str | None = None) -> Column:
    """The instant at which a date begins."""
    if zone is None:
        return day.cast("timestamp")
    return F.to_utc_timestamp(F.timestamp_micros(F.unix_date(day).cast("long") * _DAY), zone)


def in_days(when: Column, start, end, zone: str | None = None) -> Column:
    """``when`` falls on a day from start to end, both whole days: ``[start, end + 1 day)``."""
    return (when >= as_timestamp(start, zone)) & (when < day_start(F.date_add(as_date(end, zone), 1), zone))


def in_year(when: Column, year: int, zone: str | None = None) -> Column:
    return (when >= as_timestamp(f"{year}-01-01", zone)) & (when < as_timestamp(f"{int(year) + 1}-01-01", zone))


def as_timestamp(value, zone: str | None = None) -> Column:
    """The instant of a date or time given as text or Python value; text without an offset of its own is in ``zone``."""
    if isinstance(value, Column):
        return value
    if zone is None:
        return F.lit(str(value)).cast("timestamp")
    given = datetime.fromisoformat(str(value))
    if given.tzinfo is not None:
        return F.lit(given)
    micros = (given - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.to_utc_timestamp(F.timestamp_micros(F.lit(micros)), zone)


def as_date(value, zone: str | None = None) -> Column:
    """A date; of an instant, the day it falls on."""
    if zone is None:
        return value.cast("date") if isinstance(value, Column) else as_timestamp(value).cast("date")
    return day_of(as_timestamp(value, zone), zone)


def title_month(day: Column) -> Column:
    """Short month name such as ``Jan`` of a date."""
    return F.initcap(F.date_format(day, "MMM"))
