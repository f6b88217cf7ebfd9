"""Issue-date handling.

Issue instants are ISO-8601 text with an offset (``2021-01-29T10:32:11-03:00``).
The calendar date is taken in an explicit time zone, never implicitly in
whatever zone the session happens to run in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import DEFAULT_TIME_ZONE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_instant(col: Column | str) -> Column:
    """Text -> TIMESTAMP; unparseable text -> NULL (no exception under ANSI)."""
    return _c(col).try_cast("timestamp")


# an explicit UTC offset (or Z) at the end of ISO-8601 text
_OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def instant_local_date(col: Column | str, time_zone: str = DEFAULT_TIME_ZONE) -> Column:
    """Calendar date in ``time_zone`` of a TIMESTAMP (an instant)."""
    return F.to_date(F.convert_timezone(None, F.lit(time_zone), _c(col)))


def local_date(col: Column | str, time_zone: str = DEFAULT_TIME_ZONE) -> Column:
    """Calendar date of issue-instant text in ``time_zone``.

    Text with an offset is an instant, converted to ``time_zone``. Text without
    one (a date-only field of older layouts, or a bare local date-time) is
    already the issuer's wall-clock time: its date is taken as written, never
    re-read in the session's zone.
    """
    c = _c(col)
    zoned = instant_local_date(parse_instant(c), time_zone)
    wall = F.to_date(c.try_cast("timestamp_ntz"))
    return F.when(c.rlike(_OFFSET), zoned).otherwise(wall)


def calendar_parts(date_col: Column | str) -> dict[str, Column]:
    """The calendar attributes of the date dimension."""
    d = _c(date_col)
    return {
        "data": d.cast("string"),  # ISO yyyy-MM-dd, no time-zone round trip
        "dia": F.dayofmonth(d),
        "mes": F.month(d),
        "ano": F.year(d),
        "trimestre": F.quarter(d),
    }
