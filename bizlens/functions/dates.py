"""Calendar helpers: names, week of month, week labels, short-date parsing.

Every helper works on the calendar date (``to_date`` of a zone-less
timestamp), so results never depend on the session time zone: formatting a
TIMESTAMP_NTZ directly would first convert it through the session zone,
which moves wall-clock times inside a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_name(c: str | Column, case: str = "title") -> Column:
    """Full month name, unpadded. ``case`` is 'title', 'upper' or 'lower'."""
    name = F.date_format(F.to_date(_col(c)), "MMMM")
    return {"title": name, "upper": F.upper(name), "lower": F.lower(name)}[case]


def day_name(c: str | Column, case: str = "title") -> Column:
    name = F.date_format(F.to_date(_col(c)), "EEEE")
    return {"title": name, "upper": F.upper(name), "lower": F.lower(name)}[case]


def week_of_month(c: str | Column) -> Column:
    """Days 1-7 -> 1, 8-14 -> 2, ... (the 'W' field of a to-char format)."""
    return ((F.dayofmonth(_col(c)) - 1) / 7).cast("int") + 1


def week_start(c: str | Column) -> Column:
    """Monday of the (ISO) week of a date or timestamp, as a DATE."""
    d = F.to_date(_col(c))
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def week_label(c: str | Column, offset_days: int = 4) -> Column:
    """Monday of the ISO week plus ``offset_days`` (a Friday by default)."""
    return F.date_add(week_start(c), offset_days)


def short_date_text(c: str | Column) -> Column:
    """``d/M/yy`` text of a date (no zero padding, two-digit year).

    Formatting a DATE is zone-safe for its date fields: the value is placed at
    local midnight, and a daylight-saving shift there moves it forward within
    the same day.
    """
    return F.date_format(F.to_date(_col(c)), "d/M/yy")


def parse_short_date(c: str | Column, fmt: str = "d/M/yy") -> Column:
    """Parse text dates; with a two-digit year, pick the year nearest 2020.

    Spark maps ``yy`` onto 2000-2099; the SQL convention being reproduced maps
    70-99 to the 1900s and 00-69 to the 2000s, so shift the former back.
    """
    parsed = F.to_date(_col(c), fmt)
    if "yy" in fmt and "yyy" not in fmt:
        parsed = F.when(F.year(parsed) >= 2070, F.add_months(parsed, -1200)).otherwise(parsed)
    return parsed


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in seconds as DECIMAL(20,6).

    Subtracting two TIMESTAMP_NTZ values gives a day-time interval without
    consulting the session zone (``timestampdiff`` would convert both through
    it and gain or lose an hour across a daylight-saving change).
    """
    return (_col(end) - _col(start)).cast("interval second").cast("decimal(20,6)")
