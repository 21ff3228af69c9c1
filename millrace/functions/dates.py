"""Printed days to dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names by their first three letters.
_MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return text.try_cast("date")


def printed_day(text: Column) -> Column:
    """The day an unambiguous text names, else null.

    Year first with any separator or none (``2024-04-28``, ``2024/4/28``, ``20240428``), or a month
    name (``28-Apr-2024``, ``April 28, 2024``); a time of day after it is ignored. ``03/04/2024``
    could be two days and gives null, as do impossible days.
    """
    t = F.lower(F.trim(F.regexp_replace(text, r"[\s  ]+", " ")))
    tail = r"(?:[ t]\d{1,2}:.*)?$"
    iso = r"^(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})" + tail
    solid = r"^(\d{4})(\d{2})(\d{2})" + tail
    dmy = r"^(\d{1,2})(?:st|nd|rd|th)?[-/. ]([a-z]{3})[a-z]*\.?,?[-/. ](\d{4})" + tail
    mdy = r"^([a-z]{3})[a-z]*\.?[-/. ](\d{1,2})(?:st|nd|rd|th)?,?[-/. ]+(\d{4})" + tail
    ymd = r"^(\d{4})[-/. ]([a-z]{3})[a-z]*\.?[-/. ](\d{1,2})" + tail
    months = F.create_map(*[F.lit(x) for kv in _MONTHS.items() for x in (kv[0], str(kv[1]))])
    part = lambda p, i: F.regexp_extract(t, p, i)
    named = lambda p, i: F.element_at(months, part(p, i))
    return (
        F.when(t.rlike(iso), _date(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(t.rlike(solid), _date(part(solid, 1), part(solid, 2), part(solid, 3)))
        .when(t.rlike(dmy), _date(part(dmy, 3), named(dmy, 2), part(dmy, 1)))
        .when(t.rlike(mdy), _date(part(mdy, 3), named(mdy, 1), part(mdy, 2)))
        .when(t.rlike(ymd), _date(part(ymd, 1), named(ymd, 2), part(ymd, 3)))
    )
