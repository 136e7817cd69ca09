"""Event time: parse the two accepted text forms, render ISO-8601 (ops T3, T4).

Accepted input (the two ``strptime`` formats ``%Y-%m-%d %H:%M:%S`` and
``%Y-%m-%d %H:%M:%S.%f``): a four-digit year; one- or two-digit month, day,
hour, minute, second (a day may also be written as a blank and one digit);
blanks between date and time; 1-6 fraction digits after a dot.  Values must form
a real calendar time: month 1-12, a day that exists in that month, hour 0-23,
minute and second 0-59, year 1-9999.  Anything else (a ``T`` separator, a zone
suffix, 7 fraction digits, 30 February, second 60, ...) gives NULL, which the
quarantine turns into reason ``timestamp``.

Times are zone-less, so the column type is ``TIMESTAMP_NTZ``: the result never
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of an accepted time text (groups: y, M, d, H, m, s, fraction).
TIME_PATTERN = r"\A(\d{4})-(\d{1,2})-(\d{1,2}| \d)\s+(\d{1,2}):(\d{1,2}):(\d{1,2})(?:[.](\d{1,6}))?\z"


def time_parts(text: Column) -> Column:
    """Digit runs of an accepted time text (y, M, d, H, m, s[, fraction]); NULL otherwise."""
    return F.when(text.rlike(TIME_PATTERN), F.regexp_extract_all(text, F.lit(r"(\d+)"), 1))


def time_from_parts(parts: Column) -> Column:
    """``TIMESTAMP_NTZ`` from :func:`time_parts` output; NULL when the parts are no real time.

    Pass a column reference: the parts are read many times.
    """
    yi, moi, di, hi, mii, si = (parts[i].try_cast("int") for i in range(6))
    frac = F.when(F.size(parts) == 7, parts[6]).otherwise(F.lit(""))
    # seconds with the fraction padded to microseconds, e.g. "7.5" -> 7.500000
    seconds = F.concat(parts[5], F.lit("."), F.rpad(frac, 6, "0")).try_cast("decimal(8,6)")
    valid = (
        yi.between(1, 9999)
        & moi.between(1, 12)
        & di.between(1, 31)
        & hi.between(0, 23)
        & mii.between(0, 59)
        & si.between(0, 59)
    )
    # try_make_timestamp_ntz returns NULL for 30 February; it is only reached for
    # in-range parts (it raises on year 0 and rolls second 60 over).
    return F.when(parts.isNotNull() & valid, F.try_make_timestamp_ntz(yi, moi, di, hi, mii, seconds))


def parse_event_time(text: Column) -> Column:
    """``TIMESTAMP_NTZ`` from the event time text, NULL when it is not an accepted form.

    For plans, prefer staging :func:`time_parts` as a column and applying
    :func:`time_from_parts` to it (this one-expression form repeats the split).
    """
    return time_from_parts(time_parts(text))


def iso_text(t: Column) -> Column:
    """``datetime.isoformat()`` text: ``T`` separator, 6 fraction digits, none when zero."""
    full = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"[.]000000$", "")
