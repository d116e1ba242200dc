"""Date and time expressions. The session time zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000

# The shape of a text and the date layout that reads it. The shape picks the one layout to try,
# because a failed attempt costs far more than a match.
_TIME = r"\d{1,2}:\d{2}"
DATE_LAYOUTS = (
    (r"^(1[3-9]|2\d|3[01])/\d{1,2}/\d{4}$", "d/M/yyyy"),  # no month is above 12
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_TIME}$", "M/d/yyyy H:mm"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_TIME}:\d{{2}}$", "M/d/yyyy H:mm:ss"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_TIME} [AP]M$", "M/d/yyyy h:mm a"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_TIME}:\d{{2}} [AP]M$", "M/d/yyyy h:mm:ss a"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}} {_TIME}:\d{{2}}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Z][a-z]{3,} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2}-[A-Z][a-z]{2}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
)
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}"


def parse_timestamp(c: Column) -> Column:
    """Timestamp from text in mixed layouts; unreadable text gives null."""
    parsed = F.when(c.rlike(ISO_DATE), c.try_cast("timestamp"))
    for shape, layout in DATE_LAYOUTS:
        parsed = parsed.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(layout)))
    return parsed


def calendar_parts(c: Column) -> dict[str, Column]:
    return {
        "Year": F.year(c),
        "Month": F.month(c),
        "Quarter": F.quarter(c),
        "Day": F.dayofmonth(c),
        "Day_Name": F.date_format(c, "EEEE"),
    }


def whole_days_between(start: Column, end: Column) -> Column:
    """Floor of the elapsed days: six hours early is -1, not 0."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def period_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
