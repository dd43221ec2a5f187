"""Date functions; the current date is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the accepted shape of a date text.
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def valid_date(c: str | Column) -> Column:
    """True if the text has the shape YYYY-MM-DD; NULL is not valid."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(DATE_SHAPE), F.lit(False))


def real_date(c: str | Column) -> Column:
    """True if the text also names a day of the calendar."""
    c = F.col(c) if isinstance(c, str) else c
    return valid_date(c) & F.try_to_date(c, "yyyy-MM-dd").isNotNull()


def month_start_back(day: str | Column, months: int) -> Column:
    """First day of the month ``months`` months before ``day``."""
    return F.trunc(F.add_months(day, -months), "MM")


def whole_days_over(start: Column, end: Column, allowed_days: Column) -> Column:
    """Whole days by which ``end - start`` exceeds the allowed days; 0 if not, or if open."""
    seconds = F.timestamp_diff("SECOND", start, end)
    late = F.floor((seconds - allowed_days.cast("long") * 86400) / 86400)
    return F.coalesce(F.greatest(late, F.lit(0).cast("long")), F.lit(0).cast("long"))
