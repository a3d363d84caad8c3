"""Month keys and tolerant timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(ts: Column | str) -> Column:
    """'YYYY-MM'; sorts like time."""
    return F.date_format(ts, "yyyy-MM")


def month_start(ym: Column | str) -> Column:
    ym = F.col(ym) if isinstance(ym, str) else ym
    return F.to_date(F.concat(ym, F.lit("-01")), "yyyy-MM-dd")


def next_month(ym: Column | str) -> Column:
    return F.date_format(F.add_months(month_start(ym), 1), "yyyy-MM")


def lenient_timestamp(text: Column | str) -> Column:
    """Parse a timestamp; text that is no timestamp becomes null."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole calendar days, the time of day is ignored."""
    return F.datediff(end, start)
