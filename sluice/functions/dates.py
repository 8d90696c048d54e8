"""Date text of the feed protocol (O-09, O-24, O-27).

Feeds exchange dates as ``MM-dd-yyyy`` text; landing names use
``MMddyyyy``.  ``as_of`` replaces the driver clock of a run so that a run
can be replayed: it defaults to ``current_date()``, which Spark fixes once
per query.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the feed protocol.
REQUEST_DATE_FORMAT = "MM-dd-yyyy"
LANDING_DATE_FORMAT = "MMddyyyy"


def as_col(v) -> Column:
    if v is None:
        return F.lit(None).cast("string")
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v)
    return F.lit(v)


def as_of_col(as_of=None) -> Column:
    """The run date as a date column; ``None`` means today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        return F.to_date(F.lit(as_of))
    return F.to_date(as_col(as_of))


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else as_col(c)


def mdy(c) -> Column:
    """O-24: date/timestamp column (or name) -> 'MM-dd-yyyy'."""
    return F.date_format(_column(c), REQUEST_DATE_FORMAT)


def compact_day(c) -> Column:
    """O-24: date/timestamp column (or name) -> 'MMddyyyy' (landing names)."""
    return F.date_format(_column(c), LANDING_DATE_FORMAT)


def parse_mdy(c) -> Column:
    """'MM-dd-yyyy' text column (or name) -> date (null when it does not parse)."""
    return F.try_to_date(_column(c), REQUEST_DATE_FORMAT)


def previous_day(as_of=None) -> Column:
    """O-27: the day before the run date."""
    return F.date_sub(as_of_col(as_of), 1)


def default_window(from_date=None, to_date=None, as_of=None) -> tuple[Column, Column]:
    """O-09: blank or missing dates become yesterday / today of ``as_of``."""
    run_day = as_of_col(as_of)
    frm = F.coalesce(F.nullif(as_col(from_date), F.lit("")), mdy(F.date_sub(run_day, 1)))
    to = F.coalesce(F.nullif(as_col(to_date), F.lit("")), mdy(run_day))
    return frm, to
