"""Date and number parsing that turns bad text into null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(col: Column | str) -> Column:
    """Calendar day of a text, date or timestamp column; null if unreadable.

    ``to_date`` raises on bad text under ANSI mode, which would end a cleaning
    job at the first bad row instead of dropping it.
    """
    return (F.col(col) if isinstance(col, str) else col).try_cast("date")


def to_number(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")
