"""Explicit "as of" time, and calendar differences that count unit boundaries.

No operator reads the wall clock: the moment is an argument, so a rebuild of an old
day gives the old result.  All values are zone-less (``timestamp_ntz``); none of the
expressions below depends on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """The moment a query is asked for.  Cut-offs are computed once, on the driver,
    and enter the plan as literals so that Catalyst can push them to the scan."""

    moment: datetime

    @classmethod
    def of(cls, value: AsOf | datetime | date | str) -> AsOf:
        if isinstance(value, AsOf):
            return value
        if isinstance(value, str):
            value = datetime.fromisoformat(value)
        elif not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
        if value.tzinfo is not None:
            raise ValueError("as_of must be zone-less, like the tables it is compared with")
        return cls(value)

    def now(self) -> Column:
        return self.days_ago(0)

    def days_ago(self, days: int) -> Column:
        """Timestamp exactly ``days`` x 24 hours earlier."""
        moment = self.moment - timedelta(days=days)
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

    def today(self) -> Column:
        return self.date_days_ago(0)

    def date_days_ago(self, days: int) -> Column:
        """Calendar date ``days`` days before the as-of date."""
        return F.lit(self.moment.date() - timedelta(days=days))


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(end, start).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    """Full hours on the clock crossed: 10:59 -> 11:01 is 1, not 0."""
    return days_between(start, end) * 24 + F.hour(end) - F.hour(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute marks crossed."""
    return hours_between(start, end) * 60 + F.minute(end) - F.minute(start)


def seconds_elapsed(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, exact to the microsecond."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")
