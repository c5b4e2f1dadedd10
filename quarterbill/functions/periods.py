"""Billing periods: as literals for one run, and as columns for a table of starts."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterbill.functions.policy import Policy


def end_of_months(start: dt.date, months: int) -> dt.date:
    """Last day of the `months`-th month, counting the month of `start` as the first."""
    index = start.year * 12 + start.month - 1 + months - 1
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, calendar.monthrange(year, month + 1)[1])


def end_of_months_column(start: Column, months: int) -> Column:
    """`end_of_months` for a date column."""
    return F.last_day(F.add_months(F.trunc(start, "MM"), months - 1))


def days_in_range(start: Column, end: Column) -> Column:
    """All days of a closed range, as an array."""
    return F.sequence(start, end)


def active_on(day: str, start: str, end: str) -> str:
    """Whether a closed interval with an optional end holds a day, as SQL text."""
    return f"{start} <= {day} AND ({end} IS NULL OR {end} >= {day})"


@dataclass(frozen=True)
class Period:
    """A closed range of days; `early_cutoff` and `late_cutoff` exist for billing only."""

    start: dt.date
    end: dt.date
    early_cutoff: dt.date | None = None
    late_cutoff: dt.date | None = None

    @classmethod
    def quarter(cls, start: str | dt.date, policy: Policy | None = None) -> Period:
        """The billing period that starts on `start`."""
        policy = policy or Policy()
        first = _as_date(start)
        return cls(
            start=first,
            end=end_of_months(first, policy.period_months),
            early_cutoff=end_of_months(
                first, policy.period_months - policy.min_use_months
            ),
            late_cutoff=end_of_months(first, policy.min_use_months),
        )

    @classmethod
    def between(cls, start: str | dt.date, end: str | dt.date) -> Period:
        """Any range of days, for listings that have no price."""
        return cls(start=_as_date(start), end=_as_date(end))

    @property
    def min_days(self) -> int:
        """Days of power use from which a user is charged."""
        return max(
            (self.late_cutoff - self.start).days, (self.end - self.early_cutoff).days
        )


def period_columns(start: Column, policy: Policy | None = None) -> list[Column]:
    """The same bounds as columns, for a table with one period start per row."""
    policy = policy or Policy()
    early = end_of_months_column(start, policy.period_months - policy.min_use_months)
    late = end_of_months_column(start, policy.min_use_months)
    end = end_of_months_column(start, policy.period_months)
    return [
        early.alias("early_cutoff"),
        late.alias("late_cutoff"),
        end.alias("quarter_end"),
        F.size(days_in_range(start, end)).alias("n_days"),
        F.greatest(F.date_diff(late, start), F.date_diff(end, early)).alias("min_days"),
    ]


def day_after(day: dt.date) -> dt.date:
    """The next calendar day."""
    return day + dt.timedelta(days=1)


def _as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value
