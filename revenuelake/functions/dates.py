"""Date expressions."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def months_before(as_of: dt.date, months: int) -> dt.date:
    """``as_of`` minus whole months, clipped to the end of a short month."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = index // 12, index % 12 + 1
    return dt.date(year, month, min(as_of.day, calendar.monthrange(year, month)[1]))


def days_after(as_of: dt.date, days: int) -> dt.date:
    return as_of + dt.timedelta(days=days)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_slot(year: Column, quarter: Column) -> Column:
    """Quarters on one integer axis, so that neighbouring quarters differ by one."""
    return year * 4 + quarter


def month_slot(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def full_years(start: Column, as_of: dt.date) -> Column:
    """Completed years by the birthday rule.

    ``months_between`` would count 29 February to 28 February as whole years, so months and days
    are compared directly.
    """
    now = F.lit(as_of)
    not_reached = (F.month(now) * 100 + F.dayofmonth(now)) < (F.month(start) * 100 + F.dayofmonth(start))
    return F.year(now) - F.year(start) - not_reached.cast("int")


def has_month_folders(payments: DataFrame) -> bool:
    """Whether ``payment_month`` is the folder column; staged payments have a number of that name."""
    return dict(payments.dtypes).get("payment_month") == "string"


def in_months(payments: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Payments of the given (year, month) pairs; of stored payments only these folders are read."""
    kept = payments
    if has_month_folders(payments):
        kept = kept.filter(F.col("payment_month").isin(*[f"{year:04d}-{month:02d}" for year, month in months]))
    starts = [dt.date(year, month, 1) for year, month in months]
    ends = [dt.date(year + month // 12, month % 12 + 1, 1) for year, month in months]
    day = F.col("payment_date")
    return kept.filter(reduce(or_, [(day >= F.lit(start)) & (day < F.lit(end)) for start, end in zip(starts, ends)]))


def in_period(
    payments: DataFrame,
    start: dt.date | None = None,
    until: dt.date | None = None,
    before: dt.date | None = None,
) -> DataFrame:
    """Payments from ``start`` on, up to ``until`` (inclusive) or ``before`` (exclusive).

    The stored payments have a folder per month. The same bounds on that column let the scan skip whole
    folders; on other frames the date filter alone reaches the scan.
    """
    day, kept = F.col("payment_date"), payments
    by_month = has_month_folders(payments)
    if start is not None:
        kept = kept.filter(day >= F.lit(start))
        if by_month:
            kept = kept.filter(F.col("payment_month") >= f"{start:%Y-%m}")
    last = until or before
    if last is not None:
        kept = kept.filter(day <= F.lit(until) if until else day < F.lit(before))
        if by_month:
            kept = kept.filter(F.col("payment_month") <= f"{last:%Y-%m}")
    return kept
