"""Scoring rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from revenuelake import constants as C


def _ladder(steps: list[tuple[Column, str]], otherwise: str | None) -> Column:
    first, *rest = steps
    chain = reduce(lambda acc, step: acc.when(step[0], F.lit(step[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain


def risk_category(fraud_score: Column, chronic_late: Column, low_filing: Column, filing_rate: Column) -> Column:
    return _ladder(
        [
            (F.coalesce(fraud_score, F.lit(0)) > C.CRITICAL_FRAUD_SCORE, "Critical"),
            (chronic_late | low_filing, "High"),
            (filing_rate < 0.5, "Medium"),
            (filing_rate < 0.8, "Low"),
        ],
        "Very Low",
    )


def size_category(turnover: Column) -> Column:
    """A NULL turnover falls through to the top category, as in the source rules."""
    return _ladder([(turnover < limit, label) for limit, label in C.SIZE_LIMITS], C.SIZE_TOP)


def engagement_score(email: Column, active_months: Column, filing_rate: Column) -> Column:
    """NULL for a taxpayer without payments (``active_months`` is NULL)."""
    email_points = F.when(email.isNotNull(), F.lit(C.EMAIL_POINTS)).otherwise(F.lit(0.0))
    month_points = F.when(active_months > C.REGULAR_PAYER_MONTHS, F.lit(C.REGULAR_PAYER_POINTS)).otherwise(
        active_months * F.lit(C.MONTH_POINTS)
    )
    return email_points + month_points + filing_rate * F.lit(C.FILING_WEIGHT)


def alert_priority(score: Column) -> Column:
    return _ladder([(score >= limit, label) for limit, label in C.PRIORITY_LIMITS], C.PRIORITY_BOTTOM)


def priority_rank(priority: Column) -> Column:
    """1 for Critical down to 4, for sorting by urgency."""
    order = F.array(*[F.lit(label) for _, label in C.PRIORITY_LIMITS])
    place = F.array_position(order, priority)
    return F.when(place > 0, place).otherwise(F.lit(4))


def fraud_band(probability: Column) -> Column:
    """Bands open on the left, so a probability of exactly zero has none."""
    return F.when(probability > 0, _ladder([(probability <= top, label) for top, label in C.FRAUD_BANDS], None))


def compliance_band(score: Column) -> Column:
    return _ladder([(score < limit, label) for limit, label in C.COMPLIANCE_BANDS], C.COMPLIANCE_BAND_TOP)
