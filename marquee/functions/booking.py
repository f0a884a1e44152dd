"""The business rules of a booking, each defined once.

Predicates are SQL text, so that the same constant serves DataFrame filters, metric specs and
quality rules. ``payment_status`` and ``is_cancelled`` are never NULL after the silver rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and cut-offs that results depend on.
PAYMENT_STATUSES = ("success", "failed", "refunded")
SCREEN_TYPES = ("STANDARD", "PREMIUM", "IMAX", "RECLINER")
LOYALTY_SEGMENTS = ("Platinum", "Gold", "Silver", "Bronze")
PERFORMANCE_TIERS = ("underperforming", "steady", "hit")
HIT_FROM = 0.8
STEADY_FROM = 0.4

REALIZED = "payment_status = 'success' AND NOT is_cancelled"
SUCCESSFUL = "payment_status = 'success'"
FAILED = "payment_status = 'failed'"
REFUNDED = "payment_status = 'refunded'"
CANCELLED = "is_cancelled"


def realized() -> Column:
    """Money that stayed: paid and not cancelled."""
    return F.expr(REALIZED)


def net_revenue() -> Column:
    return F.expr("ticket_amount + fees - discount")


def date_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def rate(part: Column, whole: Column) -> Column:
    """Ratio of two totals as double, NULL when there is nothing to divide by."""
    return F.try_divide(part, whole).cast("double")


def performance_tier(percentile: Column) -> Column:
    low, middle, high = PERFORMANCE_TIERS
    return F.when(percentile < STEADY_FROM, low).when(percentile < HIT_FROM, middle).otherwise(high)


def traffic_light(value: Column, amber: float, red: float) -> Column:
    """Status of a KPI that is bad when high; NULL stays NULL."""
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value >= red, "red")
        .when(value >= amber, "amber")
        .otherwise("green")
    )
