"""The bounded report queries. Every figure comes from a metric view; nothing is defined twice."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import booking
from marquee.plans.metrics import BOOKING_REVENUE, PAYMENT_HEALTH, THEATRE_OCCUPANCY

Tables = Mapping[str, DataFrame]
Filters = Mapping[str, Any] | None


def kpi_counters(tables: Tables, filters: Filters = None) -> DataFrame:
    """The seven headline figures in one row."""
    return BOOKING_REVENUE.query(tables, filters=filters)


def weekly_revenue_trend(tables: Tables, filters: Filters = None) -> DataFrame:
    """Revenue per week, from daily revenue, which already fits any week."""
    daily = BOOKING_REVENUE.query(tables, ["Booking Date"], ["Total Revenue"], filters)
    week = F.date_trunc("week", "Booking Date").cast("date").alias("Week")
    return daily.groupBy(week).agg(F.sum("Total Revenue").alias("Total Revenue")).orderBy("Week")


def failure_rate_by_date_gateway(tables: Tables, filters: Filters = None) -> DataFrame:
    return PAYMENT_HEALTH.query(
        tables, ["Booking Date", "Payment Gateway"], ["Payment Failure Rate"], filters
    )


def city_gateway_heatmap(tables: Tables, filters: Filters = None) -> DataFrame:
    """Long form: one row per cell."""
    return PAYMENT_HEALTH.query(
        tables, ["City", "Payment Gateway"], ["Total Bookings", "Payment Failure Rate"], filters
    )


def city_gateway_grid(tables: Tables, gateways: list[str] | None = None, filters: Filters = None) -> DataFrame:
    """Wide form of the heatmap: one column per gateway, all that occur or the ones asked for.

    Naming them spares a job that looks for them.
    """
    cells = city_gateway_heatmap(tables, filters)
    return cells.groupBy("City").pivot("Payment Gateway", gateways).agg(F.first("Payment Failure Rate"))


def worst_payment_slices(
    tables: Tables,
    by: tuple[str, ...] = ("Payment Gateway", "City", "Booking Date"),
    least_bookings: int = 20,
    rows: int = 15,
    filters: Filters = None,
) -> DataFrame:
    """The slices with the highest failure rate among those with enough bookings to tell."""
    return PAYMENT_HEALTH.query(
        tables,
        by,
        filters=filters,
        having=f"`Total Bookings` >= {int(least_bookings)}",
        order_by=[F.desc("Payment Failure Rate"), F.desc("Total Bookings"), *[F.col(d) for d in by]],
        limit=rows,
    )


def payment_health_rollup(tables: Tables, filters: Filters = None) -> DataFrame:
    """Failure rate overall and broken down by gateway, by city and by date, in one pass."""
    dims = ["Payment Gateway", "City", "Booking Date"]
    return PAYMENT_HEALTH.query(tables, dims, filters=filters, sets=[[], *[[d] for d in dims]])


def revenue_by(tables: Tables, dimension: str, filters: Filters = None) -> DataFrame:
    return BOOKING_REVENUE.query(tables, [dimension], ["Total Revenue", "Total Bookings"], filters)


def top_movies(tables: Tables, rows: int = 10, filters: Filters = None) -> DataFrame:
    return BOOKING_REVENUE.query(
        tables,
        ["Movie Title"],
        ["Total Revenue"],
        filters,
        order_by=[F.desc_nulls_last("Total Revenue"), F.col("Movie Title")],
        limit=rows,
    )


def occupancy_by(tables: Tables, dimension: str, filters: Filters = None) -> DataFrame:
    return THEATRE_OCCUPANCY.query(tables, [dimension], filters=filters)


def failure_rate_status(
    tables: Tables, by: tuple[str, ...] = (), amber: float = 0.07, red: float = 0.2,
    filters: Filters = None,
) -> DataFrame:
    """The failure-rate KPI with its traffic light; the thresholds are the caller's choice."""
    light: Column = booking.traffic_light(F.col("Payment Failure Rate"), amber, red)
    return PAYMENT_HEALTH.query(tables, by, ["Payment Failure Rate"], filters).withColumn("Status", light)
