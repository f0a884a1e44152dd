"""Metric views: measures defined once, evaluated over any choice of dimensions.

A view names a source, the dimensions it can be cut by and its measures. ``query`` turns a choice
of both into one ordinary aggregation; only the joins and columns the choice needs are planned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import booking


@dataclass(frozen=True)
class Part:
    """One aggregate a measure is made of. ``distinct`` parts do not add up, the others do (``bits`` by OR)."""

    kind: Literal["sum", "count", "distinct", "bits"]
    column: str = "1"
    where: str | None = None

    def _input(self) -> Column:
        value = F.expr(self.column)
        return value if self.where is None else F.when(F.expr(self.where), value)

    def direct(self) -> Column:
        """The aggregate over source rows; a filter becomes a NULL the aggregate skips."""
        if self.kind == "sum":
            return F.sum(self._input())
        if self.kind == "count":
            return F.count(self._input())
        if self.kind == "bits":
            return F.bit_or(self._input())
        return F.count_distinct(self._input())

    def merged(self, partial: str) -> Column:
        """The same over partial results."""
        if self.kind == "sum":
            return F.sum(partial)
        if self.kind == "count":
            return F.coalesce(F.sum(partial), F.lit(0))
        if self.kind == "bits":
            return F.bit_or(partial)
        return F.count_distinct(partial)


@dataclass(frozen=True)
class Measure:
    parts: tuple[Part, ...]
    finish: Callable[..., Column]


def total(column: str, where: str | None = None) -> Measure:
    return Measure((Part("sum", column, where),), lambda value: value)


def rows(where: str | None = None) -> Measure:
    return Measure((Part("count", "1", where),), lambda value: value)


def distinct(column: str, where: str | None = None) -> Measure:
    return Measure((Part("distinct", column, where),), lambda value: value)


def ratio(part: Measure, whole: Measure) -> Measure:
    """Ratio of two totals, so it re-aggregates over any grouping; NULL when the whole is 0."""
    return Measure(part.parts + whole.parts, booking.rate)


@dataclass(frozen=True)
class Dimension:
    """``table`` is None for a column of the source, else the name of a join."""

    column: str
    table: str | None = None


@dataclass(frozen=True)
class MetricView:
    name: str
    source: str
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]
    comments: Mapping[str, str] = field(default_factory=dict)
    """What the view (under its own name), its dimensions and its measures mean."""
    joins: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    """Join name to (table, key); the table is unique by key, so a left join keeps every row."""

    def described(self) -> list[tuple[str, str, str]]:
        """(kind, name, comment) of the view, its dimensions and its measures; undescribed ones are an error."""
        names = [("view", self.name), *[("dimension", d) for d in self.dimensions], *[("measure", m) for m in self.measures]]
        return [(kind, name, self.comments[name]) for kind, name in names]

    def query(
        self,
        tables: Mapping[str, DataFrame],
        by: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        filters: Mapping[str, Any] | None = None,
        having: str | None = None,
        order_by: Iterable[Column] | None = None,
        limit: int | None = None,
        sets: Sequence[Sequence[str]] | None = None,
        preaggregate: bool | None = None,
    ) -> DataFrame:
        """Measures per combination of ``by``.

        ``filters`` maps a dimension to a list of values, a (from, to) pair or one value; a
        dimension this view does not have is skipped, so one set of filters serves all views.
        ``sets`` evaluates several groupings of ``by`` at once and adds ``grouping_id``.
        ``preaggregate`` folds the source by key before it meets the joined tables; by default
        that is done when a joined table is too big for Spark to broadcast.
        """
        chosen = {name: self.measures[name] for name in (measures or self.measures)}
        limits = {k: v for k, v in (filters or {}).items() if k in self.dimensions}
        needed = {name: self.dimensions[name] for name in dict.fromkeys([*by, *limits])}
        parts = list(dict.fromkeys(p for m in chosen.values() for p in m.parts))
        partial = {part: f"_part{i}" for i, part in enumerate(parts)}
        joined = list(dict.fromkeys(d.table for d in needed.values() if d.table))

        stored = self._from_rollup(getattr(tables, "rollups", ()), chosen, list(by), limits, partial)
        if stored is not None and sets is None:
            return _finished(stored, having, order_by, limit)

        source = _filtered(
            tables[self.source],
            {name: v for name, v in limits.items() if needed[name].table is None},
            {name: needed[name].column for name in limits},
        )
        if preaggregate is None:
            preaggregate = bool(sets) or any(
                not _broadcastable(tables[self.joins[j][0]]) for j in joined
            )

        own = {name: F.col(d.column).alias(name) for name, d in needed.items() if d.table is None}
        keys = [F.col(self.joins[j][1]).alias(f"_key_{j}") for j in joined]
        if preaggregate:
            singles = [p for p in parts if p.kind == "distinct"]
            additive = [p for p in parts if p.kind != "distinct"]
            grouping = [*own.values(), *keys, *[p._input().alias(partial[p]) for p in singles]]
            base = source.groupBy(*grouping).agg(
                *[p.direct().alias(partial[p]) for p in additive] or [F.count(F.lit(1)).alias("_n")]
            )
        else:
            inputs = [p._input().alias(partial[p]) for p in parts]
            base = source.select(*own.values(), *keys, *inputs)

        for j in joined:
            table, key = self.joins[j]
            wanted = {n: d for n, d in needed.items() if d.table == j}
            side = tables[table].select(
                F.col(key).alias(f"_key_{j}"), *[F.col(d.column).alias(n) for n, d in wanted.items()]
            )
            base = base.join(side, f"_key_{j}", "left")
        base = _filtered(
            base, {n: v for n, v in limits.items() if needed[n].table}, {n: n for n in limits}
        )

        def aggregate(part: Part) -> Column:
            if preaggregate:
                return part.merged(partial[part])
            whole = {"sum": F.sum, "count": F.count, "bits": F.bit_or, "distinct": F.count_distinct}
            return whole[part.kind](partial[part])

        columns = [
            measure.finish(*[aggregate(p) for p in measure.parts]).alias(name)
            for name, measure in chosen.items()
        ]
        dims = [named_column(name) for name in by]
        if sets is None:
            result = base.groupBy(*dims).agg(*columns)
        else:
            result = base.groupingSets([[named_column(n) for n in s] for s in sets], *dims).agg(
                F.grouping_id().alias("grouping_id"), *columns
            )
        return _finished(result, having, order_by, limit)

    def with_comments(self, result: DataFrame) -> DataFrame:
        """A result whose columns carry their comments, as a stored table then shows them."""
        return result.select(*[
            named_column(c).alias(c, metadata={"comment": self.comments[c]}) if c in self.comments else named_column(c)
            for c in result.columns
        ])

    def _from_rollup(
        self, rollups: Iterable, chosen: Mapping[str, Measure], by: list[str], limits: Mapping[str, Any],
        partial: Mapping[Part, str],
    ) -> DataFrame | None:
        """The answer from the smallest stored aggregate that covers the question, if any does."""
        fitting = [r for r in rollups if r.covers(self, [*by, *limits], list(partial))]
        if not fitting:
            return None

        def kept(df: DataFrame) -> DataFrame:
            return _filtered(df, limits, {n: n for n in limits})

        def added(part: Part) -> Column:
            total = F.sum(partial[part])
            return total if part.kind == "sum" else F.coalesce(total, F.lit(0))

        slices = min(fitting, key=lambda r: r.rows).slices(partial, by, kept)
        columns = [m.finish(*[added(p) for p in m.parts]).alias(name) for name, m in chosen.items()]
        return slices.groupBy(*[named_column(n) for n in by]).agg(*columns)


def _finished(result: DataFrame, having: str | None, order_by: Iterable[Column] | None, limit: int | None) -> DataFrame:
    if having:
        result = result.where(having)
    if order_by is not None:
        result = result.orderBy(*order_by)
    return result if limit is None else result.limit(limit)


def named_column(name: str) -> Column:
    return F.col(f"`{name}`")


def _filtered(df: DataFrame, limits: Mapping[str, Any], columns: Mapping[str, str]) -> DataFrame:
    for name, wanted in limits.items():
        column = named_column(columns[name])
        if isinstance(wanted, tuple):
            df = df.where(column.between(*wanted))
        elif isinstance(wanted, list):
            df = df.where(column.isin(wanted))
        else:
            df = df.where(column == wanted)
    return df


def _broadcastable(df: DataFrame) -> bool:
    """Spark's own size estimate of the stored inputs against its own broadcast threshold.

    Only a choice between two plans with the same result: Spark still decides on its own, by
    size, whether it broadcasts. A dimension put together by key lookups is taken to be as big as
    its inputs; the planner's estimate for a join would be their product.
    """
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) <= threshold


# Comments of the views, their dimensions and measures, in our words.
_COMMENTS = {
    "booking_revenue": "Revenue, volume, cancellations and customers of bookings",
    "payment_health": "How often payments fail, and where",
    "theatre_occupancy": "How full the shows were",
    "Booking Date": "Day of the booking", "City": "City of the theatre", "Movie Title": "Title of the movie",
    "Genre": "Genre of the movie", "Theatre Name": "Name of the theatre", "Booking Channel": "Where it was booked",
    "Payment Gateway": "Who processed the payment", "Screen Type": "Kind of screen", "Show Date": "Day of the show",
    "Total Revenue": "Net revenue of paid bookings that were not cancelled", "Total Bookings": "All bookings",
    "Successful Bookings": "Bookings that were paid", "Failed Bookings": "Bookings whose payment failed",
    "Average Ticket Price": "Ticket amount for each paid booking that was not cancelled",
    "Cancellation Rate": "Cancelled bookings over all bookings", "Unique Customers": "Customers with a booking",
    "Payment Failure Rate": "Failed bookings over all bookings", "Show Count": "Shows",
    "Total Seat Capacity": "Seats offered", "Total Seats Sold": "Seats of paid bookings that were not cancelled",
    "Occupancy Rate": "Seats sold over seats offered",
}

_BOOKING_JOINS = {
    "theatre": ("dim_theatre", "theatre_id"),
    "movie": ("dim_movie", "movie_id"),
}

BOOKING_REVENUE = MetricView(
    name="booking_revenue",
    comments=_COMMENTS,
    source="fact_bookings",
    joins=_BOOKING_JOINS,
    dimensions={
        "Booking Date": Dimension("booking_date"),
        "City": Dimension("city", "theatre"),
        "Movie Title": Dimension("title", "movie"),
        "Genre": Dimension("genre", "movie"),
        "Theatre Name": Dimension("name", "theatre"),
        "Booking Channel": Dimension("booking_channel"),
        "Payment Gateway": Dimension("payment_gateway"),
    },
    measures={
        "Total Revenue": total("net_revenue", booking.REALIZED),
        "Total Bookings": rows(),
        "Successful Bookings": rows(booking.SUCCESSFUL),
        "Failed Bookings": rows(booking.FAILED),
        "Average Ticket Price": ratio(
            total("ticket_amount", booking.REALIZED), rows(booking.REALIZED)
        ),
        "Cancellation Rate": ratio(rows(booking.CANCELLED), rows()),
        "Unique Customers": distinct("customer_id"),
    },
)

PAYMENT_HEALTH = MetricView(
    name="payment_health",
    comments=_COMMENTS,
    source="fact_bookings",
    joins={"theatre": _BOOKING_JOINS["theatre"]},
    dimensions={
        "Payment Gateway": Dimension("payment_gateway"),
        "City": Dimension("city", "theatre"),
        "Booking Date": Dimension("booking_date"),
    },
    measures={
        "Total Bookings": rows(),
        "Failed Bookings": rows(booking.FAILED),
        "Payment Failure Rate": ratio(rows(booking.FAILED), rows()),
    },
)

THEATRE_OCCUPANCY = MetricView(
    name="theatre_occupancy",
    comments=_COMMENTS,
    source="fact_show_occupancy",
    joins={"theatre": _BOOKING_JOINS["theatre"]},
    dimensions={
        "Theatre Name": Dimension("name", "theatre"),
        "City": Dimension("city"),
        "Screen Type": Dimension("screen_type"),
        "Show Date": Dimension("show_date"),
    },
    measures={
        "Show Count": rows(),
        "Total Seat Capacity": total("seat_capacity"),
        "Total Seats Sold": total("seats_sold"),
        "Occupancy Rate": ratio(total("seats_sold"), total("seat_capacity")),
    },
)

# The daily summary is the same measures under the names of its table.
DAILY_REVENUE = MetricView(
    name="daily_revenue",
    source="fact_bookings",
    dimensions={
        "date_key": Dimension("date_key"),
        "booking_date": Dimension("booking_date"),
        "city": Dimension("city"),  # of the theatre, looked up before
        "payment_gateway": Dimension("payment_gateway"),
    },
    measures={
        "total_revenue": BOOKING_REVENUE.measures["Total Revenue"],
        "total_bookings": BOOKING_REVENUE.measures["Total Bookings"],
        "successful_bookings": BOOKING_REVENUE.measures["Successful Bookings"],
        "failed_bookings": BOOKING_REVENUE.measures["Failed Bookings"],
        "refunded_bookings": rows(booking.REFUNDED),
        "cancelled_bookings": rows(booking.CANCELLED),
        "unique_customers": BOOKING_REVENUE.measures["Unique Customers"],
        "payment_failure_rate": PAYMENT_HEALTH.measures["Payment Failure Rate"],
        "cancellation_rate": BOOKING_REVENUE.measures["Cancellation Rate"],
    },
)

VIEWS = {view.name: view for view in (BOOKING_REVENUE, PAYMENT_HEALTH, THEATRE_OCCUPANCY)}
