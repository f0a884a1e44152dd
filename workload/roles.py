"""The driver's tables in their booking roles.

lineitem and orders are the booking feed (with repeated booking ids), part is the catalogue of
movies and their shows, supplier the theatres, customer the customers. Money is in whole cents.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import draws
from marquee.functions.booking import SCREEN_TYPES
from marquee.operators import shaping
from marquee.operators.latest import latest_per_key
from marquee.plans import star

# Fixed values of the binding.
SCREEN_WEIGHTS = (55, 25, 10, 10)
PARTS_PER_SUPPLIER = 20
SHOWS_PER_MOVIE = 4
FIRST_SHOW_DAY = "1998-01-01"
SHOW_DAYS = 730
SEQUENCE = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}


class LazyTables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def day(text: str) -> Column:
    return F.lit(text).cast("date")


UNKNOWN_CUSTOMER = -9_999_999
FEED_KEY = ("booking_id", "show_id", "ticket_amount")


def _damage(df: DataFrame, source: Column, **broken: Column) -> DataFrame:
    """Overwrites each named column in a tenth of the rows, drawn per column."""
    return df.select(
        *[
            F.when(draws.uniform(source, list(broken).index(c)) < 0.1, broken[c].cast(kind.dataType))
            .otherwise(F.col(c))
            .alias(c)
            if c in broken
            else F.col(c)
            for c, kind in zip(df.columns, df.schema.fields)
        ]
    )


class Roles:
    """Lazily built frames over one folder of the driver's Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, table: str) -> DataFrame:
        """A driver table; the schema is given, so opening it runs no job."""
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem")

    @cached_property
    def theatres(self) -> DataFrame:
        source = draws.digest("theatre", "s_suppkey")
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("theatre_id"),
                F.col("s_name").alias("name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                draws.weighted_label(SCREEN_TYPES, SCREEN_WEIGHTS, draws.uniform(source, 0))
                .alias("screen_type"),
                (60 + draws.pick_below(341, draws.uniform(source, 1))).cast("int").alias("seat_capacity"),
            )
        )

    @cached_property
    def movies(self) -> DataFrame:
        source = draws.digest("movie", "p_partkey")
        return self.raw("part").select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre"),
            (60 + F.col("p_size") * 2).alias("duration_minutes"),
            draws.day_between(day(FIRST_SHOW_DAY), -1095, draws.uniform(source), skew=2.0)
            .alias("release_date"),
        )

    @cached_property
    def shows(self) -> DataFrame:
        source = draws.digest("show", "p_partkey")
        show_day = draws.day_between(day(FIRST_SHOW_DAY), SHOW_DAYS, draws.uniform(source, 0))
        hour = 9 + draws.pick_below(14, draws.uniform(source, 1))
        return self.raw("part").select(
            F.col("p_partkey").alias("show_id"),
            F.expr(f"p_partkey div {SHOWS_PER_MOVIE}").alias("movie_id"),
            F.expr(f"p_partkey div {PARTS_PER_SUPPLIER}").alias("theatre_id"),
            F.to_timestamp_ntz(F.concat_ws(" ", show_day, F.format_string("%02d:00:00", hour)))
            .alias("showtime"),
            F.col("p_brand").alias("screen_type"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("base_price"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """A negative balance stands for a broken e-mail address, a low one for a short phone number."""
        source = draws.digest("customer", "c_custkey")
        at = F.when(F.col("c_acctbal") < 0, F.lit(".at.")).otherwise(F.lit("@"))
        digits = F.when(F.col("c_acctbal") < 200, F.lit(5)).otherwise(F.lit(10))
        number = draws.pick_below(10**10, draws.uniform(source, 0)).cast("string")
        return self.raw("customer").join(
            self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(
                F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), at, F.lower("c_mktsegment"),
                F.lit(".example"),
            ).alias("email"),
            F.lpad(number, digits, F.lit("0")).alias("phone"),
            F.col("n_name").alias("city"),
            draws.day_between(day("1992-01-01"), 1095, draws.uniform(source, 1)).alias("signup_date"),
        )

    def _as_bookings(self, lines: DataFrame) -> DataFrame:
        status = (
            F.when(F.col("l_returnflag") == "N", "success")
            .when(F.col("l_returnflag") == "R", "failed")
            .otherwise("refunded")
        )
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")

        def percent(of: str) -> Column:
            return F.round(F.col(of) * 100).cast("bigint")

        amounts = lines.withColumn("ticket_amount", cents).withColumns(
            {
                "_fee": F.col("ticket_amount") * percent("l_tax"),
                "_off": F.col("ticket_amount") * percent("l_discount"),
                "payment_status": status,
            }
        )
        return amounts.join(
            self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        ).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("booking_id"),
            F.col("l_partkey").alias("show_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_quantity").cast("int").alias("seats_booked"),
            "ticket_amount",
            F.expr("_fee div 100").alias("fees"),
            F.expr("_off div 100").alias("discount"),
            F.col("o_orderpriority").alias("payment_gateway"),
            "payment_status",
            F.when(F.col("o_orderstatus") == "O", "mobile_app")
            .when(F.col("o_orderstatus") == "F", "web")
            .otherwise("box_office")
            .alias("booking_channel"),
            F.expr(
                "payment_status = 'refunded' OR (payment_status = 'success' AND l_linestatus = 'F')"
            ).alias("is_cancelled"),
            F.col("o_orderdate").cast("date").alias("booking_date"),
            F.col("l_shipdate").alias("_ingested_at"),
        )

    @cached_property
    def booking_feed(self) -> DataFrame:
        """Bookings as landed, repeated ids included."""
        return self._as_bookings(self.lines)

    @cached_property
    def bookings(self) -> DataFrame:
        """One row per booking id, the newest. Cut down to one before the orders are joined."""
        keys = ["l_orderkey", "l_linenumber"]
        return self._as_bookings(latest_per_key(self.lines, keys, SEQUENCE))

    @cached_property
    def faulty_theatres(self) -> DataFrame:
        source = draws.digest("bad theatre", "theatre_id")
        return _damage(
            self.theatres, source,
            theatre_id=F.lit(None), city=F.lit(None), screen_type=F.lit("DRIVE_IN"), seat_capacity=F.lit(0),
        )

    @cached_property
    def faulty_movies(self) -> DataFrame:
        source = draws.digest("bad movie", "movie_id")
        return _damage(
            self.movies, source,
            movie_id=F.lit(None), title=F.lit(None), duration_minutes=F.lit(-1), genre=F.lit(None),
        )

    @cached_property
    def faulty_shows(self) -> DataFrame:
        source = draws.digest("bad show", "show_id")
        return _damage(
            self.shows, source,
            show_id=F.lit(None), base_price=-F.col("base_price"), movie_id=F.lit(-1), theatre_id=F.lit(-1),
        )

    @cached_property
    def faulty_feed(self) -> DataFrame:
        """A tenth of the booking feed damaged; more than in life, so that each rule has work."""
        return shaping.inject_faults(self.booking_feed, 0.1, FEED_KEY, orphan=UNKNOWN_CUSTOMER)

    @property
    def booking_parents(self) -> dict[str, DataFrame]:
        return {
            "show_id": self.shows.select("show_id"),
            "customer_id": self.raw("customer").select(F.col("c_custkey").alias("customer_id")),
        }

    @cached_property
    def customer_feed(self) -> DataFrame:
        """Profiles and, for each order of a customer, a later change of the city."""
        first = self.customers.withColumns(
            {"_ingested_at": F.lit("1990-01-01").cast("timestamp_ntz"), "change": F.lit(-1).cast("bigint")}
        )
        moves = self.raw("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit("NATION_"), F.col("o_orderkey") % 25).alias("new_city"),
            F.col("o_orderdate").alias("_ingested_at"),
            F.col("o_orderkey").alias("change"),
        )
        moved = moves.join(self.customers, "customer_id").withColumn("city", F.col("new_city"))
        return first.unionByName(moved.select(*first.columns))

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_bookings(self.bookings, self.shows)

    @cached_property
    def occupancy(self) -> DataFrame:
        # Seats need the show id alone, which a booking has: no join stands before the sum.
        return star.show_occupancy(self.shows, self.theatres, self.bookings)

    @cached_property
    def tables(self) -> LazyTables:
        return LazyTables(
            {
                "fact_bookings": lambda: self.fact,
                "fact_show_occupancy": lambda: self.occupancy,
                "dim_theatre": lambda: star.dimension(self.theatres, "theatres"),
                "dim_movie": lambda: star.dimension(self.movies, "movies"),
            }
        )
