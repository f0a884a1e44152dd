"""One query per operator, each over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import booking, draws
from marquee.functions.pseudonyms import pseudonym
from marquee.operators import joins, quality, ranking, shaping
from marquee.operators.clustering import write_interleaved
from marquee.operators.latest import latest_per_key
from marquee.plans import reports, rollups, star
from marquee.plans.metrics import BOOKING_REVENUE, PAYMENT_HEALTH, THEATRE_OCCUPANCY, MetricView
from marquee.plans.rollups import Stored
from marquee.session import scratch_folder, short_lived_shuffles
from marquee.sources import deliveries, landing, storage
from marquee.streaming.lake import GOLD_LAYOUT, Lake, Layout
from marquee.streaming.parts import PartTable, turns_for
from marquee.streaming.refresh import FILES_PER_BATCH, Run, deliver, ingest, list_files, refresh
from workload.roles import SCHEMAS, SEQUENCE, Roles, day

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the registered queries.
SEGMENT_CODES = [
    ("AUTOMOBILE", "AU"), ("BUILDING", "BU"), ("FURNITURE", "FU"), ("HOUSEHOLD", "HO"), ("MACHINERY", "MA"),
]
GATEWAY_RANKS = [
    ("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5),
]
CHANNELS = ("mobile_app", "web", "box_office")
CHANNEL_WEIGHTS = (55, 35, 10)
INCIDENT_GATEWAY = "1-URGENT"
INCIDENT_CITIES = ("NATION_1", "NATION_5")
INCIDENT_DAYS = ("1997-01-01", "1997-12-31")
INCIDENT_FAILURE_RATE = 0.88
MERGE_BUCKETS = 16
CLUSTER_FILES = 64
REFRESH_DAY = date(1998, 1, 1)
GOLD_TOTALS = {
    "fact_bookings": "net_revenue", "dim_customer": "lifetime_spend * length(loyalty_segment)",
    "agg_movie_performance": "total_revenue * length(performance_tier)", "fact_show_occupancy": "seats_sold",
    "agg_daily_revenue_summary": "total_revenue + unique_customers",
}
DASHBOARD = {
    "Booking Date": ("1996-01-01", "1997-12-31"),
    "City": ["NATION_1", "NATION_2", "NATION_3"],
    "Payment Gateway": ["1-URGENT", "5-LOW"],
}


def query(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    """Registers a builder under its name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Roles(spark, folder))
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a precision at which two engines agree."""
    return df.select(
        *[F.round(f"`{n}`", digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def listed(df: DataFrame, column: str) -> DataFrame:
    """An array of names as text."""
    return df.withColumn(column, F.array_join(column, ","))


def shown_lineage(df: DataFrame) -> DataFrame:
    """What two engines can compare of the lineage: that it is there, and the name of the file."""
    seen = F.col("_ingested_at").isNotNull() & F.col("_landed_at").isNotNull()
    name = F.element_at(F.split("_source_file", "/"), -1)
    return df.withColumns({"has_lineage": seen, "file": name}).drop(*landing.LINEAGE.names)


# --- sources ---------------------------------------------------------------------------------


@query
def bronze_ingest(r: Roles) -> DataFrame:
    return shown_lineage(landing.with_lineage(r.raw("lineitem")))


@query
def bronze_stream(r: Roles) -> DataFrame:
    """The same through the ingest stream of the refresh job, into a new folder of the shared area."""
    entity = "lineitem.parquet"
    lake = Lake(r.spark, Layout(scratch_folder(r.spark, "bronze"), landing=r.folder), generation=1)
    files = r.spark.read.format("binaryFile").load(f"{r.folder}/{entity}")
    files = files.select("path", F.col("length").alias("bytes"))
    list_files(lake, entity, 1, None, 1, FILES_PER_BATCH, files)
    ingest(lake, entity, 1).awaitTermination()
    return shown_lineage(lake.bronze(entity))


@query
def bronze_stream_batches(r: Roles) -> DataFrame:
    """Three deliveries in folders of different depth, few files a batch, in two runs of the stream.

    The last delivery has one column more; the rows before it show NULL there.
    """
    entity, lines = "lines", r.raw("lineitem")
    root = scratch_folder(r.spark, "batches")
    lake = Lake(r.spark, Layout(f"{root}/lake", landing=f"{root}/landing"), generation=1)
    done = None
    for number, folder in enumerate(("full/deep", "later", "last")):
        delivery = lines.where(F.pmod("l_orderkey", F.lit(3)) == number)
        if folder == "last":
            delivery = delivery.withColumn("promo_code", F.col("l_orderkey"))
        landing.land(delivery, lake.layout.landing, entity, folder)
        if number:  # the first run finds two deliveries
            claim = deliveries.claim(r.spark, lake.layout.landing, entity)
            list_files(lake, entity, number, done, claim, files_per_batch=2)
            ingest(lake, entity, number).awaitTermination()
            done = claim
    storage.remove(r.spark, lake.layout.landing)
    return shown_lineage(lake.bronze(entity)).drop("file")


@query
def landed_history(r: Roles) -> DataFrame:
    history = landing.landed_history(r.spark, f"{r.folder}/lineitem.parquet")
    return history.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query
def landed_row_count(r: Roles) -> DataFrame:
    entities = ("customer", "orders", "lineitem", "part", "supplier")
    counts = [(e, landing.landed_rows(r.spark, f"{r.folder}/{e}.parquet")) for e in entities]
    return landing.lookup_table(r.spark, counts, "entity string, landed_rows bigint")


@query
def row_source_range(r: Roles) -> DataFrame:
    """The rows of a table as a numbered source, numbered over range partitions."""
    rows = ranking.row_numbers(r.raw("orders").select("o_orderkey"), [F.col("o_orderkey")], "number")
    return rows.select(
        "o_orderkey", (F.col("number") - 1).alias("id"), F.format_string("BKG-%08d", "number").alias("booking_id")
    )


@query
def lookup_inline(r: Roles) -> DataFrame:
    codes = landing.lookup_table(r.spark, SEGMENT_CODES, "c_mktsegment string, code string")
    return joins.lookup(r.raw("customer"), codes, "c_mktsegment").select("c_custkey", "code")


@query
def dim_date(r: Roles) -> DataFrame:
    newest = r.raw("orders").agg(F.max("o_orderdate").cast("date").alias("as_of"))
    return star.calendar(r.spark, bounds=newest)


@query
def preview_limit(r: Roles) -> DataFrame:
    return landing.preview(r.raw("orders"), 100, by=["o_orderkey"])


# --- projections and predicates --------------------------------------------------------------


@query
def dim_movie(r: Roles) -> DataFrame:
    return star.dimension(r.movies, "movies")


@query
def dim_show(r: Roles) -> DataFrame:
    return star.dimension(r.shows, "shows")


@query
def dim_theatre(r: Roles) -> DataFrame:
    return star.dimension(r.theatres, "theatres")


@query
def rename_projection(r: Roles) -> DataFrame:
    names = {"o_orderkey": "global_id", "o_custkey": "customer_id", "o_orderdate": "booking_date"}
    return r.raw("orders").select(*names).withColumnsRenamed(names)


@query
def realized_filter(r: Roles) -> DataFrame:
    return r.booking_feed.where(booking.realized()).select(
        "booking_id", booking.net_revenue().alias("net_revenue"), "_ingested_at"
    )


@query
def compound_predicate(r: Roles) -> DataFrame:
    many = F.col("seats_booked") >= 40
    urgent = F.col("payment_gateway") == "1-URGENT"
    early = F.col("booking_date") < day("1997-01-01")
    return r.booking_feed.where((many & ~urgent) | (early & urgent & ~F.col("is_cancelled"))).select(
        "booking_id", "seats_booked", "payment_gateway", "booking_date", "is_cancelled", "ticket_amount"
    )


# --- quality and referential integrity -------------------------------------------------------


@query
def dq_theatres(r: Roles) -> DataFrame:
    return quality.passing(r.faulty_theatres, quality.RULES["theatres"])


@query
def dq_movies(r: Roles) -> DataFrame:
    return quality.passing(r.faulty_movies, quality.RULES["movies"])


@query
def dq_shows(r: Roles) -> DataFrame:
    return quality.passing(r.faulty_shows, quality.RULES["shows"])


@query
def dq_customers(r: Roles) -> DataFrame:
    rules = quality.RULES["customers"]
    return listed(quality.with_broken_rules(quality.passing(r.customers, rules), rules, "broken"), "broken")


@query
def dq_bookings(r: Roles) -> DataFrame:
    return quality.passing(r.faulty_feed, quality.RULES["bookings"])


@query
def dq_violation_counts(r: Roles) -> DataFrame:
    frames = {
        "theatres": r.faulty_theatres,
        "movies": r.faulty_movies,
        "shows": r.faulty_shows,
        "customers": r.customers,
        "bookings": joins.keep_referenced(r.faulty_feed, r.booking_parents),
    }
    counts = [quality.violation_counts(df, name, quality.RULES[name]) for name, df in frames.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query
def dq_quarantine(r: Roles) -> DataFrame:
    return listed(quality.quarantine(r.faulty_feed, quality.RULES["bookings"], "broken"), "broken").select(
        "booking_id", "show_id", "customer_id", "ticket_amount", "payment_status", "broken"
    )


@query
def ri_shows(r: Roles) -> DataFrame:
    parents = {"movie_id": r.movies.select("movie_id"), "theatre_id": r.theatres.select("theatre_id")}
    return joins.keep_referenced(r.faulty_shows, parents)


@query
def ri_bookings(r: Roles) -> DataFrame:
    return joins.keep_referenced(r.faulty_feed, r.booking_parents)


@query
def ri_orphans(r: Roles) -> DataFrame:
    return listed(joins.orphans(r.faulty_feed, r.booking_parents), "_missing").select(
        "booking_id", "show_id", "customer_id", "ticket_amount", F.col("_missing").alias("missing")
    )


@query
def silver_bookings(r: Roles) -> DataFrame:
    referenced = joins.keep_referenced(r.faulty_feed, r.booking_parents)
    return latest_per_key(
        quality.passing(referenced, quality.RULES["bookings"]), ["booking_id"], ["_ingested_at"]
    )


@query
def cdc_latest_bookings(r: Roles) -> DataFrame:
    return r.bookings


@query
def cdc_latest_customers(r: Roles) -> DataFrame:
    return latest_per_key(r.customer_feed, ["customer_id"], ["_ingested_at", "change"])


@query
def silver_shows(r: Roles) -> DataFrame:
    """Rules and references together: shows whose movie and theatre passed their own rules."""
    parents = {
        "movie_id": quality.passing(r.faulty_movies, quality.RULES["movies"]).select("movie_id"),
        "theatre_id": quality.passing(r.faulty_theatres, quality.RULES["theatres"]).select("theatre_id"),
    }
    return quality.passing(joins.keep_referenced(r.faulty_shows, parents), quality.RULES["shows"])


@query
def silver_customers(r: Roles) -> DataFrame:
    """The newest profile of each customer that passes, with the warnings it carries."""
    rules = quality.RULES["customers"]
    newest = latest_per_key(
        quality.passing(r.customer_feed, rules), ["customer_id"], ["_ingested_at", "change"]
    )
    return listed(quality.with_broken_rules(newest, rules, "broken"), "broken")


@query
def cdc_merge_bookings(r: Roles) -> DataFrame:
    """Three deliveries through the bucketed merge: a snapshot, then newer rows, then late older ones.

    Each delivery overlaps the one before, so some changes are replays.
    """
    key, sequence, at = ["booking_id"], ["_ingested_at"], F.col("_ingested_at")
    table = PartTable(r.spark, scratch_folder(r.spark, "merge"))
    snapshot = r.booking_feed.where((at >= day("1994-01-01")) & (at < day("1996-01-01")))
    state = table.merge(None, snapshot, 1, key, sequence, buckets=MERGE_BUCKETS)
    state = table.merge(state, r.booking_feed.where(at >= day("1995-07-01")), 2, key, sequence)
    state = table.merge(state, r.booking_feed.where(at < day("1994-07-01")), 3, key, sequence)
    return table.read(state)


# --- the refresh job -------------------------------------------------------------------------


def _landing(r: Roles, name: str, **feeds: DataFrame) -> Layout:
    """A lake of its own with a full load of all entities."""
    root = scratch_folder(r.spark, name)
    layout = Layout(f"{root}/lake", f"{root}/landing")
    whole = {"theatres": r.theatres, "movies": r.movies, "customers": r.customers, "shows": r.shows, **feeds}
    deliver(r.spark, layout, {e: df.select(*star.COLUMNS[e]) for e, df in whole.items()})
    return layout


def _corrected(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Of each booking id its oldest row, and the newest one where there are others."""
    keys = ["l_orderkey", "l_linenumber"]
    row = F.struct(*SEQUENCE)
    ends = r.lines.groupBy(*keys).agg(F.min(row).alias("first"), F.max(row).alias("last"))
    first = r._as_bookings(ends.select(*keys, "first.*"))
    return first, r._as_bookings(ends.where(F.col("first") != F.col("last")).select(*keys, "last.*"))


def _stepwise(r: Roles, name: str) -> tuple[Layout, Run]:
    """A full load of the oldest rows, then a delivery of corrections, each taken in by a refresh."""
    first, corrections = _corrected(r)
    layout = _landing(r, name, bookings=first)
    refresh(r.spark, layout, as_of=REFRESH_DAY, compact_every=1)
    deliver(r.spark, layout, {"bookings": corrections.select(*star.COLUMNS["bookings"])}, "day=1")
    return layout, refresh(r.spark, layout, as_of=REFRESH_DAY)


def _spans(months: list[int], turns: int) -> list[Column]:
    """Conditions that share out all days, whatever their months, by about as many of ``months`` each."""
    starts = [months[len(months) * i // turns] * 100 for i in range(1, turns)]
    day, spans = F.col("date_key"), []
    for low, high in zip([None, *starts], [*starts, None], strict=True):
        span = F.lit(True) if low is None else day >= low
        spans.append(span if high is None else span & (day < high))
    return [spans[0] | day.isNull(), *spans[1:]]


def _compared(table: str, one: Run, other: Run) -> list[DataFrame]:
    """The table's rows in ``one`` and their total, and how many rows ``other`` has otherwise.

    A line for each span of days of a large table by day: both whole sides in one shuffle take more disk than the tables.
    """
    ours, theirs = one.lake.gold(table, one.number), other.lake.gold(table, other.number)
    spans = [F.lit(True)]
    if GOLD_LAYOUT[table][0] == "date_key":
        parts = [run.lake.gold_manifest(table, run.number).parts for run in (one, other)]
        months = sorted({int(p) for side in parts for p in side})
        turns = min(turns_for(ours.count() + theirs.count()), len(months))
        spans = _spans(months, turns) if turns > 1 else spans
    total = F.expr(GOLD_TOTALS.get(table, "0")).cast("bigint").alias("_total")
    lines = []
    for span in spans:
        both = ours.withColumn("_side", F.lit(1)).unionByName(theirs.withColumn("_side", F.lit(-1))).where(span)
        sides = both.groupBy(*ours.columns).agg(
            F.sum("_side").alias("_side"), F.count_if(F.col("_side") > 0).alias("_ours")
        ).select("_side", "_ours", total)
        lines.append(sides.agg(
            F.lit(table).alias("table_name"), F.sum("_ours").alias("stored_rows"), F.sum(F.abs("_side")).alias("differing"),
            F.sum(F.col("_total") * F.col("_ours")).alias("total"),
        ))
    return lines


@query
def incremental_equals_full(r: Roles) -> DataFrame:
    """For each gold table its rows and a total after refreshes by change, and how many rows a rebuild has otherwise."""
    layout, done = _stepwise(r, "both")
    full = refresh(r.spark, layout, "full", as_of=REFRESH_DAY)
    with short_lived_shuffles(r.spark):
        lines = []
        for table in GOLD_LAYOUT:
            found = _compared(table, done, full)
            if len(found) > 1:  # one after the other, as only then the shuffles of one span stand on disk
                rows = [tuple(line.first()) for line in found]
                spans = landing.lookup_table(r.spark, rows, "table_name string, stored_rows bigint, differing bigint, total bigint")
                found = [spans.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in spans.columns[1:]])]
            lines += found
    return reduce(DataFrame.unionByName, lines)


@query
def refresh_quality_counts(r: Roles) -> DataFrame:
    """Rule counts that a refresh observed while it wrote; orphans are not among them."""
    layout = _landing(r, "quality", bookings=r.faulty_feed)
    counts = refresh(r.spark, layout, as_of=REFRESH_DAY).lake.quality()
    return counts.groupBy("dataset", "rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query
def clustered_lines(r: Roles) -> DataFrame:
    """lineitem clustered by ship date and supplier alike, then read with a filter on the second."""
    path = scratch_folder(r.spark, "clustered")
    write_interleaved(r.raw("lineitem"), path, ["l_shipdate", "l_suppkey"], files=CLUSTER_FILES)
    stored = r.spark.read.schema(SCHEMAS["lineitem"]).parquet(path)
    return stored.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


@query
def weight_thresholds(r: Roles) -> DataFrame:
    """Running shares of the priorities' frequencies, as the thresholds of a weighted draw."""
    counts = r.raw("orders").groupBy("o_orderpriority").count().orderBy("o_orderpriority").toLocalIterator()
    names, weights = zip(*[(row["o_orderpriority"], row["count"]) for row in counts], strict=True)  # five
    shares = zip(names, draws.thresholds(weights), strict=True)
    return rounded(landing.lookup_table(r.spark, list(shares), "o_orderpriority string, upto double"))


@query
def metric_comments(r: Roles) -> DataFrame:
    """What stands in a stored result of a view: each column with its comment, and its rows."""
    result = PAYMENT_HEALTH.with_comments(PAYMENT_HEALTH.query(r.tables, ["City"]))
    path = scratch_folder(r.spark, "comments")
    result.write.parquet(path)
    stored = r.spark.read.parquet(path)
    lines = [(f.name, f.metadata.get("comment")) for f in stored.schema.fields]
    return landing.lookup_table(r.spark, lines, "name string, comment string").withColumn("cities", F.lit(stored.count()))


@query
def full_load_read(r: Roles) -> DataFrame:
    """A full load that was replaced by another, read back."""
    root, orders = scratch_folder(r.spark, "full"), r.raw("orders")
    landing.land(orders.where(F.col("o_orderkey") % 2 == 0), root, "orders", landing.FULL_LOAD, "overwrite")
    landing.land(orders, root, "orders", landing.FULL_LOAD, "overwrite")
    return landing.read_full_load(r.spark, root, "orders")


@query
def claimed_files(r: Roles) -> DataFrame:
    """Two deliveries, each claimed, and the history read from the archive."""
    root, orders = scratch_folder(r.spark, "claims"), r.raw("orders")
    for folder, even in (("full_load", 0), ("day=1", 1)):
        landing.land(orders.where(F.col("o_orderkey") % 2 == even), root, "orders", folder)
        claim = deliveries.claim(r.spark, root, "orders")
    history = landing.landed_history(r.spark, f"{root}/{landing.ARCHIVE}/orders", orders.schema)
    return history.withColumn("claims", F.lit(claim))


@query
def streaming_table_read(r: Roles) -> DataFrame:
    """A stored table read as a stream, cleansed and written by a sink that keeps what it has."""
    root = scratch_folder(r.spark, "stream")
    orders = r.spark.readStream.schema(SCHEMAS["orders"]).option("maxFileAge", "36500d").option("recursiveFileLookup", "true").parquet(f"{r.folder}/orders.parquet")
    rules = (quality.Rule("has_price", "o_totalprice > 0"), quality.Rule("not_urgent", "o_orderpriority <> '1-URGENT'"))
    write = quality.passing(orders, rules).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    write.trigger(availableNow=True).start(f"{root}/table").awaitTermination()
    return r.spark.read.schema(SCHEMAS["orders"]).parquet(f"{root}/table")


@query
def fixture_reader(r: Roles) -> DataFrame:
    """The customers written as a CSV fixture and read back: every column is text."""
    path = f"{scratch_folder(r.spark, 'fixture')}/customers.csv"
    r.raw("customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", "true").csv(path)
    return landing.read_fixture(r.spark, path)


@query
def dq_fail_rules(r: Roles) -> DataFrame:
    """Rules that would stop the run hold; drop rules then remove what is left."""
    rules = (
        quality.Rule("has_id", "booking_id IS NOT NULL", "fail"), quality.Rule("paid", "payment_status = 'success'"),
        quality.Rule("has_seats", "seats_booked > 0", "fail"),
    )
    return quality.enforce(r.booking_feed, "bookings", rules).select("booking_id", "seats_booked", "payment_status")


@query
def metric_equals_manual(r: Roles) -> DataFrame:
    """Revenue by city through the metric view and by a sum written out."""
    manual = (
        r.fact.join(r.theatres.select("theatre_id", "city"), "theatre_id").where(booking.realized())
        .groupBy("city").agg(F.sum("net_revenue").alias("manual"))
    )
    metric = BOOKING_REVENUE.query(r.tables, ["City"], ["Total Revenue"])
    return metric.toDF("city", "metric").join(manual, "city", "left")


# --- star schema -----------------------------------------------------------------------------


@query
def fact_bookings(r: Roles) -> DataFrame:
    return r.fact


@query
def show_occupancy(r: Roles) -> DataFrame:
    return rounded(r.occupancy)


@query
def customer_spend(r: Roles) -> DataFrame:
    return star.customer_spend(r.fact)


@query
def dim_customer(r: Roles) -> DataFrame:
    return star.dim_customer(r.customers, r.fact)


@query
def movie_performance(r: Roles) -> DataFrame:
    return star.movie_performance(r.movies, r.fact)


@query
def daily_revenue_summary(r: Roles) -> DataFrame:
    return rounded(star.daily_revenue_summary(r.fact, r.theatres))


@query
def ntile_distributed(r: Roles) -> DataFrame:
    spenders = star.with_totals(r.customers.select("customer_id"), star.customer_spend(r.fact), "customer_id")
    order = [F.col("lifetime_spend").desc(), F.col("customer_id").asc()]
    return ranking.ntile(spenders, 4, order, "quartile", distributed=True)


@query
def percent_rank_distributed(r: Roles) -> DataFrame:
    earners = star.with_totals(r.movies.select("movie_id"), star.movie_totals(r.fact), "movie_id")
    return rounded(ranking.percent_rank(earners, "total_revenue", "percentile", distributed=True))


# --- metric views and reports ----------------------------------------------------------------


@query
def metric_booking_revenue(r: Roles) -> DataFrame:
    return rounded(BOOKING_REVENUE.query(r.tables, ["City", "Genre", "Payment Gateway"]))


@query
def metric_booking_revenue_by_title(r: Roles) -> DataFrame:
    by = ["Movie Title", "Theatre Name", "Booking Channel"]
    return rounded(BOOKING_REVENUE.query(r.tables, by, preaggregate=True))


@query
def metric_payment_health(r: Roles) -> DataFrame:
    return rounded(PAYMENT_HEALTH.query(r.tables, ["Payment Gateway", "City", "Booking Date"]))


@query
def metric_theatre_occupancy(r: Roles) -> DataFrame:
    by = ["Theatre Name", "City", "Screen Type", "Show Date"]
    return rounded(THEATRE_OCCUPANCY.query(r.tables, by))


@query
def filtered_revenue(r: Roles) -> DataFrame:
    return rounded(BOOKING_REVENUE.query(r.tables, ["City", "Payment Gateway"], filters=DASHBOARD))


@query
def filtered_payment_health(r: Roles) -> DataFrame:
    return rounded(PAYMENT_HEALTH.query(r.tables, ["City", "Payment Gateway"], filters=DASHBOARD))


@query
def filtered_occupancy(r: Roles) -> DataFrame:
    """The same filters: a view skips those it has no dimension for."""
    return rounded(THEATRE_OCCUPANCY.query(r.tables, ["City", "Screen Type"], filters=DASHBOARD))


@query
def kpi_counters(r: Roles) -> DataFrame:
    return rounded(reports.kpi_counters(r.tables))


@query
def weekly_revenue_trend(r: Roles) -> DataFrame:
    return reports.weekly_revenue_trend(r.tables)


@query
def payment_health_rollup(r: Roles) -> DataFrame:
    return rounded(reports.payment_health_rollup(r.tables))


@query
def failure_rate_by_date_gateway(r: Roles) -> DataFrame:
    return rounded(reports.failure_rate_by_date_gateway(r.tables))


@query
def city_gateway_heatmap(r: Roles) -> DataFrame:
    return rounded(reports.city_gateway_heatmap(r.tables))


@query
def city_gateway_grid(r: Roles) -> DataFrame:
    return rounded(reports.city_gateway_grid(r.tables, [name for name, _ in GATEWAY_RANKS]))


@query
def worst_payment_slices(r: Roles) -> DataFrame:
    return rounded(reports.worst_payment_slices(r.tables, ("Payment Gateway", "City")))


@query
def worst_payment_slices_by_quarter(r: Roles) -> DataFrame:
    """All three dimensions; some slices have fewer than 20 bookings and some have more."""
    quarter = F.trunc("booking_date", "quarter")
    tables = {**r.tables, "fact_bookings": r.fact.withColumn("booking_date", quarter)}
    return rounded(reports.worst_payment_slices(tables))


@query
def revenue_by_city(r: Roles) -> DataFrame:
    return reports.revenue_by(r.tables, "City")


@query
def channel_split(r: Roles) -> DataFrame:
    return reports.revenue_by(r.tables, "Booking Channel")


@query
def top_movies(r: Roles) -> DataFrame:
    return reports.top_movies(r.tables)


@query
def occupancy_by_screen(r: Roles) -> DataFrame:
    return rounded(reports.occupancy_by(r.tables, "Screen Type"))


@query
def occupancy_by_city(r: Roles) -> DataFrame:
    return rounded(reports.occupancy_by(r.tables, "City"))


@query
def failure_rate_status(r: Roles) -> DataFrame:
    return rounded(reports.failure_rate_status(r.tables, ("City", "Payment Gateway"), amber=0.33, red=0.36))


def _rolled_up(r: Roles, view: MetricView, *by: str) -> Stored:
    """The tables with a stored aggregate of one view."""
    folder = scratch_folder(r.spark, "rollup")
    return Stored(r.tables, (rollups.make_rollup(view, r.tables, by, folder),))


@query
def unique_customers_from_partials(r: Roles) -> DataFrame:
    """Distinct customers by day, by city and overall, all from one stored partial."""
    tables = _rolled_up(r, BOOKING_REVENUE, "Booking Date", "City")
    levels = []
    for level, by in (("day", ["Booking Date"]), ("city", ["City"]), ("all", [])):
        found = BOOKING_REVENUE.query(tables, by, ["Unique Customers"])
        slice_ = F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in by]) if by else F.lit("")
        levels.append(found.select(F.lit(level).alias("level"), slice_.alias("slice"), F.col("Unique Customers").alias("customers")))
    return reduce(DataFrame.unionByName, levels)


@query
def kpi_counters_from_rollup(r: Roles) -> DataFrame:
    return rounded(reports.kpi_counters(_rolled_up(r, BOOKING_REVENUE, "Booking Date", "City")))


@query
def heatmap_from_rollup(r: Roles) -> DataFrame:
    tables = _rolled_up(r, PAYMENT_HEALTH, "Booking Date", "City", "Payment Gateway")
    return rounded(reports.city_gateway_heatmap(tables))


# --- shaping ---------------------------------------------------------------------------------


@query
def broadcast_lookup(r: Roles) -> DataFrame:
    ranks = landing.lookup_table(r.spark, GATEWAY_RANKS, "o_orderpriority string, priority_rank int")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        joins.lookup(r.raw("orders"), ranks, "o_orderpriority")
        .groupBy("priority_rank")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(cents).alias("total_cents"))
    )


def _movie_weights(r: Roles) -> DataFrame:
    """Popularity of each movie as an integer weight."""
    label = F.format_string("MOV-%05d", F.col("p_partkey") + 1)
    weight = F.floor(draws.popularity(label) * 1_000_000)
    return r.raw("part").select(F.col("p_partkey").alias("movie_id"), weight.alias("weight"))


@query
def range_bucket_join(r: Roles) -> DataFrame:
    picks = r.raw("orders").select(
        "o_orderkey", draws.uniform(draws.digest("movie pick", "o_orderkey")).alias("position")
    )
    buckets = ranking.weight_buckets(_movie_weights(r), "movie_id", "weight")
    return joins.range_bucket_join(picks, buckets, "position").select("o_orderkey", "movie_id")


@query
def range_bucket_join_distributed(r: Roles) -> DataFrame:
    """The same picks with the running weights summed without a single-task window."""
    picks = r.raw("orders").select(
        "o_orderkey", draws.uniform(draws.digest("movie pick", "o_orderkey")).alias("position")
    )
    buckets = ranking.weight_buckets(_movie_weights(r), "movie_id", "weight", distributed=True)
    return joins.range_bucket_join(picks, buckets, "position").select("o_orderkey", "movie_id")


@query
def union_by_name(r: Roles) -> DataFrame:
    parties = r.raw("customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return parties.unionByName(
        r.raw("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    )


@query
def hash_sample(r: Roles) -> DataFrame:
    return shaping.hash_sample(r.raw("orders"), 0.1, ["o_orderkey"])


@query
def hash_uniform(r: Roles) -> DataFrame:
    source = draws.digest("uniform", "o_orderkey")
    return rounded(
        r.raw("orders").select(
            "o_orderkey", draws.uniform(source, 0).alias("first"), draws.uniform(source, 7).alias("last")
        ),
        9,
    )


@query
def popularity_weight(r: Roles) -> DataFrame:
    label = F.format_string("MOV-%05d", F.col("p_partkey") + 1)
    return rounded(
        r.raw("part").select(label.alias("movie_id"), draws.popularity(label).alias("weight")), 9
    )


@query
def weighted_category(r: Roles) -> DataFrame:
    draw = draws.uniform(draws.digest("channel", "o_orderkey"))
    return r.raw("orders").select(
        "o_orderkey",
        draws.weighted_index(CHANNEL_WEIGHTS, draw).alias("channel_index"),
        draws.weighted_label(CHANNELS, CHANNEL_WEIGHTS, draw).alias("channel"),
    )


@query
def uniform_fk(r: Roles) -> DataFrame:
    shows = landing.landed_rows(r.spark, f"{r.folder}/part.parquet")
    return r.raw("orders").select(
        "o_orderkey",
        draws.pick_below(shows, draws.uniform(draws.digest("show pick", "o_orderkey"))).alias("show_id"),
    )


@query
def skewed_fk(r: Roles) -> DataFrame:
    customers = landing.landed_rows(r.spark, f"{r.folder}/customer.parquet")
    draw = draws.uniform(draws.digest("customer pick", "o_orderkey"))
    return r.raw("orders").select("o_orderkey", draws.pick_below(customers, draw, skew=3.0).alias("customer_id"))


@query
def date_spread(r: Roles) -> DataFrame:
    source = draws.digest("days", "o_orderkey")
    ordered = F.col("o_orderdate").cast("date")
    return r.raw("orders").select(
        "o_orderkey",
        draws.day_between(ordered, 181, draws.uniform(source, 0)).alias("spread_day"),
        draws.day_between(ordered, -1095, draws.uniform(source, 1), skew=2.0).alias("recent_day"),
    )


@query
def clamped_normal(r: Roles) -> DataFrame:
    source = draws.digest("duration", "o_orderkey")
    return r.raw("orders").select(
        "o_orderkey", draws.clamped_normal(source, 130, 20, 80, 220).alias("duration_minutes")
    )


@query
def incident_overlay(r: Roles) -> DataFrame:
    placed = r.fact.join(r.theatres.select("theatre_id", "city"), "theatre_id")
    slice_ = (
        (F.col("payment_gateway") == INCIDENT_GATEWAY)
        & F.col("city").isin(*INCIDENT_CITIES)
        & F.col("booking_date").between(*[day(d) for d in INCIDENT_DAYS])
    )
    return shaping.payment_incident(placed, slice_, INCIDENT_FAILURE_RATE, ["booking_id"]).select(
        "booking_id", "payment_gateway", "city", "booking_date", "payment_status"
    )


@query
def fault_injection(r: Roles) -> DataFrame:
    return r.faulty_feed


@query
def id_continuation(r: Roles) -> DataFrame:
    landed = landing.landed_rows(r.spark, f"{r.folder}/customer.parquet")
    return shaping.continue_ids(
        r.raw("supplier").select("s_suppkey"), landed, [F.col("s_suppkey").asc()], "customer_id", "CUST-%07d"
    )


@query
def pseudonymize(r: Roles) -> DataFrame:
    kinds = ("person_name", "theatre_name", "movie_title", "email", "phone")
    return r.raw("customer").select("c_custkey", *[pseudonym(k, "c_custkey").alias(k) for k in kinds])


# --- scalar functions ------------------------------------------------------------------------


@query
def scalar_strings(r: Roles) -> DataFrame:
    key = F.col("c_custkey") + 1
    return r.raw("customer").select(
        "c_custkey",
        F.format_string("CUST-%07d", key).alias("customer_id"),
        F.lpad(key.cast("string"), 9, "0").alias("padded"),
        F.concat_ws(" ", "c_mktsegment", F.format_string("%02d:00:00", F.col("c_nationkey"))).alias("slot"),
        F.col("c_name").rlike(r"^Customer#[0-9]{8}[02468]$").alias("even_name"),
    )


@query
def scalar_dates(r: Roles) -> DataFrame:
    ordered = F.col("o_orderdate")
    text = F.concat_ws(" ", ordered.cast("date"), F.lit("13:00:00"))
    return r.raw("orders").select(
        "o_orderkey",
        F.date_add(ordered, 730).alias("later"),
        F.date_sub(ordered, 1095).alias("earlier"),
        F.to_date(ordered).alias("order_day"),
        F.to_timestamp_ntz(text).alias("at_one"),
        booking.date_key(ordered).alias("date_key"),
        F.year(ordered).alias("year"),
        F.quarter(ordered).alias("quarter"),
        F.month(ordered).alias("month"),
        F.day(ordered).alias("day"),
        F.dayofweek(ordered).alias("weekday"),
        F.date_trunc("week", ordered).cast("date").alias("week"),
    )


@query
def scalar_math(r: Roles) -> DataFrame:
    balance = F.col("c_acctbal")
    return r.raw("customer").select(
        "c_custkey",
        F.floor(balance / 7).alias("floored"),
        balance.cast("int").alias("truncated"),
        F.greatest(F.lit(80), F.least(F.lit(220), balance.cast("int"))).alias("clamped"),
        F.round(F.pow(balance / 10000, 3), 6).alias("cubed"),
        F.coalesce(F.when(balance > 0, balance), F.lit(0.0)).alias("non_negative"),
        F.try_divide(balance, F.when(balance > 5000, F.lit(2.0))).alias("halved"),
        F.col("c_custkey").cast("string").alias("as_text"),
    )
