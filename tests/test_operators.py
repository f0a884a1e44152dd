"""Operators on small frames: ties, hot keys, NULLs, empty input, repeatability."""

from __future__ import annotations

import json
import random
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee.functions import booking, draws
from marquee.functions.pseudonyms import pseudonym
from marquee.operators import joins, quality, ranking, shaping
from marquee.operators.latest import latest_per_key, merge_changes
from marquee.plans import reports, star
from marquee.plans.metrics import BOOKING_REVENUE, PAYMENT_HEALTH, VIEWS
from marquee.sources import landing
from tests.world import booking as row
from tests.world import customer, frame, movie, rows, show, theatre
from workload.catalog import QUERIES


# --- ranking ---------------------------------------------------------------------------------


def hot_values(spark, n=5000):
    """Most rows share one value, as zero spend does."""
    values = [(i, 0 if i % 3 else i % 97) for i in range(n)]
    random.Random(7).shuffle(values)
    return spark.createDataFrame(values, "id bigint, v bigint").repartition(7)


@pytest.mark.parametrize("tiles", [4, 7])
def test_ntile_matches_window_with_hot_value(spark, tiles):
    df = hot_values(spark)
    order = [F.col("v").desc(), F.col("id").asc()]
    ours = ranking.ntile(df, tiles, order, "t", distributed=True)
    theirs = ranking.ntile(df, tiles, order, "t", distributed=False)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_no_task_takes_the_hot_value_alone(spark):
    """The hot value is cut by the tie-break, so every range keeps its share of the rows."""
    placed = ranking.rows_before(hot_values(spark), [F.col("v").asc(), F.col("id").asc()], "b", "n")
    sizes = [len(p) for p in placed.select("b").rdd.glom().collect() if p]
    assert sum(sizes) == 5000 and max(sizes) < 5000 / 4
    assert sorted(r.b for r in placed.select("b").collect()) == list(range(5000))


def test_percent_rank_matches_window(spark):
    df = hot_values(spark)
    ours = ranking.percent_rank(df, "v", "p", distributed=True)
    theirs = ranking.percent_rank(df, "v", "p", distributed=False)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_percent_rank_of_a_hot_value_and_nulls(spark):
    """60 % equal values over several ranges, with nulls before them; nothing is joined by value."""
    v = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 5 < 3, 7).otherwise(F.col("id") % 40)
    df = spark.range(4000).withColumn("v", v)
    ours = ranking.percent_rank(df, "v", "p", distributed=True)
    theirs = ranking.percent_rank(df, "v", "p", distributed=False)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    plan = ours._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("distributed", [True, False])
def test_ranks_of_few_rows(spark, distributed):
    spends = spark.createDataFrame(list(enumerate([100, 50, 50, 0, 0, 0, 0, 0])), "id bigint, v bigint")
    order = [F.col("v").desc(), F.col("id").asc()]
    tiles = ranking.ntile(spends, 4, order, "t", distributed)
    assert rows(tiles, "id", "t") == [(i, i // 2 + 1) for i in range(8)]
    two = ranking.ntile(spends.where("id < 2"), 4, order, "t", distributed)
    assert rows(two, "id", "t") == [(0, 1), (1, 2)]
    one = ranking.percent_rank(spends.where("id = 0"), "v", "p", distributed)
    assert rows(one, "p") == [(0.0,)]
    assert ranking.ntile(spends.where("id < 0"), 4, order, "t", distributed).isEmpty()
    assert ranking.percent_rank(spends.where("id < 0"), "v", "p", distributed).isEmpty()


def test_revenue_tiers(spark):
    revenue = spark.createDataFrame(list(enumerate([0, 0, 0, 10, 20, 30, 40, 50, 60, 70])), "id int, v bigint")
    tiers = ranking.percent_rank(revenue, "v", "p", distributed=True).select(
        booking.performance_tier(F.col("p")).alias("tier")
    )
    assert {r.tier: r["count"] for r in tiers.groupBy("tier").count().collect()} == {
        "hit": 2, "steady": 4, "underperforming": 4
    }


def test_continue_ids(spark):
    df = spark.createDataFrame([(c,) for c in "dbca"], "k string")
    for distributed in (True, False):
        ids = shaping.continue_ids(df, 5, [F.col("k").asc()], "id", "CUST-%07d", distributed)
        assert rows(ids, "k", "id") == [(c, f"CUST-000000{6 + i}") for i, c in enumerate("abcd")]


# --- latest per key --------------------------------------------------------------------------


def test_latest_sequence_and_ties(spark):
    schema = "k string, seq int, status string"
    batches = [
        [("K1", 1, "success"), ("K2", 1, "failed")], [("K1", 3, "refunded")],
        [("K1", 2, "success"), ("K3", 1, "success")],
    ]
    current = spark.createDataFrame([], schema)
    for batch in [*batches, *batches]:
        changes = spark.createDataFrame(batch, schema)
        # Materialized, as the stored table is between two refreshes.
        merged = merge_changes(current, changes, ["k"], ["seq"]).collect()
        current = spark.createDataFrame(merged, schema)
    assert rows(current, "k", "seq", "status") == [("K1", 3, "refunded"), ("K2", 1, "failed"), ("K3", 1, "success")]
    tied = [("K4", 1, "a"), ("K4", 1, "b"), ("K4", 1, None)]
    for order in (tied, tied[::-1]):
        winner = latest_per_key(spark.createDataFrame(order, schema).repartition(3), ["k"], ["seq"])
        assert rows(winner, "status") == [("b",)]


def test_latest_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


# --- joins -----------------------------------------------------------------------------------


def test_references_and_orphans(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "z"), (3, "q", "z"), (4, None, "x"), (5, "a", "x")], "id int, fa string, fb string"
    )
    parents = {
        "fa": spark.createDataFrame([("a",), ("a",), ("b",)], "fa string"),
        "fb": spark.createDataFrame([("x",)], "key string"),
    }
    assert rows(joins.keep_referenced(df, parents), "id") == [(1,), (5,)]
    lost = {r.id: list(r._missing) for r in joins.orphans(df, parents).collect()}
    assert lost == {2: ["fb"], 3: ["fa", "fb"], 4: ["fa"]}
    assert joins.tag_orphans(df, parents).count() == 5


def test_broadcast_only_below_the_limit(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(joins.broadcast_if_small(spark.range(10), 10))
    assert not hinted(joins.broadcast_if_small(spark.range(11), 10))
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("ids"))
    assert hinted(joins.broadcast_if_small(wide, 10))
    assert not hinted(joins.broadcast_if_small(wide, 10, max_bytes=9_000))
    assert hinted(joins.broadcast_if_small(spark.range(0), 10))


def test_range_bucket_join_is_exact(spark):
    rng = random.Random(3)
    cuts = sorted([0.0, 1.0, *[rng.random() ** 4 for _ in range(300)]])
    buckets = [(i, lo, hi) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
    points = [(i, v) for i, v in enumerate([*cuts[:-1], *[rng.random() for _ in range(500)]])]
    expected = sorted(
        (i, b) for i, v in points for b, lo, hi in buckets if lo <= v < hi
    )
    joined = joins.range_bucket_join(
        spark.createDataFrame(points, "i int, v double"),
        spark.createDataFrame(buckets, "b int, lo double, hi double"), "v", bins=16,
    )
    assert sorted((r.i, r.b) for r in joined.select("i", "b").collect()) == expected
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_range_bins_hold_few_buckets_each(spark):
    """Half of all buckets crowd into a thousandth of the range, the rest follow Zipf's law."""
    widths = [1e-3 / 5000] * 5000 + [1 / (k + 1) for k in range(5000)]
    total, at, buckets = sum(widths), 0.0, []
    for i, width in enumerate(widths):
        buckets.append((i, at / total, (at + width) / total))
        at += width
    df = spark.createDataFrame(buckets, "b int, lo double, hi double")
    crowded = {}
    for bins in (4096, 256):
        bin_of = joins.range_bins(df, bins=bins)
        spread = df.select(F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))).alias("bin"))
        sizes = spread.groupBy("bin").count()
        crowded[bins] = sizes.agg(F.max("count")).first()[0]
        assert spread.count() <= 6 * len(buckets)
    assert crowded[4096] <= 5 and crowded[256] <= 41, crowded
    points = spark.range(2000).select("id", ((F.col("id") + 0.5) / 2000).alias("v"))
    for bins in (4096, 256, 1):
        joined = joins.range_bucket_join(points, df, "v", bins=bins)
        assert joined.count() == 2000 and joined.where("v < lo or v >= hi").isEmpty()


def test_spread_buckets_are_not_broadcast(spark, tmp_path):
    """A small table of many narrow buckets: spread over bins it is larger than the planner takes it for."""
    path = str(tmp_path / "buckets")
    start = F.col("id") / 20_000
    spark.range(20_000).select("id", start.alias("lo"), ((F.col("id") + 1) / 20_000).alias("hi")).write.parquet(path)
    points = spark.range(2000).select(F.col("id").alias("p"), ((F.col("id") + 0.53) / 2000).alias("v"))
    joined = joins.range_bucket_join(points, spark.read.parquet(path), "v")
    assert joined.where("id = floor(v * 20000)").count() == 2000
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_range_picks_stay_light_on_the_driver(spark, tmp_path):
    """Neither the spread buckets nor many copies of the bounds of their bins pass through the driver."""
    part = spark.range(20_000).select(F.col("id").alias("p_partkey"))
    part.write.parquet(str(tmp_path / "part.parquet"))
    orders = spark.range(3000).select(F.col("id").alias("o_orderkey"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    for name in ("range_bucket_join_distributed", "range_bucket_join"):
        picks = QUERIES[name](spark, str(tmp_path))
        plan = picks._jdf.queryExecution().executedPlan().toString()
        # What is broadcast is where each range partition starts, one row for each.
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        assert 1 <= len(re.findall(r"(?:[0-9.E-]+,){1000,}", plan)) <= 3
        assert tuple(picks.agg(F.count("movie_id"), F.count_distinct("o_orderkey")).first()) == (3000, 3000)


FIRST_PICKS = """
import sys
from marquee.session import build_session
from workload.catalog import QUERIES

name, folder = sys.argv[1:]
conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": f"{folder}/kept"}
spark = build_session("first", "local[2]", **conf)
QUERIES[name](spark, folder).write.parquet(f"{folder}/picks")
"""


def test_range_picks_as_the_first_query_of_a_session(spark, tmp_path):
    """Spark numbers the variables of functions as it numbers the first columns of a session."""
    spark.range(300).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(500).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    command = [sys.executable, "-c", FIRST_PICKS, "range_bucket_join_distributed", str(tmp_path)]
    ran = subprocess.run(command, cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]
    picks = spark.read.parquet(str(tmp_path / "picks"))
    assert tuple(picks.agg(F.count("movie_id"), F.count_distinct("o_orderkey")).first()) == (500, 500)


def test_positions_that_are_null_or_beyond_all_buckets_join_nothing(spark):
    points = spark.createDataFrame([(1, None), (2, 0.0), (3, 0.25), (4, 0.5), (5, 0.75), (6, None)], "i int, v double")
    buckets = spark.createDataFrame(
        [("a", 0.0, 0.25), ("b", 0.25, 0.5), ("none", 0.5, 0.5), ("c", None, 0.5), ("d", 0.75, None), ("e", 0.5, 0.75)],
        "b string, lo double, hi double",
    )
    for bins in (1, 2, 4096):
        joined = joins.range_bucket_join(points, buckets, "v", bins=bins)
        assert rows(joined, "i", "b") == [(2, "a"), (3, "b"), (4, "e")]


def test_orphans_are_found_in_one_stored_comparison(spark, monkeypatch):
    stored = []
    kept = type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, *a: stored.append(1) or kept(df, *a))
    df = spark.createDataFrame([(1, "a", 7), (2, "7", 8), (3, None, None)], "id int, fa string, fb bigint")
    parents = {
        "fa": spark.createDataFrame([("a",), (None,)], "fa string"),
        "fb": spark.createDataFrame([(7,), (7,)], "key int"),
    }
    found = {r.id: list(r._missing) for r in joins.tag_orphans(df, parents).collect()}
    assert found == {1: [], 2: ["fa", "fb"], 3: ["fa", "fb"]}
    assert len(stored) == 1
    assert joins.tag_orphans(df, {}).where(F.size("_missing") == 0).count() == 3


@pytest.mark.parametrize("distributed", [True, False])
def test_weight_buckets_cover_everything(spark, distributed):
    weights = spark.createDataFrame([("a", 92), ("b", 5), ("c", 0), ("d", 3)], "k string, w bigint")
    spread = {r.k: (r.lo, r.hi) for r in ranking.weight_buckets(weights, "k", "w", distributed).collect()}
    assert spread == {"a": (0.0, 0.92), "b": (0.92, 0.97), "c": (0.97, 0.97), "d": (0.97, 1.0)}


# --- quality ---------------------------------------------------------------------------------


def test_null_predicate_counts_as_broken(spark):
    df = frame(spark, "bookings", [row("B1"), row("B5", amount=None), row(None, status="pending")])
    rules = quality.RULES["bookings"]
    assert rows(quality.passing(df, rules), "booking_id") == [("B1",)]
    broken = {r.booking_id: list(r._broken) for r in quality.quarantine(df, rules).collect()}
    assert broken == {"B5": ["valid_ticket_amount"], None: ["valid_booking_id", "valid_payment_status"]}
    counts = {r.rule: (r.passed, r.failed) for r in quality.violation_counts(df, "bookings", rules).collect()}
    assert counts == {
        "valid_booking_id": (2, 1), "valid_ticket_amount": (2, 1), "valid_payment_status": (2, 1)
    }


def test_customer_warnings(spark):
    given = [
        customer("C1", "a.s@b.co"), customer("C2", "ass@b.co"), customer("C3", "no-at.example"),
        customer("C4", "a@b"), customer("C5", phone="12345"), customer(None),
    ]
    rules = quality.RULES["customers"]
    kept = quality.passing(frame(spark, "customers", given), rules)
    warned = {r.customer_id: list(r._broken) for r in quality.with_broken_rules(kept, rules).collect()}
    assert warned == {
        "C1": [], "C2": [], "C3": ["valid_email_format"], "C4": ["valid_email_format"], "C5": ["valid_phone_format"]
    }


def test_fail_rule(spark):
    rule = quality.Rule("small", "id < 3", "fail")
    assert quality.enforce(spark.range(3), "numbers", [rule]).count() == 3
    with pytest.raises(quality.ExpectationFailed, match="small"):
        quality.enforce(spark.range(4), "numbers", [rule])


def test_sixteen_rules():
    assert sum(len(r) for r in quality.RULES.values()) == 16


# --- draws and shaping -----------------------------------------------------------------------


def test_thresholds():
    cuts = draws.thresholds([92, 5, 3])
    assert cuts == [0.92, 0.97, 1.0] and cuts == sorted(cuts)
    for bad in ([], [0, 0], [1, -1]):
        with pytest.raises(ValueError):
            draws.thresholds(bad)


def test_weighted_index_is_strict(spark):
    df = spark.createDataFrame([(0.0,), (0.9199,), (0.92,), (0.97,), (0.9999,)], "u double")
    labels = draws.weighted_label(["s", "f", "r"], [92, 5, 3], F.col("u"))
    assert [r[0] for r in df.select(labels).collect()] == ["s", "s", "f", "r", "r"]
    with pytest.raises(ValueError):
        draws.weighted_label(["s"], [1, 2], F.col("u"))


def test_popularity(spark):
    ids = spark.range(1, 601).select(F.format_string("MOV-%05d", "id").alias("m"))
    weights = {r.m: r.w for r in ids.select("m", draws.popularity("m").alias("w")).collect()}
    assert weights["MOV-00001"] == pytest.approx(2.5336890663787177e-06, rel=1e-12)
    assert all(0 <= w <= 1 for w in weights.values())
    assert sum(weights.values()) / len(weights) < 0.3


def test_draws_ignore_partitioning(spark):
    df = spark.range(2000).select("id", draws.uniform(draws.digest("x", "id")).alias("u"))
    again = spark.range(2000).repartition(13).select("id", draws.uniform(draws.digest("x", "id")).alias("u"))
    assert df.exceptAll(again).isEmpty()
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.03
    spread = df.select(draws.normal(draws.digest("n", "id")).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(spread[0]) < 0.1 and abs(spread[1] - 1) < 0.1


def test_fault_injection_shares(spark):
    given = frame(spark, "bookings", [row(f"B{i}") for i in range(3000)])
    bad = shaping.inject_faults(given, 0.3, ["booking_id"], orphan="CUST-0").cache()
    repeated = bad.count() - 3000
    assert 200 < repeated < 400
    for damage in ("booking_id IS NULL", "ticket_amount < 0", "customer_id = 'CUST-0'"):
        assert 240 < bad.where(damage).count() < 420
    # A repeated row equals its original.
    assert bad.where("booking_id IS NOT NULL").distinct().groupBy("booking_id").count().where("count > 1").isEmpty()


def test_incident_stands_out(spark):
    inside = [row(f"I{i}", gateway="CCAvenue") for i in range(100)]
    outside = [row(f"O{i}", "S2", gateway="Paytm", status="failed" if i < 5 else "success") for i in range(100)]
    few = [row(f"F{i}", "S2", gateway="Tiny", status="failed") for i in range(19)]
    given = frame(spark, "bookings", inside + outside + few)
    hit = shaping.payment_incident(given, F.col("payment_gateway") == "CCAvenue", 0.88, ["booking_id"])
    tables = star_of(spark, hit)
    worst = reports.worst_payment_slices(tables).collect()
    assert [r["Payment Gateway"] for r in worst] == ["CCAvenue", "Paytm"]
    assert 0.75 < worst[0]["Payment Failure Rate"] < 1 and worst[1]["Payment Failure Rate"] == 0.05


def test_pseudonyms(spark):
    df = spark.range(3000)
    made = df.select(*[pseudonym(k, "id").alias(k) for k in ("person_name", "theatre_name", "movie_title", "email", "phone")])
    assert made.select("email").distinct().count() == 3000
    assert made.where(~F.col("email").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$") | ~F.col("phone").rlike("^[0-9]{10}$")).isEmpty()
    assert made.exceptAll(df.repartition(5).select(*[pseudonym(k, "id").alias(k) for k in made.columns])).isEmpty()
    with pytest.raises(ValueError):
        pseudonym("shoe_size", "id")


# --- star schema and metric views ------------------------------------------------------------


def star_of(spark, bookings):
    shows = frame(spark, "shows", [show("S1"), show("S2", "M2", "T2"), show("S3", "M2", "T404")])
    theatres = frame(spark, "theatres", [theatre("T1", "Mumbai"), theatre("T2", "Pune", 100)])
    movies = frame(spark, "movies", [movie("M1"), movie("M2"), movie("M3")])
    fact = star.fact_bookings(bookings, shows)
    return {
        "fact_bookings": fact, "dim_theatre": theatres, "dim_movie": movies,
        "fact_show_occupancy": star.show_occupancy(shows, theatres, fact),
    }


def edge_bookings(spark):
    return frame(spark, "bookings", [
        row("B1", gateway="A"), row("B2", gateway="B", status="failed"), row("B3", "S2", gateway="B", status="failed"),
        row("B4", "S3", gateway="A", customer_id="C2"), row("B5", "S2", gateway="A", cancelled=True),
    ])


@pytest.mark.parametrize("preaggregate", [True, False])
def test_metric_edges(spark, preaggregate):
    tables = star_of(spark, edge_bookings(spark))
    by_gateway = {
        r["Payment Gateway"]: r.asDict()
        for r in BOOKING_REVENUE.query(tables, ["Payment Gateway"], preaggregate=preaggregate).collect()
    }
    assert by_gateway["B"]["Average Ticket Price"] is None and by_gateway["B"]["Total Revenue"] is None
    # The same customer in two slices counts in both and once overall.
    assert by_gateway["A"]["Unique Customers"] == 2 and by_gateway["B"]["Unique Customers"] == 1
    assert BOOKING_REVENUE.query(tables, preaggregate=preaggregate).first()["Unique Customers"] == 2
    # A booking whose theatre is unknown stays, without a city.
    by_city = {r["City"]: r["Total Bookings"] for r in PAYMENT_HEALTH.query(tables, ["City"], preaggregate=preaggregate).collect()}
    assert by_city == {"Mumbai": 2, "Pune": 2, None: 1}


def test_both_metric_plans_agree(spark):
    tables = star_of(spark, edge_bookings(spark))
    for view in VIEWS.values():
        names = list(view.dimensions)
        for by in ([], names[:1], names[1:3], names):
            direct = view.query(tables, by, preaggregate=False)
            folded = view.query(tables, by, preaggregate=True)
            assert direct.exceptAll(folded).isEmpty() and folded.exceptAll(direct).isEmpty(), (view.name, by)


def test_unused_joins_are_not_planned(spark, tmp_path):
    tables = star_of(spark, edge_bookings(spark))
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    plan = PAYMENT_HEALTH.query(stored, ["Payment Gateway"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ReadSchema: struct<payment_status:string,payment_gateway:string>" in plan
    filtered = BOOKING_REVENUE.query(stored, ["City"], ["Total Bookings"], {"Payment Gateway": ["A"], "Booking Date": ("2026-07-01", "2026-07-31")})
    plan = spark._jvm.PythonSQLUtils.explainString(filtered._jdf.queryExecution(), "formatted")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(booking_date", plan) and "BroadcastHashJoin" in plan
    assert {r["City"]: r["Total Bookings"] for r in filtered.collect()} == {"Mumbai": 1, "Pune": 1, None: 1}


def test_rollup_totals_agree(spark):
    tables = star_of(spark, edge_bookings(spark))
    levels = reports.payment_health_rollup(tables).groupBy("grouping_id").agg(F.sum("Total Bookings").alias("n"))
    assert {r.grouping_id: r.n for r in levels.collect()} == {7: 5, 3: 5, 5: 5, 6: 5}


def test_filters_skip_views_without_the_dimension(spark):
    tables = star_of(spark, edge_bookings(spark))
    wanted = {"City": ["Pune"], "Payment Gateway": ["A"]}
    assert reports.kpi_counters(tables, wanted).first()["Total Bookings"] == 1
    assert [r["City"] for r in reports.occupancy_by(tables, "City", wanted).collect()] == ["Pune"]


def test_invariants(spark):
    tables = star_of(spark, edge_bookings(spark))
    daily = star.daily_revenue_summary(tables["fact_bookings"], tables["dim_theatre"])
    assert daily.where("successful_bookings + failed_bookings + refunded_bookings <> total_bookings").isEmpty()
    assert daily.where("payment_failure_rate NOT BETWEEN 0 AND 1").isEmpty()
    status = reports.failure_rate_status(tables, ("Payment Gateway",), amber=0.3, red=0.9)
    assert rows(status, "Payment Gateway", "Status") == [("A", "green"), ("B", "red")]


# --- files -----------------------------------------------------------------------------------


def test_fixture_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "name": "x"}, {"id": 2, "name": "y"}]))
    (tmp_path / "b.csv").write_text("id,name\n1,x\n2,y\n")
    assert rows(landing.read_fixture(spark, str(tmp_path / "a.json")), "id", "name") == [(1, "x"), (2, "y")]
    assert rows(landing.read_fixture(spark, str(tmp_path / "b.csv")), "id", "name") == [("1", "x"), ("2", "y")]
    with pytest.raises(ValueError):
        landing.read_fixture(spark, "c.xml")


def test_clustered_files_hold_ranges(spark, tmp_path):
    from marquee.streaming.lake import write_clustered

    path = str(tmp_path / "clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(spark.range(10000).select((10000 - F.col("id")).alias("k")), path, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = sorted(
        (r.lo, r.hi)
        for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    )
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
