"""Ranks by selection, distinct partials that merge, and reports answered from stored aggregates."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import selection
from marquee.operators.selection import Key
from marquee.plans import reports, rollups
from marquee.plans.metrics import BOOKING_REVENUE, PAYMENT_HEALTH
from workload.roles import Roles

FOLDER = "/root/testdata/sf0.001"
ORDER = [Key("v", descending=True), Key("id")]


@pytest.mark.parametrize("rows, values", [(0, 1), (1, 1), (2, 1), (3, 3), (5, 50), (50, 1), (300, 3), (300, 100)])
def test_cut_rows_equal_a_sort(spark, monkeypatch, rows, values):
    """Also with ranges so small that several passes are needed, and with one value for all rows."""
    monkeypatch.setattr(selection, "SMALL_RANGE", 10)
    monkeypatch.setattr(selection, "SAMPLE_ROWS", 20)
    draw = random.Random(rows)
    data = [(draw.randrange(values), f"o'{i}\\") for i in range(rows)]
    df = spark.createDataFrame(data, "v int, id string")
    cuts = selection.ntile_cuts(df, 4, ORDER)
    got = {r["id"]: r["t"] for r in df.selectExpr("id", f"{selection.tile_sql(ORDER, cuts, 4)} AS t").collect()}
    best = sorted(data, key=lambda r: (-r[0], r[1]))
    sizes = [rows // 4 + (t < rows % 4) for t in range(4)]
    tiles = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    assert got == {row[1]: tile for row, tile in zip(best, tiles, strict=True)}
    cut = selection.percent_rank_cuts(df, "v", [0.4, 0.8])
    shown = df.selectExpr("id", *[f"{selection.reaches_sql('v', c)} AS c{i}" for i, c in enumerate(cut)]).collect()

    def rank(v):
        return sum(x < v for x, _ in data) / (rows - 1) if rows > 1 else 0.0

    assert {r["id"]: (r["c0"], r["c1"]) for r in shown} == {i: (rank(v) >= 0.4, rank(v) >= 0.8) for v, i in data}


def test_selection_neither_sorts_nor_shuffles_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("v"), "id")
    cuts = selection.ntile_cuts(df, 4, ORDER)
    plan = df.selectExpr("*", f"{selection.tile_sql(ORDER, cuts, 4)} AS t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    with pytest.raises(IndexError):
        selection.rows_at(df, ORDER, [1000])


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, FOLDER)


def sources(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reports_are_answered_from_the_rollup(spark, roles, tmp_path):
    by = ("Booking Date", "City", "Payment Gateway")
    health = rollups.make_rollup(PAYMENT_HEALTH, roles.tables, by, str(tmp_path / "health"))
    revenue = rollups.make_rollup(BOOKING_REVENUE, roles.tables, by[:2], str(tmp_path / "revenue"))
    stored = rollups.Stored(roles.tables, (health, revenue))
    asked = [
        reports.failure_rate_by_date_gateway, reports.city_gateway_heatmap, reports.kpi_counters, reports.weekly_revenue_trend,
        lambda t: reports.worst_payment_slices(t, least_bookings=2), lambda t: reports.revenue_by(t, "City"),
        lambda t: PAYMENT_HEALTH.query(t, ["City"], filters={"Payment Gateway": ["1-URGENT"], "City": "NATION_1"}),
        lambda t: BOOKING_REVENUE.query(t, ["City"], ["Unique Customers"], {"Booking Date": ("1996-01-01", "1997-12-31")}),
    ]
    for report in asked:
        ours, theirs = report(stored), report(roles.tables)
        assert "l_orderkey" in sources(theirs) and "l_orderkey" not in sources(ours)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
        assert ours.columns == theirs.columns
    # What no rollup covers is still answered from the fact.
    for dims in (["Genre"], ["Booking Channel"]):
        assert "l_orderkey" in sources(BOOKING_REVENUE.query(stored, dims))


def test_the_smallest_rollup_that_covers_is_taken(spark, roles, tmp_path):
    fine = rollups.make_rollup(PAYMENT_HEALTH, roles.tables, ("Booking Date", "City"), str(tmp_path / "fine"))
    coarse = rollups.make_rollup(PAYMENT_HEALTH, roles.tables, ("City",), str(tmp_path / "coarse"))
    assert coarse.rows < fine.rows
    stored = rollups.Stored(roles.tables, (fine, coarse))
    assert all("/coarse/" in f for f in PAYMENT_HEALTH.query(stored, ["City"]).inputFiles())
    assert all("/fine/" in f for f in PAYMENT_HEALTH.query(stored, ["Booking Date"]).inputFiles())


def test_the_daily_summary_answers_payment_reports(spark, roles):
    from marquee.plans import star

    summary = star.daily_revenue_summary(roles.fact, roles.theatres).checkpoint()
    stored = rollups.Stored(roles.tables, (rollups.daily_rollup(summary, PAYMENT_HEALTH),))
    ours, theirs = (reports.city_gateway_heatmap(t) for t in (stored, roles.tables))
    assert "l_orderkey" not in sources(ours)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert "l_orderkey" in sources(reports.revenue_by(stored, "City"))


def test_a_filter_on_any_clustered_column_skips_most_files(spark, tmp_path):
    import pyarrow.parquet as pq
    from pathlib import Path

    from marquee.operators import clustering

    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(365)).alias("day"), F.concat(F.lit("T"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300))).alias("place"), "id"
    )
    clustering.write_interleaved(df, str(tmp_path / "z"), ["day", "place"], 64)
    files = [pq.ParquetFile(f).metadata.row_group(0) for f in Path(tmp_path, "z").glob("*.parquet")]
    stats = [[g.column(i).statistics for i in (0, 1)] for g in files]
    assert len(files) > 40 and spark.read.parquet(str(tmp_path / "z")).count() == 40_000
    for column, value in ((0, 180), (1, "T150")):
        opened = sum(s[column].min <= value <= s[column].max for s in stats)
        # 8 of 64 with files cut along the ranges, about twice that as their bounds are sampled.
        assert opened <= len(files) / 3, (column, opened)
    numbers = clustering.range_number("v", [2, 5])
    got = spark.createDataFrame([(None,), (1,), (2,), (4,), (9,)], "v int").select("v", numbers.alias("n")).collect()
    assert [r["n"] for r in got] == [0, 0, 1, 1, 2]
    assert clustering.range_bounds(df.limit(0), "day") == []


def test_views_describe_themselves(spark, roles):
    from marquee.plans.metrics import THEATRE_OCCUPANCY, VIEWS

    for view in (*VIEWS.values(), THEATRE_OCCUPANCY):
        lines = view.described()
        assert len(lines) == 1 + len(view.dimensions) + len(view.measures) and all(c for *_, c in lines)
    shown = PAYMENT_HEALTH.with_comments(PAYMENT_HEALTH.query(roles.tables, ["City"]))
    assert [f.metadata["comment"] for f in shown.schema.fields][:2] == ["City of the theatre", "All bookings"]


def test_the_grid_finds_its_gateways(spark, roles):
    every = reports.city_gateway_grid(roles.tables)
    assert set(every.columns) == {"City", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"}
