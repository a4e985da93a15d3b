"""Counts taken while rows are written: equal to a scan's, and no scan of their own."""

import pytest
from frames import ORDER, SHIPMENT, SITE, raw, refreshed
from pyspark.sql import functions as F

from parcelyard.contract import TABLES
from parcelyard.operators import clean
from parcelyard.plans import profiles, tallies
from parcelyard.plans.refresh import Snapshot, publish

ORDERS = [
    ORDER,
    ORDER,
    ("301", "7", "11/19/2024", "", "6", ""),
    ("302", "7", "2024/11/20", "x", "0", "toys"),
    ("302", "7", "2024/11/20", "y", "0", "toys"),
    ("303", "7", "2024-02-31", "81", "6", "toys"),
    ("304", "7", "", "81", "6", "toys"),
]
SHIPMENTS = [
    SHIPMENT,
    ("9001", "300", " u.p.s ", "20-Nov-2024", "2024-11-24", "2024-11-29", ""),
    ("9002", "999", "", "2024-11-20", "2024-11-24", None, None),
]


def scanned(run, name):
    counts = {n: c.alias(n) for n, c in tallies.of_readings(TABLES[name]).items()}
    return clean.readings(TABLES[name], run.raw[name]).agg(*counts.values()).first().asDict()


def lines(frame):
    return {tuple(row)[0]: tuple(row)[1:] for row in frame.collect()}


@pytest.fixture
def run(spark, tmp_path):
    return refreshed(spark, tmp_path / "run", orders=ORDERS, shipments=SHIPMENTS)


def test_like_a_scan(run):
    for name in TABLES:
        counts = run.counts(name)
        for measure, rows in scanned(run, name).items():
            assert counts[measure] == rows, measure
        assert counts[tallies.DISTINCT] == run.distinct(name).count() == run.judged(name).count()
        for reason in tallies.reasons(TABLES[name]):
            refused = run.judged(name).where(F.col("reason") == reason).count()
            assert counts[tallies.refused_count(reason)] == refused


def test_by_hand(spark, run):
    counts = {name: run.counts(name) for name in TABLES}
    mess = lines(profiles.mess_profile(spark, counts))
    # One copy of order 300; the two rows of 302 differ in unread text alone.
    assert mess["order_rows_folded"] == (2,)
    assert mess["orders_not_iso"] == (3,) and mess["category_blank"] == (1,)
    assert mess["late_without_reason"] == (1,) and mess["carrier_blank"] == (1,)
    styles = {r.date_column: r for r in profiles.date_format_profile(spark, counts).collect()}
    day = styles["order_date"]
    assert (day.iso, day.us_slash, day.iso_slash, day.abbrev_month) == (2, 1, 2, 0)
    assert (day.blank, day.unparseable) == (1, 1)


def test_a_repeated_task_is_seen(run, monkeypatch):
    """A task that ran twice adds its rows twice; the total gives it away."""
    run.distinct("orders")
    tally = run._tallies["orders read"]
    doubled = {name: 2 * rows for name, rows in tally.read().items()}
    monkeypatch.setattr(tally, "read", lambda: doubled)
    assert run.counts_read("orders").items() >= scanned(run, "orders").items()


def test_nothing_is_read_for_them(spark, run, monkeypatch):
    run.judged("shipments")
    monkeypatch.setattr(run, "raw", {})  # a scan of the source would fail
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counts", "")
    try:
        for name in TABLES:
            run.counts(name)
        assert not jobs.getJobIdsForGroup("counts")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_empty_tables(spark, tmp_path):
    run = refreshed(spark, tmp_path / "run", warehouses=(), orders=(), shipments=())
    for name in TABLES:
        assert set(run.counts(name).values()) == {0}


def test_every_parent_is_missing(spark, tmp_path):
    run = refreshed(spark, tmp_path / "run", warehouses=())
    assert run.counts("orders")[tallies.refused_count("warehouse_id not found in warehouses")] == 1
    assert run.counts("shipments")[tallies.refused_count("order_id not found in orders")] == 1


def test_counts_go_live_with_the_version(spark, tmp_path, run):
    root = str(tmp_path / "store")
    publish(spark, raw(spark, (SITE,), ORDERS, SHIPMENTS), root)
    assert Snapshot(spark, root).counts() == {name: run.counts(name) for name in TABLES}
