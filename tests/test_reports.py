"""Reports on small tables, and what must add up on large ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.operators import keys
from parcelyard.plans import catalogue, profiles, reports

SF = "/root/testdata/sf0.001"

# Rows per step at sf0.001, agreed on by two separate scripts before this code existed.
EXPECTED = {
    "orders": [1545, 1514, 1497, 1483, 1479, 1460, 1433],
    "shipments": [6000, 6000, 6000, 4599, 4562, 4541, 4514, 4299],
}


def rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture(scope="module")
def tables(spark):
    day = dt.date(2026, 3, 5)
    sites = [(1, "Alpha DC", "East", "A", "AA"), (2, "Empty DC", "East", "B", "BB")]
    sites += [(3, "Twin DC", "West", "C", "CC"), (4, "Twin DC", "Void", "D", "DD")]
    orders = [
        (10, 1, dt.date(2026, 2, 27), 1, 5, "toys"),
        (11, 1, dt.date(2026, 3, 1), 1, 2, "toys"),
        (12, 3, dt.date(2026, 3, 2), 1, 3, "toys"),
    ]
    # Order 10 is split in three, 11 never shipped, 12 still moving.
    shipped = [
        (20, 10, "UPS", day, day, day, None, 0, 1, 1),
        (21, 10, "UPS", day, day, dt.date(2026, 3, 8), "customs", 3, 0, 1),
        (22, 10, "Unknown", day, day, dt.date(2026, 3, 6), "unknown", 1, 0, 1),
        (23, 12, "DHL", day, day, None, None, None, None, 3),
    ]
    return {
        "warehouses": spark.createDataFrame(sites, C.WAREHOUSES.schema),
        "orders": spark.createDataFrame(orders, C.ORDERS.schema),
        "shipments": spark.createDataFrame(
            shipped, C.SHIPMENTS.schema.add("warehouse_id", "long")
        ),
    }


def test_sites_without_orders_stay(tables):
    assert rows(reports.on_time_by_warehouse(tables)) == [
        ("Alpha DC", "East", 3, 3, 0, 33.3),
        ("Empty DC", "East", 0, 0, 0, None),
        ("Twin DC", "West", 1, 0, 1, None),
        ("Twin DC", "Void", 0, 0, 0, None),
    ]
    assert rows(reports.days_late_by_region(tables)) == [
        ("East", 3, 2, 66.7, 1.33, 2.0, 3),
        ("Void", 0, 0, None, None, None, None),
        ("West", 0, 0, None, None, None, None),
    ]
    clean = ("no delays recorded", 0, 0, 0, None)
    assert rows(reports.top_delay_reason_by_warehouse(tables)) == [
        ("Alpha DC", "customs", 1, 2, 1, 50.0),
        ("Empty DC", *clean),
        ("Twin DC", *clean),
        ("Twin DC", *clean),
    ]


def test_unknown_carrier_is_last_and_moving_ones_are_left_out(tables):
    assert rows(reports.carrier_ranking(tables)) == [
        ("UPS", 2, 50.0, 1, 1.5, 3.0, 3),
        ("Unknown", 1, 0.0, 1, 1.0, 1.0, 1),
    ]


def test_split_and_unshipped_orders(tables):
    assert rows(reports.monthly_trend(tables)) == [
        ("2026-02", 3, 15, 3, 0, 33.3),
        ("2026-03", 2, 5, 0, 2, None),
    ]
    assert rows(reports.monthly_trend_by_order(tables)) == [
        ("2026-02", 1, 5, 3, 0, 33.3),
        ("2026-03", 2, 5, 0, 2, None),
    ]
    assert rows(profiles.trailing_month(tables)) == [("2026-03", 2, None, True)]


def test_reasons(tables):
    assert rows(reports.delay_reason_frequency(tables)) == [
        ("customs", 1, 50.0, 3.0, 3),
        ("unknown", 1, 50.0, 1.0, 1),
    ]
    assert rows(profiles.delay_reason_by_warehouse(tables)) == [
        (1, "customs", 1, 1, 2),
        (1, "unknown", 1, 2, 2),
    ]
    assert rows(profiles.delay_reason_chart(tables)) == [
        ("customs", 1, 50.0, False, 2, 1),
        ("unknown", 1, 50.0, True, 2, 1),
    ]


def test_too_few_deliveries_make_no_pair(tables):
    assert rows(reports.worst_warehouse_carrier_pairs(tables)) == []


def test_network(tables):
    assert rows(profiles.warehouse_vs_network(tables)) == [("Alpha DC", 33.3, 3, 33.3, False)]


def test_referential_actions(tables):
    sites, orders, shipments = tables["warehouses"], tables["orders"], tables["shipments"]
    with pytest.raises(keys.RestrictedDelete, match=r"warehouse_id=1 \(2\)"):
        keys.restrict_delete(sites, "warehouse_id", sites.where("warehouse_id < 3"), orders)
    left = keys.restrict_delete(sites, "warehouse_id", sites.where("warehouse_id = 2"), orders)
    assert sorted(r.warehouse_id for r in left.collect()) == [1, 3, 4]
    parents, children = keys.cascade_delete(
        orders, "order_id", orders.where("order_id = 10"), shipments
    )
    assert sorted(r.order_id for r in parents.collect()) == [11, 12]
    assert [r.shipment_id for r in children.collect()] == [23]
    renames = orders.where("order_id = 10").select("order_id", F.lit(99).alias("new_key"))
    moved = keys.renamed_keys(shipments, "order_id", renames)
    assert sorted(r.order_id for r in moved.collect()) == [12, 99, 99, 99]
    assert moved.columns == shipments.columns


def test_reports_survive_renamed_keys(tables):
    """A new key reaches the copies that shipments carry, so no report changes."""
    names = ("on_time_by_warehouse", "days_late_by_region", "top_delay_reason_by_warehouse",
             "worst_warehouse_carrier_pairs")
    sites = tables["warehouses"].select("warehouse_id", (F.col("warehouse_id") + 50).alias("new_key"))
    orders = tables["orders"].select("order_id", (-F.col("order_id")).alias("new_key"))
    moved = keys.cascade_update(tables, C.WAREHOUSES, sites)
    moved = keys.cascade_update(moved, C.ORDERS, orders)
    assert min(r.warehouse_id for r in moved["shipments"].collect()) > 50
    for name in names:
        assert rows(reports.REPORTS[name].build(moved)) == rows(reports.REPORTS[name].build(tables))


def test_counts_per_step(spark):
    steps = catalogue.named("stage_counts")(spark, SF)
    for table, expected in EXPECTED.items():
        lines = steps.where(F.col("source_table") == table).orderBy("step").collect()
        assert [lines[0].rows_before] + [r.rows_after for r in lines] == expected
        assert all(a.rows_after == b.rows_before for a, b in zip(lines, lines[1:]))


def test_what_must_add_up(spark):
    run = catalogue.refresh_of(spark, SF)
    loaded = run.tables()
    delivered = loaded["shipments"].where("days_late is not null").count()
    assert reports.carrier_ranking(loaded).agg(F.sum("delivered")).first()[0] == delivered == 4121
    shares = reports.delay_reason_frequency(loaded).agg(F.sum("share_pct")).first()[0]
    assert abs(shares - 100) < 0.5
    for name, table in C.TABLES.items():
        distinct, judged = run.distinct(name), run.judged(name)
        assert distinct.count() == judged.count()
        assert distinct.agg(F.sum("copies")).first()[0] == run.raw[name].frame.count()
        reasonless = judged.where("(outcome = 'rejected') <> (reason is not null)")
        assert reasonless.count() == 0
        key = loaded[name].select(table.key)
        assert key.count() == key.distinct().count()


def test_partitions_do_not_matter(spark):
    def result():
        catalogue._runs.clear()
        run = catalogue.refresh_of(spark, SF)
        return [sorted(map(str, t.collect())) for t in (*run.tables().values(), run.rejects())]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    whole = result()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert result() == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
