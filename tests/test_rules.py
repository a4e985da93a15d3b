"""Refusal rules on hand-made rows."""

from frames import ORDER, SHIPMENT, SITE, ids, reasons, refreshed

from parcelyard import contract as C


def order(key, site="7", day="2024-11-19", customer="82", quantity="3", category="paint"):
    return (key, site, day, customer, quantity, category)


def test_numbers(spark, tmp_path):
    """Whole numbers in any spelling load; what is none is refused, or filled if optional."""
    run = refreshed(
        spark,
        tmp_path,
        warehouses=[SITE, ("VII", "Hill", "r", "c", "s"), ("8.25", "Vale", "r", "c", "s")],
        orders=[
            order("0301", quantity="12.0"),
            order(" 302 ", customer="C-82", quantity="2e2"),
            order("303", site="7.0", customer="", category=" "),
            order("304", quantity="a dozen"),
            order("305", site="seven", quantity=""),
            order("306", quantity="0.5"),
            order("", site="7"),
            order("99999999999999999999", quantity="8"),
        ],
        shipments=[SHIPMENT, ("9001", "order 300", *SHIPMENT[2:])],
    )
    kept = {r.order_id: r for r in run.loaded("orders").collect()}
    assert {k: (r.quantity, r.customer_id) for k, r in kept.items()} == {
        301: (12, 82),
        302: (200, 0),
        303: (3, 0),
    }
    assert (kept[303].warehouse_id, kept[303].product_category) == (7, "unknown")
    refused = run.rejects().collect()
    assert {r.reason for r in refused} == {C.BAD_NUMBER, C.ORPHAN_SHIPMENT}
    numbers = [(r.source_table, r.detail, r.unparsed or "") for r in refused if r.reason == C.BAD_NUMBER]
    assert sorted(numbers) == [
        ("orders", "not numeric: order_id", ""),
        ("orders", "not numeric: order_id", "order_id=99999999999999999999"),
        ("orders", "not numeric: quantity", "quantity=0.5"),
        ("orders", "not numeric: quantity", "quantity=a dozen"),
        ("orders", "not numeric: warehouse_id, quantity", "warehouse_id=seven"),
        ("shipments", "not numeric: order_id", "order_id=order 300"),
        ("warehouses", "not numeric: warehouse_id", "warehouse_id=8.25"),
        ("warehouses", "not numeric: warehouse_id", "warehouse_id=VII"),
    ]


def test_first_row_of_a_key_wins(spark, tmp_path):
    run = refreshed(
        spark,
        tmp_path,
        warehouses=[SITE, (*SITE[:3], "Delft", "ZH"), SITE],
        orders=[
            order("310", quantity="1"),
            order("310", quantity="2"),
            order("310", quantity="3"),
            order("0310", day="11/19/2024", quantity="1.0", category=" PAINT "),  # the first, again
            order("311", day="soon"),  # refused for its day, yet the first to claim 311
            order("311"),
            order("312", quantity="many"),  # no number, so no claim on 312
            order("312", quantity="4"),
            order("313", customer=None),  # equal to the next once blanks are nulls
            order("313", customer=""),
        ],
        shipments=[("9001", "310", *SHIPMENT[2:]), ("9002", "311", *SHIPMENT[2:])],
    )
    kept = {r.order_id: r.quantity for r in run.loaded("orders").collect()}
    assert kept == {310: 1, 312: 4, 313: 3}
    counts = {}
    for row in run.rejects().collect():
        counts[row.source_table, row.reason] = counts.get((row.source_table, row.reason), 0) + 1
    assert counts == {
        ("warehouses", C.KEY_CONFLICT): 1,
        ("orders", C.KEY_CONFLICT): 3,
        ("orders", C.MISSING_DATE): 1,
        ("orders", C.BAD_NUMBER): 1,
        ("shipments", C.ORPHAN_SHIPMENT): 1,
    }
    details = {r.detail for r in run.rejects().where("reason like 'duplicate%'").collect()}
    assert details == {
        f"{key} already seen with different values"
        for key in ("warehouse_id=7", "order_id=310", "order_id=311")
    }
    assert [r.city for r in run.loaded("warehouses").collect()] == ["Utrecht"]


def test_ranges_dates_and_orphans(spark, tmp_path):
    def shipment(key, ship, expected, actual, parent="300"):
        return (key, parent, "DHL", ship, expected, actual, "")

    run = refreshed(
        spark,
        tmp_path,
        orders=[
            ORDER,
            order("321", quantity="0"),
            order("322", quantity="-40"),
            order("323", site="8"),
            order("324", site="8", day="", quantity="0"),
            order("325", day="9999-12-31"),
            order("326", day="02/28/1500"),
        ],
        shipments=[
            SHIPMENT,
            shipment("9001", "2024-12-09", "2024-12-01", ""),
            shipment("9002", "2024-12-09", "2024-12-11", "12/08/2024"),
            shipment("9003", "2024-12-09", "2024-12-01", "2024-12-08"),  # both; the first rule
            shipment("9004", "", "2024-02-30", "2024-12-08"),
            shipment("9005", "2024-12-09", "2024-12-11", "2024-12-20", parent="321"),
            shipment("9006", "2024-12-09", "2024-12-11", "", parent="4"),
            shipment("9007", "2024-12-09", "2024-12-09", "31-Nov-2024"),  # unreadable
            shipment("9008", "2024-12-09", "2024-12-11", "9999-12-31"),
        ],
    )
    assert reasons(run.rejects()) == {
        ("orders", 321): (C.QUANTITY_NOT_POSITIVE, "quantity=0"),
        ("orders", 322): (C.QUANTITY_NOT_POSITIVE, "quantity=-40"),
        ("orders", 323): (C.ORPHAN_ORDER, "warehouse_id=8"),
        ("orders", 324): (C.MISSING_DATE, "NaT: order_date"),
        ("shipments", 9001): (C.EXPECTED_BEFORE_SHIP, "expected 2024-12-01 < ship 2024-12-09"),
        ("shipments", 9002): (C.ACTUAL_BEFORE_SHIP, "actual 2024-12-08 < ship 2024-12-09"),
        ("shipments", 9003): (C.ACTUAL_BEFORE_SHIP, "actual 2024-12-08 < ship 2024-12-09"),
        ("shipments", 9004): (C.MISSING_DATE, "NaT: ship_date, expected_delivery_date"),
        ("shipments", 9005): (C.ORPHAN_SHIPMENT, "order_id=321"),
        ("shipments", 9006): (C.ORPHAN_SHIPMENT, "order_id=4"),
    }
    assert ids(run.loaded("orders"), "order_id") == [300, 325, 326]
    kept = {r.shipment_id: r for r in run.loaded("shipments").collect()}
    assert sorted(kept) == [9000, 9007, 9008]
    assert kept[9007].actual_delivery_date is None and kept[9007].on_time is None
    assert kept[9008].on_time == 0 and kept[9008].actual_delivery_date.year == 9999
    # Derived before the order was looked for, so an orphan has them and the others do not.
    derived = {r.shipment_id: (r.days_late, r.delay_reason) for r in run.rejects().collect()}
    assert derived[9005] == (9, "unknown") and derived[9002] == (None, None)


def test_derived_columns(spark, tmp_path):
    def shipment(key, actual, reason):
        return (key, "300", "DHL", "2024-11-20", "2024-11-24", actual, reason)

    run = refreshed(
        spark,
        tmp_path,
        shipments=[
            shipment("1", "2024-11-22", ""),
            shipment("2", "2024-11-24", None),
            shipment("3", "2024-12-01", " Weather "),
            shipment("4", "2024-11-25", "  "),
            shipment("5", "", ""),
            shipment("6", "2024-11-24", "customs"),
        ],
    )
    rows = run.loaded("shipments").collect()
    assert {r.shipment_id: (r.days_late, r.on_time, r.delay_reason, r.warehouse_id) for r in rows} == {
        1: (-2, 1, None, 7),
        2: (0, 1, None, 7),
        3: (7, 0, "weather", 7),
        4: (1, 0, "unknown", 7),
        5: (None, None, None, 7),
        6: (0, 1, "customs", 7),
    }


def test_every_row_is_loaded_refused_or_a_copy(spark, tmp_path):
    given = [ORDER, ORDER, order("330"), order("330", quantity="5"), order("331", day="?"),
             order("331", day="?"), order("332", quantity="-1"), order("333", site="70")]
    run = refreshed(spark, tmp_path, orders=given, shipments=[])
    judged = run.judged("orders").select("outcome", "copies").collect()
    assert sum(r.copies for r in judged) == len(given)
    assert sorted(r.outcome for r in judged) == ["loaded"] * 2 + ["rejected"] * 4
    assert run.rejects().count() == 4 and run.loaded("shipments").count() == 0


def test_unknown_rules_are_errors():
    for bad in (dict(kind=C.TEXT, case="camel"), dict(kind="money")):
        try:
            C.Field("x", **bad)
        except ValueError as error:
            assert "unknown" in str(error)
        else:
            raise AssertionError(bad)


def test_ties_go_by_value(spark, tmp_path):
    """Rows that share an ordinal: the one with the smaller values keeps the key."""
    from frames import raw_frame
    from pyspark.sql import functions as F

    from parcelyard.plans.refresh import Refresh
    from parcelyard.sources.raw import from_frame

    orders = raw_frame(
        spark,
        "orders",
        [order("340", customer=str(c)) for c in (9, 5, 7)]
        + [order("341", day=d) for d in ("2024-11-19", "")],
    ).withColumn("place", F.lit(1))
    run = refreshed(spark, tmp_path)
    given = {**run.raw, "orders": from_frame(orders, ["place"])}
    run = Refresh(spark, given, str(tmp_path))
    assert [(r.order_id, r.customer_id) for r in run.loaded("orders").collect()] == [(340, 5)]
    assert sorted(r.reason for r in run.rejects().where("order_id = 341").collect()) == [
        C.KEY_CONFLICT,  # null sorts first, so the dateless row holds the key
        C.MISSING_DATE,
    ]


def test_a_delete_of_free_sites_folds_the_orders_first(spark, tmp_path):
    from parcelyard.plans import catalogue

    other = ("8", "Hill", "Lowlands", "Utrecht", "UT")
    run = refreshed(spark, tmp_path, warehouses=[SITE, other])
    left = catalogue.restrict_delete_applied(run)
    assert sorted(left.collect()) == [("all", 1, 7), ("all", 1, 8), ("without orders", 0, 7)]
    assert "HashAggregate" in left._jdf.queryExecution().optimizedPlan().toString() + (
        left._jdf.queryExecution().executedPlan().toString()
    )
