"""The CSV source: text types, missing values, row order, headers."""

import random
import re

import pytest
from frames import ids

from parcelyard import __main__ as command
from parcelyard import contract as C
from parcelyard.plans.refresh import Refresh
from parcelyard.sources import records
from parcelyard.sources.raw import read_csv, read_csv_tables

WAREHOUSES = "warehouse_id,name,region,city,state\n1,Quay 4,NORTH SEA,Emden,ni\n"
HEADER = "order_id,warehouse_id,order_date,customer_id,quantity,product_category\n"
ORDERS = [
    '10,1,2025-05-11,640,2,"tiles, ""big"""\n',
    "10,1,2025-05-11,641,2,tiles\n",
    "11,1,05/12/2025,NA,0007,  Tiles \n",
    "11,1,2025-05-12,,7,tiles\n",
    "12,1,null,1,1,tiles\n",
]
SHIPMENTS = (
    "shipment_id,order_id,carrier,ship_date,expected_delivery_date,actual_delivery_date,delay_reason\n"
    "20,10, FEDEX,2025-05-12,2025-05-15,2025-05-16,\n"
    "21,11,N/A,2025/05/12,15-May-2025,,None\n"
)


def folder(path, orders):
    path.mkdir()
    (path / "warehouses.csv").write_text(WAREHOUSES)
    (path / "shipments.csv").write_text(SHIPMENTS)
    if isinstance(orders, str):
        (path / "orders.csv").write_text(orders)
    else:
        (path / "orders.csv").mkdir()
        for name, text in orders.items():
            (path / "orders.csv" / name).write_text(text)
    return str(path)


def outcome(spark, raw, work):
    run = Refresh(spark, read_csv_tables(spark, raw), str(work))
    return {n: sorted(map(str, t.collect())) for n, t in run.tables().items()} | {
        "rejects": sorted(map(str, run.rejects().collect()))
    }


def test_one_file_and_many_give_the_same(spark, tmp_path):
    whole = folder(tmp_path / "one", HEADER + "".join(ORDERS))
    # The first file is the smaller one, which Spark reads last.
    parts = folder(
        tmp_path / "many", {"f0.csv": HEADER + ORDERS[0], "f1.csv": HEADER + "".join(ORDERS[1:])}
    )
    one = outcome(spark, whole, tmp_path / "w1")
    assert outcome(spark, parts, tmp_path / "w2") == one
    run = Refresh(spark, read_csv_tables(spark, whole), str(tmp_path / "w3"))
    orders = {r.order_id: r for r in run.loaded("orders").collect()}
    assert orders[10].customer_id == 640 and orders[10].product_category == 'tiles, "big"'
    assert orders[11].customer_id == 0 and orders[11].quantity == 7
    assert sorted(r.reason for r in run.rejects().collect()) == [C.KEY_CONFLICT, C.MISSING_DATE]
    shipments = {r.shipment_id: r for r in run.loaded("shipments").collect()}
    assert shipments[20].carrier == "FedEx" and shipments[20].delay_reason == "unknown"
    assert shipments[21].carrier == "Unknown" and shipments[21].on_time is None


def test_text_and_missing_values(spark, tmp_path):
    raw = folder(tmp_path / "raw", HEADER + "".join(ORDERS))
    table = read_csv(spark, f"{raw}/orders.csv", C.ORDERS)
    assert {t for c, t in table.frame.dtypes if c in C.ORDERS.source_columns} == {"string"}
    third = table.frame.collect()[2]
    assert (third.customer_id, third.quantity, third.product_category) == (None, "0007", "  Tiles ")
    kept = read_csv(spark, f"{raw}/orders.csv", C.ORDERS, na_tokens=()).frame.collect()
    assert kept[2].customer_id == "NA" and kept[4].order_date == "null"


def test_columns_go_by_name(spark, tmp_path):
    swapped = "quantity,order_id,warehouse_id,order_date,customer_id,product_category\n"
    raw = folder(tmp_path / "raw", swapped + "2,10,1,2025-05-11,640,tiles\n")
    row = read_csv(spark, f"{raw}/orders.csv", C.ORDERS).frame.first()
    assert (row.order_id, row.quantity) == ("10", "2")
    (tmp_path / "raw" / "orders.csv").write_text("order_id,colour\n1,red\n")
    with pytest.raises(ValueError, match="missing columns .*unexpected columns \\['colour'\\]"):
        read_csv(spark, f"{raw}/orders.csv", C.ORDERS)


def test_commands(spark, tmp_path, capsys, monkeypatch):
    raw = folder(tmp_path / "raw", HEADER + "".join(ORDERS))
    store, rejects = str(tmp_path / "store"), str(tmp_path / "rejects")
    assert command.main(["refresh", raw, store, "--rejects-csv", rejects]) == 0
    written = spark.read.option("header", True).csv(rejects)
    assert ids(written, "reason") == [C.KEY_CONFLICT, C.MISSING_DATE]
    assert command.main(["report", store, "carrier", "--list"]) == 0
    assert "carrier_ranking" in capsys.readouterr().out
    assert command.main(["report", store, "carrier"]) == 0
    out = capsys.readouterr().out
    assert "Carriers ranked" in out and "FedEx" in out and "Delay reasons" not in out
    assert command.main(["report", store, "zebra"]) == 1
    monkeypatch.setattr(C, "fingerprint", lambda path=None: "other")
    assert command.main(["refresh", raw, store]) == 2
    assert "left as it is" in capsys.readouterr().err


def test_lines_that_are_no_rows_are_refused_with_their_text(spark, tmp_path):
    bad = [
        "13,1,2025-05-11,5,2,tiles,EXTRA,FIELDS\n",
        "14,1,2025-05-11,5\n",
        '15,1,2025-05-11,5,2,"ti\nles"\n',
        '16,1,2025-05-11,5,2,"tiles\n',
    ]
    raw = folder(tmp_path / "raw", HEADER + ORDERS[0] + "".join(bad) + "\n" + "17,1,2025-05-11,5,2,\n")
    run = Refresh(spark, read_csv_tables(spark, raw), str(tmp_path / "work"))
    assert ids(run.loaded("orders"), "order_id") == [10, 15, 17]
    assert run.loaded("orders").where("order_id = 15").first().product_category == "ti les"
    lines = "".join(bad[:2] + bad[3:]).splitlines()
    refused = run.rejects().where("source_table = 'orders'").collect()
    assert sorted(r.unparsed for r in refused) == sorted(lines)
    assert {r.reason for r in refused} == {C.MALFORMED_LINE}

    whole = read_csv(spark, f"{raw}/orders.csv", C.ORDERS, multi_line=True)
    assert "ti\nles" in {r.product_category for r in whole.frame.collect()}
    assert any("EXTRA" in r.line for r in whole.malformed.collect())


def test_header_of_every_file_is_skipped(spark, tmp_path):
    raw = folder(tmp_path / "raw", {"a.csv": HEADER + ORDERS[0], "b.csv": HEADER, "c.csv": HEADER + ORDERS[1]})
    table = read_csv(spark, f"{raw}/orders.csv", C.ORDERS)
    assert [r.customer_id for r in table.frame.orderBy(*table.order_by).collect()] == ["640", "641"]
    assert table.malformed.count() == 0


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def spread(rng, count):
    """Lines of a file with values over several lines, quotes in odd places, and what to get."""
    lines, rows, bad = [], [], []
    for i in range(count):
        kind = rng.choice(["plain", "plain", "quoted", "breaks", "breaks", "inner", "open"])
        value = {
            "plain": "tiles",
            "quoted": 'a, "b"',
            "breaks": "x\n" * rng.randrange(1, 6) + rng.choice(['"', ",", "\n", 'y",z', ""]),
            "inner": '5" pipe',
            "open": "never",
        }[kind]
        head = f"{i},1,2025-05-11,{i},2,"
        if kind == "open":
            lines.append(f'{head}"{value}')
            bad.append(lines[-1])
        elif kind in ("plain", "inner"):
            lines.append(head + value)
            if kind == "inner":
                bad.append(lines[-1])
        else:
            lines.append(head + '"' + value.replace('"', '""') + '"')
        if kind in ("plain", "quoted", "breaks"):
            rows.append((str(i), value))
    return lines, rows, bad


@pytest.mark.parametrize("block", [40, 300, 100_000])
def test_line_breaks_inside_quotes_in_split_files(spark, tmp_path, block):
    """Without lines that never close a quotation every record is read, whatever the blocks."""
    rng = random.Random(block)
    raw = tmp_path / "orders.csv"
    raw.mkdir()
    want = []
    for name in ("b.csv", "a.csv"):
        lines, rows, bad = spread(rng, 120)
        keep = [line for line in lines if '"never' not in line]
        (raw / name).write_text(HEADER + "\n".join(keep) + "\n")
        want += rows if name == "b.csv" else []
        want = rows + want if name == "a.csv" else want
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        table = read_csv(spark, str(raw), C.ORDERS)
        if block < 1000:
            assert spark.read.text(str(raw)).rdd.getNumPartitions() > 20
        got = [
            (r.order_id, r.product_category)
            for r in table.frame.orderBy(*table.order_by).collect()
        ]
        bad = {r.line for r in table.malformed.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == [(i, v) for i, v in want]
    assert bad and all('5" pipe' in line for line in bad)


def test_an_open_quotation_spoils_its_own_line_alone(spark, tmp_path):
    good = "\n".join(f"{i},1,2025-05-11,5,2,tiles" for i in range(30))
    text = HEADER + f'90,1,2025-05-11,5,2,"open\n{good}\n91,1,2025-05-11,5,2,"a\nb"\n92,1,2025-05-11,5,2,x\n'
    path = tmp_path / "orders.csv"
    path.write_text(text)
    for longest in (5, 1000):
        table = read_csv(spark, str(path), C.ORDERS, longest=longest)
        ids_read = {r.order_id for r in table.frame.collect()}
        assert ids_read >= {str(i) for i in range(30)} | {"92"}
        lines = {r.line for r in table.malformed.collect()}
        assert '90,1,2025-05-11,5,2,"open' in lines
        assert len(ids_read) + len(lines) >= 32


def test_lines_between_stray_quotations_are_not_gathered(spark, tmp_path, monkeypatch):
    lines = [f"{i},1,2025-05-11,5,2,tiles" for i in range(200)]
    bad = [f'{i},"half' for i in range(200, 240)]
    for i, line in enumerate(bad):
        lines.insert(i * 6 + 3, line)
    lines += ['300,1,2025-05-11,5,2,"well', 'quoted"', "301,1,2025-05-11,5,2,x"]
    path = tmp_path / "orders.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    found = []
    monkeypatch.setattr(
        records, "spanning", lambda *a, whole=records.spanning: found.append(whole(*a)) or found[-1]
    )
    table = read_csv(spark, str(path), C.ORDERS)
    assert found[0].count() == 2
    assert {r.line for r in table.malformed.collect()} == set(bad)
    rows = table.frame.orderBy(*table.order_by).collect()
    assert [r.order_id for r in rows] == [str(i) for i in range(200)] + ["300", "301"]
    assert rows[200].product_category == "well\nquoted"

    path.write_text(HEADER + "\n".join(lines[:-3]) + "\n")
    assert read_csv(spark, str(path), C.ORDERS).frame.count() == 200
    assert found[1] is None


def test_well_quoted_records_begin_and_end_well():
    """No record that counts is passed over for its first or last line alone."""
    rng = random.Random(7)
    whole, first, last = (
        re.compile(pattern.replace(r"\z", r"\Z"))
        for pattern in (records.WELL_QUOTED, records.BEGINS_WELL, records.ENDS_WELL)
    )
    opens, stays = (re.compile(p.replace(r"\z", r"\Z")) for p in (records.OPENS, records.STAYS))
    counted = 0
    for _ in range(60_000):
        lines = "".join(rng.choices('",a\n', (4, 2, 2, 2), k=rng.randint(3, 14))).split("\n")
        inside = [bool(opens.match(lines[0]))]
        for line in lines[1:]:
            inside.append(bool((stays if inside[-1] else opens).match(line)))
        # A record over several lines: inside a quotation from its first line up to its last.
        if len(lines) > 1 and all(inside[:-1]) and not inside[-1] and whole.match("\n".join(lines)):
            counted += 1
            assert first.match(lines[0]) and last.match(lines[-1]), lines
    assert counted > 200


def test_file_numbers_come_without_a_shuffle(spark, tmp_path, monkeypatch):
    raw = folder(tmp_path / "raw", {f"f {i}.csv": HEADER + ORDERS[0] * (i + 1) for i in range(6)})
    table = read_csv(spark, f"{raw}/orders.csv", C.ORDERS)
    plan = plan_of(table.frame)
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    file_numbers = lambda t: [int(r[-1]) // 10**24 for r in t.frame.orderBy(*t.order_by).collect()]
    one = file_numbers(table)
    from parcelyard.sources import raw as module

    monkeypatch.setattr(module, "MAP_BYTES", 200)
    several = read_csv(spark, f"{raw}/orders.csv", C.ORDERS)
    plan = plan_of(several.frame)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") > 1
    assert file_numbers(several) == one == sorted(one) and len(one) == 21
