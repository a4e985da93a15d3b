"""Publishing: idempotence, drift, refusal and failure."""

import datetime as dt
import time
from pathlib import Path

import pytest
from frames import ORDER, SHIPMENT, ids, raw, refreshed
from pyspark.sql import functions as F

from parcelyard import contract
from parcelyard.plans import catalogue, refresh
from parcelyard.plans.refresh import Snapshot, publish, write_rejects_csv
from parcelyard.sources.store import ContractDrift, ContractViolation, LostRace, Store

CONTRACT = Path(contract.__file__).read_text()


def rows(frame):
    return sorted(map(str, frame.collect()))


def contents(spark, root):
    live = Snapshot(spark, root)
    return {n: rows(t) for n, t in live.tables().items()} | {"rejects": rows(live.rejects())}


def test_publish_twice(spark, tmp_path):
    root = str(tmp_path)
    bad = ("301", "7", "", "1", "1", "garden")
    with pytest.raises(FileNotFoundError):
        Snapshot(spark, root)
    first = publish(spark, raw(spark, orders=[ORDER, ORDER, bad]), root)
    before = contents(spark, root)
    second = publish(spark, raw(spark, orders=[ORDER, ORDER, bad]), root)
    assert contents(spark, root) == before
    assert (first.version, second.version) == (1, 2)
    assert (second.warehouses, second.orders, second.shipments, second.rejects) == (1, 1, 1, 1)
    assert Snapshot(spark, root).table("orders").first().order_date == dt.date(2024, 11, 18)
    # Intermediate stages do not outlive a publish.
    assert not list(Path(root).glob("versions/*/staging"))
    # A full refresh mirrors the source: rows gone there are gone here.
    publish(spark, raw(spark, orders=[], shipments=[]), root)
    live = Snapshot(spark, root)
    assert live.table("orders").count() == 0 and live.rejects().count() == 0

    write_rejects_csv(live.rejects(), f"{root}/rejects.csv")
    empty = spark.read.option("header", True).csv(f"{root}/rejects.csv")
    assert empty.count() == 0 and empty.columns[:3] == ["source_table", "reason", "detail"]


def shuffled(spark):
    """Names of the shuffle files that are there."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_publish_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffled(spark)
    rows = [(str(n), *ORDER[1:]) for n in range(50)]
    publish(spark, raw(spark, orders=[*rows, *rows]), str(tmp_path))
    for _ in range(50):
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_stages_go_with_the_table_made_of_them(spark, tmp_path, monkeypatch):
    def made():
        return {p.name for p in (tmp_path / "run" / "staging").glob("*")}

    seen = {}
    whole = refresh.refuse.judged

    def looks(table, *rest):
        seen[table.name] = made()
        return whole(table, *rest)

    monkeypatch.setattr(refresh.refuse, "judged", looks)
    run = refreshed(spark, tmp_path / "run")
    run.settle()
    assert seen == {name: {f"{name}_marked"} for name in contract.TABLES}
    assert not made()
    assert {n: t.count() for n, t in run.tables().items()} == dict.fromkeys(contract.TABLES, 1)


def test_marking_by_slices_is_marking(spark, tmp_path, monkeypatch):
    orders = [(str(n % 20), "7", "2024-11-18", str(n), "6", "garden") for n in range(60)]
    orders += [("", *ORDER[1:]), (None, *ORDER[1:])]
    whole = rows(refreshed(spark, tmp_path / "whole", orders=orders).judged("orders"))
    monkeypatch.setattr(refresh, "SLICED_BYTES", 0)
    run = refreshed(spark, tmp_path / "sliced", orders=orders)
    assert rows(run.judged("orders")) == whole and len(whole) == 61
    assert len(list(Path(run.staging, "orders_marked").glob("*"))) == refresh.SLICES


def test_compared_versions(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (None, None), (3, "d"), (4, "e")], "k int, v string")
    run = refreshed(spark, tmp_path)
    differ = old.exceptAll(new).count() + new.exceptAll(old).count()
    found = catalogue._compared(run, f"{tmp_path}/a", old, new).collect()
    assert [tuple(r) for r in found] == [(5, 5, differ)] and differ == 4
    none = catalogue._compared(run, f"{tmp_path}/b", old.limit(0), new.limit(0)).collect()
    assert [tuple(r) for r in none] == [(0, 0, 0)]


def test_vocabulary_violation_keeps_the_live_version(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, raw(spark), root)
    before = contents(spark, root)
    strange = ("9001", *SHIPMENT[1:5], "2024-12-01", "strike")
    with pytest.raises(ContractViolation, match=r"delay_reason in vocabulary \(1 rows\)") as refused:
        publish(spark, raw(spark, shipments=[SHIPMENT, strange]), root)
    found = spark.read.parquet(f"{refused.value.folder}/violations").collect()
    assert [tuple(r) for r in found] == [("shipments", "delay_reason in vocabulary", 9001)]
    assert not list(Path(root).glob("versions/*/staging"))
    with pytest.raises(ContractViolation, match=r"region not null \(1 rows\)"):
        publish(spark, raw(spark, warehouses=[("7", "A", " ", "C", "S")]), root)
    assert contents(spark, root) == before


def test_failure_between_tables_keeps_the_live_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish(spark, raw(spark), root)
    before = contents(spark, root)
    whole = refresh.refuse.judged

    def fails_on_shipments(table, *rest):
        if table.name == "shipments":
            raise OSError("disk gone")
        return whole(table, *rest)

    monkeypatch.setattr(refresh.refuse, "judged", fails_on_shipments)
    with pytest.raises(OSError):
        publish(spark, raw(spark, orders=[("333", *ORDER[1:])]), root)
    assert len(list(Path(root).glob("versions/*"))) == 1
    assert contents(spark, root) == before


def test_a_store_takes_one_contract_only(spark, tmp_path, monkeypatch):
    root, edited = str(tmp_path / "store"), tmp_path / "edited.py"
    publish(spark, raw(spark), root)
    before, stamp = contents(spark, root), contract.fingerprint()
    for text in (CONTRACT + "\n", CONTRACT.replace("UNKNOWN_CUSTOMER_ID = 0", "UNKNOWN_CUSTOMER_ID = 1")):
        edited.write_text(text)
        with pytest.raises(ContractDrift, match=f"{stamp}.*{contract.fingerprint(edited)}"):
            publish(spark, raw(spark, orders=[]), root, contract_path=edited)
        assert contents(spark, root) == before
    # An empty folder takes the edited contract, and then only that one.
    other = str(tmp_path / "other")
    publish(spark, raw(spark), other, contract_path=edited)
    with pytest.raises(ContractDrift):
        publish(spark, raw(spark), other)
    # A version without a stamp compares with nothing.
    monkeypatch.setattr(contract, "fingerprint", lambda path=None: None)
    bare = Store(spark, str(tmp_path / "bare"))
    bare.commit("somewhere", None, dict.fromkeys(("warehouses", "orders", "shipments", "rejects"), 0), 0)
    monkeypatch.undo()
    with pytest.raises(ContractDrift, match="none"):
        bare.check_contract()


def test_overtaken_publish_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    counts = dict.fromkeys(("warehouses", "orders", "shipments", "rejects"), 0)
    assert store.commit("a", "f", counts, 0).version == 1
    with pytest.raises(LostRace):
        store.commit("late", "f", counts, 0)
    (tmp_path / "claims" / "2").touch()
    with pytest.raises(LostRace, match="claims/2"):
        store.commit("b", "f", counts, 1)
    (tmp_path / "claims" / "2").unlink()
    assert store.commit("b", "f", counts, 1).version == 2
    assert store.folders() == ["b", "a"]


def test_prune_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(3):
        publish(spark, raw(spark), root)
    assert len(refresh.prune(spark, root, 2)) == 1
    assert len(list(Path(root).glob("versions/*"))) == 2
    assert Snapshot(spark, root).table("orders").count() == 1
    with pytest.raises(ValueError):
        refresh.prune(spark, root, 0)


def test_snapshot_is_consistent_for_a_reader(spark, tmp_path):
    """Tables taken before a publish still read the old version after it."""
    root = str(tmp_path)
    publish(spark, raw(spark), root)
    old = Snapshot(spark, root).table("orders")
    publish(spark, raw(spark, orders=[("333", *ORDER[1:])], shipments=[]), root)
    assert ids(old, "order_id") == [300]
    assert ids(Snapshot(spark, root).table("orders"), "order_id") == [333]
    assert old.where(F.col("order_id") == 300).count() == 1


def test_rejects_come_back_from_csv(spark, tmp_path):
    from parcelyard.plans.refresh import read_rejects_csv, write_rejects_csv

    hard = ["", None, " ", "\\", "\\n", "\\\\n", "a\nb", "\r\n", 'say "x", y', "\\0", "\0", " \\\\0\0\\", "é\n\n"]
    frame = spark.createDataFrame(
        [(i, t, None) for i, t in enumerate(hard)], "id long, detail string, day date"
    )
    path = str(tmp_path / "rejects")
    write_rejects_csv(frame.coalesce(1), path)
    lines = [line for part in (tmp_path / "rejects").glob("*.csv") for line in part.read_bytes().split(b"\n")]
    assert len(lines) == len(hard) + 2  # a header, and the end of the last line
    back = read_rejects_csv(spark, path, frame.schema)
    assert back.dtypes == frame.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.collect()))
    write_rejects_csv(frame.limit(0), path)
    assert read_rejects_csv(spark, path, frame.schema).count() == 0
