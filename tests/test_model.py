"""The whole refresh against a row-by-row model in plain Python, on random dirty rows."""

import datetime as dt
import random

import pytest
from frames import raw
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.plans.refresh import Refresh

D = dt.date
# (text, what it means); small ranges, so that keys collide and rows repeat.
DAYS = [(t, D(2026, 3, d)) for d in (1, 2, 3) for t in (f"2026-03-0{d}", f"3/{d}/2026", f" 0{d}-Mar-2026")]
DATES = DAYS + [("", None), ("2026-02-30", None), (None, None)]
CARRIERS = [(" ups", "UPS"), ("FEDEX ", "FedEx"), ("", "Unknown"), ("acme  co", "Acme Co"), (None, "Unknown")]
REASONS = [("", None), (" Weather", "weather"), ("customs", "customs"), (None, None)]
CATEGORIES = [("Toys", "toys"), (" toys ", "toys"), ("", "unknown"), (None, "unknown")]


def whole(low, high, rng):
    number = rng.randint(low, high)
    return rng.choice([(str(number), number)] * 8 + [(f"0{number}" if number > 0 else str(number), number), (f"{number}.0", number), ("x", None), (None, None)])


def make(seed):
    rng = random.Random(seed)
    sites = [
        [whole(1, 4, rng), *[(t, t) for t in (rng.choice(["A DC", "B DC"]), rng.choice(["East", "West"]), "City", "ST")]]
        for _ in range(8)
    ]
    orders = [
        [whole(1, 40, rng), whole(1, 6, rng), rng.choice(DATES), rng.choice([("7", 7), ("oops", 0), (None, 0)]),
         whole(-1, 3, rng), rng.choice(CATEGORIES)]
        for _ in range(120)
    ]
    shipments = [
        [whole(1, 120, rng), whole(1, 40, rng), rng.choice(CARRIERS), rng.choice(DATES), rng.choice(DATES),
         rng.choice(DATES), rng.choice(REASONS)]
        for _ in range(300)
    ]
    orders += [list(rng.choice(orders)) for _ in range(20)]
    shipments += [list(rng.choice(shipments)) for _ in range(40)]
    rng.shuffle(orders)
    return {"warehouses": sites, "orders": orders, "shipments": shipments}


def model(data):
    loaded, rejects = {}, []
    for name, table in C.TABLES.items():
        columns = table.source_columns
        rows = []
        for row in data[name]:
            values = dict(zip(columns, (v for _, v in row)))
            if values not in rows:
                rows.append(values)

        def refuse(reason, detail, broken):
            nonlocal rows
            kept = []
            for row in rows:
                if broken(row):
                    rejects.append((name, reason, detail(row), tuple(row.values())))
                else:
                    kept.append(row)
            rows = kept

        numbers, dates = table.required(C.WHOLE), table.required(C.DATE)
        refuse(
            C.BAD_NUMBER,
            lambda r: "not numeric: " + ", ".join(c for c in numbers if r[c] is None),
            lambda r: any(r[c] is None for c in numbers),
        )
        seen = set()
        refuse(
            C.KEY_CONFLICT,
            lambda r: f"{table.key}={r[table.key]} already seen with different values",
            lambda r: r[table.key] in seen or seen.add(r[table.key]),
        )
        refuse(
            C.MISSING_DATE,
            lambda r: "NaT: " + ", ".join(c for c in dates if r[c] is None),
            lambda r: any(r[c] is None for c in dates),
        )
        if name == "orders":
            refuse(C.QUANTITY_NOT_POSITIVE, lambda r: f"quantity={r['quantity']}", lambda r: r["quantity"] <= 0)
        if name == "shipments":
            for reason, word in ((C.ACTUAL_BEFORE_SHIP, "actual"), (C.EXPECTED_BEFORE_SHIP, "expected")):
                day = f"{word}_delivery_date"
                refuse(
                    reason,
                    lambda r: f"{word} {r[day]} < ship {r['ship_date']}",
                    lambda r: r[day] is not None and r[day] < r["ship_date"],
                )
            for row in rows:
                actual = row["actual_delivery_date"]
                days = (actual - row["expected_delivery_date"]).days if actual else None
                if days is not None and days > 0 and row["delay_reason"] is None:
                    row["delay_reason"] = "unknown"
                row["days_late"] = days
                row["on_time"] = None if days is None else int(days <= 0)
        if table.parent:
            column = table.parent.column
            parents = {r[column] for r in loaded[table.parent.parent]}
            refuse(
                C.ORPHAN_ORDER if name == "orders" else C.ORPHAN_SHIPMENT,
                lambda r: f"{column}={r[column]}",
                lambda r: r[column] not in parents,
            )
        loaded[name] = rows
    return loaded, rejects


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_refresh_equals_model(spark, tmp_path, seed):
    data = make(seed)
    want, want_rejects = model(data)
    texts = {n: [tuple(t for t, _ in row) for row in rows] for n, rows in data.items()}
    run = Refresh(spark, raw(spark, **texts), str(tmp_path))
    for name, table in C.TABLES.items():
        got = [tuple(r) for r in run.loaded(name).select(*table.columns).collect()]
        assert sorted(got, key=str) == sorted((tuple(r.values()) for r in want[name]), key=str), name
        got = [
            (name, r.reason, r.detail, tuple(r[c] for c in table.columns))
            for r in run.rejects().where(F.col("source_table") == name).collect()
        ]
        padded = [
            (n, reason, detail, values + (None,) * (len(table.columns) - len(values)))
            for n, reason, detail, values in want_rejects
            if n == name
        ]
        assert sorted(got, key=str) == sorted(padded, key=str), name
    assert len({reason for _, reason, _, _ in want_rejects}) >= 7
