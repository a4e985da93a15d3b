"""TPC-H-like tables as raw logistics extracts.

nation is the warehouse, orders the order, lineitem the shipment. The tables are
clean and know no delivery dates, so key arithmetic supplies dates and dirt: four
date styles, sloppy text, duplicates, conflicts, bad numbers and orphans.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.sources.raw import RawTable


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _styled(day: Column, key: Column) -> Column:
    style = key % 8
    return (
        F.when(style == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(style == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(style == 2, F.date_format(day, "dd-MMM-yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def warehouses(spark: SparkSession, sf_dir: str) -> RawTable:
    nation, region = _load(spark, sf_dir, "nation"), _load(spark, sf_dir, "region")
    key, name = F.col("n_nationkey"), F.col("r_name")
    sloppy = (
        F.when(key % 4 == 0, F.upper(name))
        .when(key % 4 == 1, F.concat(F.lit(" "), F.lower(name)))
        .when(key % 4 == 2, F.concat(F.lower(name), F.lit("  ")))
        .otherwise(name)
    )
    frame = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _text(key).alias("warehouse_id"),
        F.concat(F.lit(" "), "n_name", F.lit(" DC")).alias("name"),
        sloppy.alias("region"),
        F.lower("n_name").alias("city"),
        F.lower(F.substring(name, 1, 2)).alias("state"),
        key.cast("bigint").alias("ord"),
    )
    return RawTable(frame, ("ord",))


def orders(spark: SparkSession, sf_dir: str) -> RawTable:
    k, customer = F.col("o_orderkey"), F.col("o_custkey")
    day, priority = F.col("o_orderdate").cast("date"), F.col("o_orderpriority")
    site = (
        F.when(customer % 50 == 0, 99)
        .when(F.col("c_nationkey") == 24, 23)
        .otherwise(F.col("c_nationkey"))
    )
    iso = F.date_format(day, "yyyy-MM-dd")

    def copy(present: Column, written: Column, extra: int, ordinal: int) -> Column:
        return F.struct(
            present.alias("present"),
            written.alias("written"),
            F.lit(extra).alias("extra"),
            F.lit(ordinal).alias("ord"),
        )

    # The row itself, an exact copy in another date style, and a conflicting one.
    copies = F.array(
        copy(F.lit(True), _styled(day, k), 0, 0),
        copy(k % 50 == 7, iso, 0, 0),
        copy(k % 101 == 0, iso, 1, 1),
    )
    base = (
        _load(spark, sf_dir, "orders")
        .join(_load(spark, sf_dir, "customer"), customer == F.col("c_custkey"))
        .select(
            k.alias("k"),
            customer.alias("customer"),
            priority.alias("priority"),
            site.alias("site"),
            F.inline(F.filter(copies, lambda c: c["present"])),
        )
    )
    k, priority = F.col("k"), F.col("priority")
    frame = base.select(
        F.when(k % 211 == 0, F.concat(F.lit("x"), _text(k)))
        .when(k % 10 == 3, F.lpad(_text(k), 10, "0"))
        .otherwise(_text(k))
        .alias("order_id"),
        _text(F.col("site")).alias("warehouse_id"),
        F.when(k % 307 == 0, "not-a-date")
        .when(k % 311 == 0, "9999-12-31")
        .when(k % 313 == 0, "01/01/1500")
        .otherwise(F.col("written"))
        .alias("order_date"),
        F.when(k % 31 == 0, None)
        .when(k % 173 == 0, "oops")
        .otherwise(_text(F.col("customer")))
        .alias("customer_id"),
        F.when(k % 149 == 0, "0")
        .when(k % 151 == 0, "-3")
        .when(k % 401 == 0, "lots")
        .when(k % 403 == 0, "2.5")
        .when(k % 407 == 0, "12345678901234567890")
        .when(k % 409 == 0, "7.0")
        .when(k % 419 == 0, "1e3")
        .otherwise(_text(k % 12 + 1 + F.col("extra")))
        .alias("quantity"),
        F.when(k % 33 == 0, "  ")
        .when(k % 4 == 0, F.upper(priority))
        .when(k % 4 == 1, F.concat(F.lit(" "), F.lower(priority)))
        .otherwise(priority)
        .alias("product_category"),
        "ord",
    )
    return RawTable(frame, ("ord",))


def shipments(spark: SparkSession, sf_dir: str) -> RawTable:
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    base = _load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("id"),
        "l_orderkey",
        part.alias("p"),
        supplier.alias("s"),
        "l_quantity",
        line.alias("line"),
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("ship"),
        ((part * 7 + supplier * 3 + line) % 13).alias("h"),
    )
    p, h, ship = F.col("p"), F.col("h"), F.col("ship")
    carriers = F.array(*[F.lit(c) for c in ("FedEx", "UPS", "DHL", "USPS", "OnTrac", "LaserShip")])
    promised = F.when(p % 127 == 0, F.date_sub(ship, 3)).otherwise(
        F.date_add(ship, (F.col("line") % 4 + 2).cast("int"))
    )
    slip = (
        F.when(h == 9, 1).when(h == 10, 2).when(h == 11, 6).when(h == 12, 14).when(h == 0, -1)
        .otherwise(0)
    )
    dated = base.withColumns(
        {
            "expected": promised,
            "slip": slip,
            "brand": F.get(carriers, ((F.col("s") + p) % 6).cast("int")),
        }
    ).withColumn(
        "actual",
        F.when((F.col("l_linestatus") == "O") & (h == 7), None)
        .when(p % 131 == 0, F.date_sub(ship, 1))
        .when(p % 127 == 0, ship)
        .otherwise(F.date_add("expected", F.col("slip"))),
    )
    brand, expected, actual = F.col("brand"), F.col("expected"), F.col("actual")
    reason = (
        F.when(p % 5 == 0, "Weather")
        .when(p % 5 == 1, "carrier_delay ")
        .when(p % 5 == 2, "INVENTORY_SHORTAGE")
        .when(p % 5 == 3, "address_issue")
        .otherwise("customs")
    )
    frame = dated.select(
        _text(F.col("id")).alias("shipment_id"),
        _text(F.col("l_orderkey")).alias("order_id"),
        F.when(p % 40 == 0, None)
        .when(p % 5 == 0, F.upper(brand))
        .when(p % 5 == 1, F.lower(brand))
        .when(p % 5 == 2, F.concat(F.lit("  "), brand, F.lit(" ")))
        .otherwise(brand)
        .alias("carrier"),
        F.when(p % 409 == 0, "").otherwise(_styled(ship, p)).alias("ship_date"),
        _styled(expected, p).alias("expected_delivery_date"),
        _styled(actual, p).alias("actual_delivery_date"),
        F.when((actual > expected) & (p % 11 != 0), reason).alias("delay_reason"),
        # Part, supplier and quantity as one number.
        (
            p.cast("decimal(18,0)") * F.lit(Decimal(10**15))
            + F.col("s").cast("decimal(12,0)") * F.lit(Decimal(10**3))
            + F.col("l_quantity").cast("decimal(3,0)")
        )
        .cast("decimal(38,0)")
        .alias("ord"),
    )
    return RawTable(frame, ("ord",))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, RawTable]:
    return {
        "warehouses": warehouses(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "shipments": shipments(spark, sf_dir),
    }
