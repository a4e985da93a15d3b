"""Quality profiles of the raw tables, refresh statistics, and the charts' arithmetic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.functions.numbers import percent
from parcelyard.functions.text import known_carrier, squeeze
from parcelyard.operators import refuse
from parcelyard.plans import reports, tallies
from parcelyard.plans.reports import Tables
from parcelyard.plans.tallies import KINDS, Counts, style_count

# --- raw tables ---------------------------------------------------------------


def date_format_profile(spark: SparkSession, counts: Mapping[str, Counts]) -> DataFrame:
    """Per date column: values of each style, blank ones, and those that do not parse."""
    lines = [
        (name, f.name, *[counts[name][style_count(f.name, kind)] for kind in KINDS])
        for name, table in C.TABLES.items()
        for f in table.of_kind(C.DATE)
    ]
    kinds = ", ".join(f"{kind} long" for kind in KINDS)
    return spark.createDataFrame(lines, f"source_table string, date_column string, {kinds}")


def unmapped_carriers(raw_shipments: DataFrame) -> DataFrame:
    """First five carrier spellings outside the dictionary, with totals over all of them."""
    unmapped = (
        raw_shipments.select(F.lower(squeeze(F.col("carrier"))).alias("spelling"))
        .where((F.col("spelling") != "") & known_carrier(F.col("spelling")).isNull())
        .groupBy("spelling")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    totals = unmapped.agg(
        F.struct(
            F.sum("rows").alias("total_rows"), F.count(F.lit(1)).alias("total_spellings")
        )
    ).scalar()
    first = unmapped.orderBy("spelling").limit(5).withColumn("totals", totals)
    return first.select("spelling", "rows", "totals.*")


def mess_profile(spark: SparkSession, counts: Mapping[str, Counts]) -> DataFrame:
    """How many raw rows needed each kind of cleaning."""
    orders = counts["orders"]
    lines = [("order_rows_folded", orders[tallies.READ] - orders[tallies.DISTINCT])]
    for name in ("orders", "shipments", "warehouses"):
        lines += [(label, counts[name][label]) for label in tallies.mess(C.TABLES[name])]
    return spark.createDataFrame(lines, "mess string, rows long")


# --- refresh statistics -------------------------------------------------------


def stage_counts(spark: SparkSession, counts: Mapping[str, Counts]) -> DataFrame:
    """Rows before and after every removing step, per table in the order of the steps."""
    lines = []
    for name, own in counts.items():
        before = own[tallies.DISTINCT]
        lines.append((name, 1, "drop duplicate rows", own[tallies.READ], before))
        for step, reason in enumerate(tallies.reasons(C.TABLES[name]), start=2):
            after = before - own[tallies.refused_count(reason)]
            lines.append((name, step, f"reject: {reason}", before, after))
            before = after
    return spark.createDataFrame(
        lines, "source_table string, step int, label string, rows_before long, rows_after long"
    )


def validated(judged_shipments: DataFrame) -> DataFrame:
    """Shipments that passed their own rules: the loaded ones and those without an order."""
    loaded = F.col(refuse.OUTCOME) == refuse.LOADED
    return judged_shipments.where(loaded | (F.col(refuse.REASON) == C.ORPHAN_SHIPMENT))


def delivery_split(judged_shipments: DataFrame) -> DataFrame:
    """Early, on the day, late and in transit; reasons set and not set.

    Counted over validated shipments and over those of them whose order was loaded.
    """
    loaded = F.col(refuse.OUTCOME) == refuse.LOADED
    days = F.col("days_late")
    populations = F.when(loaded, F.array(F.lit("validated"), F.lit("loaded"))).otherwise(
        F.array(F.lit("validated"))
    )
    return (
        validated(judged_shipments)
        .select("days_late", "delay_reason", F.explode(populations).alias("population"))
        .groupBy("population")
        .agg(
            F.count_if(days < 0).alias("early"),
            F.count_if(days == 0).alias("on_the_day"),
            F.count_if(days > 0).alias("late"),
            F.count_if(days.isNull()).alias("in_transit"),
            F.count("delay_reason").alias("reason_set"),
            F.count_if(F.col("delay_reason").isNull()).alias("reason_null"),
        )
    )


# --- network summaries --------------------------------------------------------


def orders_per_month(t: Tables) -> DataFrame:
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    return t["orders"].groupBy(month).agg(F.count(F.lit(1)).alias("orders")).orderBy("month")


def delivery_totals(t: Tables) -> DataFrame:
    """Delivered, still moving and late, with late as a share of all shipments."""
    explained = F.col("delay_reason").isNotNull()
    return (
        t["shipments"]
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            F.count("actual_delivery_date").alias("delivered"),
            F.count_if(F.col("actual_delivery_date").isNull()).alias("in_transit"),
            F.count_if(explained).alias("late"),
        )
        .select("*", percent(F.col("late"), F.col("shipments")).alias("late_pct"))
    )


def _late_rate(counted: DataFrame, key: str, *tie_break: str) -> DataFrame:
    return counted.select(
        key,
        *tie_break,
        percent(F.col("late"), F.col("shipments")).alias("late_pct"),
        "shipments",
    ).orderBy(F.desc("late_pct"), key, *tie_break)


def _explained(shipments: DataFrame, key: str) -> DataFrame:
    """Shipments per key and those with a reason, which is what late means here."""
    return shipments.groupBy(key).agg(
        F.count(F.lit(1)).alias("shipments"), F.count("delay_reason").alias("late")
    )


def late_rate_by_carrier(t: Tables) -> DataFrame:
    return _late_rate(_explained(t["shipments"], "carrier"), "carrier")


def late_rate_by_warehouse(t: Tables) -> DataFrame:
    names = t["warehouses"].select("warehouse_id", F.col("name").alias("warehouse"))
    counted = _explained(t["shipments"], "warehouse_id").join(names, "warehouse_id")
    return _late_rate(counted, "warehouse", "warehouse_id")


def delay_reason_share(t: Tables) -> DataFrame:
    """Reasons by frequency, as a share of the shipments that carry one."""
    reasons = (
        t["shipments"]
        .where(F.col("delay_reason").isNotNull())
        .groupBy("delay_reason")
        .agg(F.count(F.lit(1)).alias("shipments"))
    )
    total = reasons.agg(F.sum("shipments")).scalar()
    return reasons.select(
        "*", percent(F.col("shipments"), total).alias("share_pct")
    ).orderBy(F.desc("shipments"), "delay_reason")


def delay_reason_by_warehouse(t: Tables) -> DataFrame:
    """Every recorded reason per site with its rank and the site's explained total."""
    return (
        reports.ranked_reasons(t)
        .where(F.col("delay_reason").isNotNull())
        .select("warehouse_id", "delay_reason", "occurrences", "rank_in_warehouse", "explained")
        .orderBy("warehouse_id", "rank_in_warehouse")
    )


# --- arithmetic of the charts ---------------------------------------------------


def warehouse_vs_network(t: Tables) -> DataFrame:
    """Sites with a rate, against the network's: the mean of the rounded rates weighted by volume.

    Rates have one decimal, so tenths of a percent make the weighting exact.
    """
    rate = percent(F.col("punctual"), F.col("delivered"))
    # The join below would add this filter to one use of ``sites`` only, and the two
    # uses could not share a scan.
    shipments = t["shipments"].where(F.col("warehouse_id").isNotNull())
    sites = (
        reports.delivery_sums(shipments, ["warehouse_id"], ["delivered", "punctual"])
        .where("delivered > 0")
        .select("warehouse_id", "delivered", rate.alias("on_time_pct"))
        .withColumn("tenths", F.round(F.col("on_time_pct") * 10).cast("bigint"))
    )
    network = sites.agg(
        F.struct(
            F.sum(F.col("tenths") * F.col("delivered")).alias("weighted"),
            F.sum("delivered").alias("delivered"),
        )
    ).scalar()
    names = t["warehouses"].select("warehouse_id", F.col("name").alias("warehouse"))
    return (
        sites.withColumn("network", network)
        .join(names, "warehouse_id")
        .select(
            "warehouse",
            "on_time_pct",
            "delivered",
            percent(F.col("network.weighted"), F.col("network.delivered") * 1000).alias(
                "network_pct"
            ),
            (F.col("tenths") * F.col("network.delivered") < F.col("network.weighted")).alias(
                "below_network"
            ),
        )
        .orderBy(F.desc("on_time_pct"), "warehouse")
    )


def trailing_month(t: Tables) -> DataFrame:
    """The last month of the trend, and whether shipments of it are still in transit."""
    newest = reports.monthly_trend(t).orderBy(F.desc("month")).limit(1)
    return newest.select(
        "month", "in_transit", "on_time_pct", (F.col("in_transit") > 0).alias("incomplete")
    )


def delay_reason_chart(t: Tables) -> DataFrame:
    """Reasons in chart order with the total and the longest bar; 'unknown' is muted."""
    reasons = reports.delay_reason_frequency(t)
    whole = reasons.agg(
        F.struct(F.sum("shipments").alias("total"), F.max("shipments").alias("longest"))
    ).scalar()
    return reasons.withColumn("whole", whole).select(
        F.replace("delay_reason", F.lit("_"), F.lit(" ")).alias("label"),
        "shipments",
        "share_pct",
        (F.col("delay_reason") == C.UNKNOWN_DELAY_REASON).alias("muted"),
        "whole.total",
        "whole.longest",
    ).orderBy("shipments", "label")
