"""Plans that must hold when one key has a third of all rows."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.operators import clean, dedup, refuse
from parcelyard.sources.raw import RawTable
from parcelyard.sources.store import stage

ROWS = 30_000

# Small data stands for large: no broadcast, and a few KB count as a big partition.
SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def raw_shipments(spark, key, order):
    frame = spark.range(0, ROWS, numPartitions=8).select(
        key.cast("string").alias("shipment_id"),
        order.cast("string").alias("order_id"),
        F.lit("UPS").alias("carrier"),
        F.lit("2026-03-02").alias("ship_date"),
        F.lit("2026-03-05").alias("expected_delivery_date"),
        F.date_format(F.date_add(F.lit("2026-03-05").cast("date"), (F.col("id") % 900).cast("int")), "yyyy-MM-dd").alias(
            "actual_delivery_date"
        ),
        F.lit(None).cast("string").alias("delay_reason"),
        "id",
    )
    return RawTable(frame, ("id",))


def distinct_rows(cleaned):
    folded = dedup.folded_rows(C.SHIPMENTS, cleaned)
    return dedup.distinct_rows(C.SHIPMENTS, folded, dedup.refolded_rows(C.SHIPMENTS, folded))


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Distinct shipments where one key and one order have a third of all rows each."""
    with settings(spark, SKEWED):
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000)
        order = F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id") % 5000)
        cleaned = clean.clean(C.SHIPMENTS, raw_shipments(spark, key, order))
        path = str(tmp_path_factory.mktemp("hot"))
        return stage(spark, path, distinct_rows(cleaned).repartition(8))


def test_equal_rows_fold_before_the_shuffle(spark):
    raw = raw_shipments(spark, F.lit(7), F.lit(5))
    cleaned = clean.clean(C.SHIPMENTS, raw)
    distinct = distinct_rows(cleaned)
    assert distinct.count() == 900
    assert distinct.agg(F.sum(dedup.COPIES)).first()[0] == ROWS
    plan = executed_plan(dedup.folded_rows(C.SHIPMENTS, cleaned)).split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan
    # Numbers are folded, so rows are hashed on either side of the shuffle, not sorted.
    assert plan.count("HashAggregate") == 2 and "Sort" not in plan and "Window" not in plan


def test_hot_key_first_row(spark, hot, tmp_path):
    with settings(spark, SKEWED):
        contested = stage(spark, str(tmp_path), dedup.contested_keys(C.SHIPMENTS, hot))
        assert [r[0] for r in contested.collect()] == [7]
        first = dedup.first_rows(C.SHIPMENTS, hot, contested)
        row = first.first()
        assert (row.shipment_id, row._first._ordinal) == (7, 0)
        plan = executed_plan(first)
    assert "SortMergeJoin(skew=true)" in plan.split("Initial Plan")[0]
    # The claims are folded after the join and meet in a shuffle of their own.
    assert "partial_min" in plan and re.search(r"Exchange hashpartitioning\(_groupingexpression", plan)
    assert "Window" not in plan


def test_joins_split_the_hot_keys(spark, hot, tmp_path):
    with settings(spark, SKEWED):
        contested = dedup.contested_keys(C.SHIPMENTS, hot)
        first = stage(spark, str(tmp_path / "first"), dedup.first_rows(C.SHIPMENTS, hot, contested))
        orders = stage(
            spark,
            str(tmp_path / "orders"),
            spark.range(6000).select(F.col("id").alias("order_id"), (F.col("id") % 10).alias("warehouse_id")),
        )
        judged = refuse.judged(C.SHIPMENTS, hot, first, orders)
        plan = executed_plan(judged)
        joins = re.findall(r"SortMergeJoin\S*", plan.split("Initial Plan")[0])
        assert len(joins) == 2 and all("skew=true" in j for j in joins), joins
        counts = {r[0]: r[1] for r in judged.groupBy("reason").count().collect()}
    losers = hot.where("shipment_id = 7").count() - 1
    assert losers > ROWS // 100
    assert counts[C.KEY_CONFLICT] == losers
    assert counts[None] == hot.count() - losers


def test_stages_are_broadcast_only_below_the_threshold(spark, hot, tmp_path):
    contested = dedup.contested_keys(C.SHIPMENTS, hot)
    first = stage(spark, str(tmp_path / "first"), dedup.first_rows(C.SHIPMENTS, hot, contested))
    joined = refuse.validated(C.SHIPMENTS, hot, first)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1"}):
        joined = refuse.validated(C.SHIPMENTS, hot, first)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_unique_ordinals_read_no_values(spark, hot, tmp_path):
    contested = stage(spark, str(tmp_path), dedup.contested_keys(C.SHIPMENTS, hot))
    for unique, reads in ((True, False), (False, True)):
        first = dedup.first_rows(C.SHIPMENTS, hot, contested, unique)
        plan = first._jdf.queryExecution().executedPlan().toString()
        assert ("carrier:string" in plan) is reads
        assert first.first()._first._ordinal == 0


def test_one_shuffle_by_key_marks_conflicts_and_spares_crowded_keys(spark, hot, tmp_path):
    # Rows without a readable key, a key of two rows at the same place, and hot key 7.
    lost = hot.where("shipment_id % 5 = 0").withColumn("shipment_id", F.lit(None).cast("long"))
    tied = hot.where("shipment_id = 1001")
    rows = hot.unionByName(lost).unionByName(tied.withColumn("carrier", F.lit("ABC")))
    contested = dedup.contested_keys(C.SHIPMENTS, rows)
    assert contested.count() == 2
    want = dedup.with_conflicts(C.SHIPMENTS, rows, dedup.first_rows(C.SHIPMENTS, rows, contested))
    crowded = dedup.contested_keys(C.SHIPMENTS, rows, 100)
    assert [r[0] for r in crowded.collect()] == [7]
    first = stage(spark, str(tmp_path / "first"), dedup.first_rows(C.SHIPMENTS, rows, crowded))
    got = dedup.with_conflicts_sorted(C.SHIPMENTS, rows, first)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count()
    plan = executed_plan(got).split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    # No task gets the rows of key 7 or those without a key.
    dealt = F.xxhash64(clean.ORDINAL, *C.SHIPMENTS.source_columns)
    assert rows.where("shipment_id = 7").select(dealt).distinct().count() > ROWS // 4


def test_rows_of_a_crowded_key_are_split(spark, hot, tmp_path):
    with settings(spark, SKEWED):
        crowded = dedup.contested_keys(C.SHIPMENTS, hot, 100)
        first = stage(spark, str(tmp_path / "first"), dedup.first_rows(C.SHIPMENTS, hot, crowded))
        orders = stage(
            spark,
            str(tmp_path / "orders"),
            spark.range(6000).select(F.col("id").alias("order_id"), (F.col("id") % 10).alias("warehouse_id")),
        )
        marked = dedup.with_conflicts_sorted(C.SHIPMENTS, hot, first)
        judged = refuse.judged_rows(C.SHIPMENTS, marked, orders)
        plan = executed_plan(judged).split("Initial Plan")[0]
        joins = re.findall(r"SortMergeJoin\S*", plan)
        # The join with the crowded keys, and apart from it the sort, deal the hot key's rows anew.
        assert "SortMergeJoin(skew=true)" in joins, joins
        assert "hashpartitioning(_claim" in plan and "hashpartitioning(order_id" in plan
        assert judged.where(F.col("reason") == C.KEY_CONFLICT).count() == (
            hot.where("shipment_id = 7").count() - 1
        )
