"""Small raw frames, and a refresh over them."""

from pyspark.sql import types as T

from parcelyard.contract import TABLES
from parcelyard.plans.refresh import Refresh
from parcelyard.sources.raw import from_frame

SITE = ("7", "Dockside", "Lowlands", "Utrecht", "UT")
ORDER = ("300", "7", "2024-11-18", "81", "6", "garden")
SHIPMENT = ("9000", "300", "DHL", "2024-11-20", "2024-11-24", "2024-11-23", "")


def raw_frame(spark, name, rows):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in TABLES[name].source_columns])
    return spark.createDataFrame(rows, schema)


def raw(spark, warehouses=(SITE,), orders=(ORDER,), shipments=(SHIPMENT,)):
    given = {"warehouses": warehouses, "orders": orders, "shipments": shipments}
    return {n: from_frame(raw_frame(spark, n, list(rows))) for n, rows in given.items()}


def refreshed(spark, folder, **rows):
    return Refresh(spark, raw(spark, **rows), str(folder))


def ids(frame, column):
    return sorted(r[0] for r in frame.select(column).collect())


def reasons(rejects):
    """{(table, key): (reason, detail)}"""
    keys = {n: t.key for n, t in TABLES.items()}
    return {
        (r.source_table, r[keys[r.source_table]]): (r.reason, r.detail) for r in rejects.collect()
    }
