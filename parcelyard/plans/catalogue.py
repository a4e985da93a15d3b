"""Every query by name, over the adapter tables of a scale-factor folder.

The tables are refreshed once per session and folder; queries share the written
stages and each one builds only the stages it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.operators import clean, dedup, gate, keys, refuse
from parcelyard.plans import profiles, reports
from parcelyard.plans.refresh import (
    SLICES,
    Refresh,
    loaded_part,
    publish,
    read_rejects_csv,
    row_counts,
    write_rejects_csv,
)
from parcelyard.plans.tallies import Counts
from parcelyard.session import prepare, removed_at_exit, shared_folder
from parcelyard.sources import adapters, raw
from parcelyard.sources.store import Store, stage

Query = Callable[[SparkSession, str], DataFrame]

CSV_LINE = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"
}

_runs: dict[tuple[str, str], Refresh] = {}
_extracts: set[str] = set()
_read: dict[str, raw.RawTable] = {}


def refresh_of(spark: SparkSession, sf_dir: str) -> Refresh:
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _runs:
        prepare(spark, sf_dir)
        folder = removed_at_exit(spark, f"{shared_folder(spark)}/parcelyard/{uuid.uuid4().hex}")
        _runs.setdefault(name, Refresh(spark, adapters.raw_tables(spark, sf_dir), folder, sf_dir))
    return _runs[name]


# --- sources and cleaning -------------------------------------------------------


def _half(key: Column) -> Column:
    return F.concat(key, F.lit(',"half'))


def _surplus(key: Column) -> Column:
    return F.concat(key, F.lit(",a,b,c,d,e,f,g"))


def extracted(run: Refresh, name: str) -> raw.RawTable:
    """A table written out as CSV lines and read back; every 89th and 97th key adds a bad line."""
    table, path = C.TABLES[name], f"{run.folder}/{name}.csv"
    key = F.col(table.key)
    number = F.when(key.rlike("^[0-9]+$"), key.cast("bigint"))
    line = F.to_csv(F.struct(*table.source_columns), CSV_LINE)
    if path not in _extracts:
        lines = F.array(
            line, F.when(number % 89 == 0, _half(key)), F.when(number % 97 == 0, _surplus(key))
        )
        run.raw[name].frame.select(F.explode(F.array_compact(lines))).write.mode("overwrite").text(path)
        _extracts.add(path)
        _read[path] = raw.read_csv(run.spark, path, table, header=table.source_columns)
    return _read[path]


def extract(name: str) -> Callable[[Refresh], DataFrame]:
    return lambda run: extracted(run, name).frame.select(*C.TABLES[name].source_columns)


def reject_malformed(run: Refresh) -> DataFrame:
    """Lines of the written extracts that are no rows."""
    return _union([refuse.malformed_lines(n, extracted(run, n).malformed) for n in C.TABLES]).select(
        "source_table", refuse.REASON, clean.UNPARSED
    )


def _order_lines(run: Refresh, note: Column) -> DataFrame:
    """All orders of the source as CSV lines of the orders table, with ``note`` as category."""
    orders = run.spark.read.parquet(f"{run.source}/orders.parquet")
    values = [
        F.col("o_orderkey").cast("string"),
        (F.col("o_custkey") % 25).cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.col("o_custkey").cast("string"),
        F.lit("1"),
        note,
    ]
    columns = [v.alias(c) for v, c in zip(values, C.ORDERS.source_columns)]
    line = F.to_csv(F.struct(*columns), CSV_LINE)
    return orders.select("o_orderkey", line.alias("line"))


def source_order(run: Refresh) -> DataFrame:
    """First and last order of each site as the source has them: four folders of unequal size.

    The folders hold an eighth, another, a quarter and half of the orders, dealt by key; in
    each the files, and the lines in each file, go by descending key.
    """
    folders = [f"{run.folder}/orders_{letter}.csv" for letter in "dacb"]
    if folders[0] not in _extracts:
        lines = _order_lines(run, F.col("o_orderpriority"))
        share = F.col("o_orderkey") % 8
        shares = [share == 0, share == 1, share.isin(2, 3), share > 3]
        for path, mine in zip(sorted(folders), shares):
            order = F.desc("o_orderkey")
            sorted_lines = lines.where(mine).repartitionByRange(3, order).sortWithinPartitions(order)
            sorted_lines.select("line").write.mode("overwrite").text(path)
        _extracts.add(folders[0])
    table = raw.read_csv(run.spark, folders, C.ORDERS, header=C.ORDERS.source_columns)
    place = F.struct(*table.order_by)
    return table.frame.groupBy("warehouse_id").agg(
        F.count("*").alias("rows"),
        F.min_by("order_id", place).alias("first_order"),
        F.max_by("order_id", place).alias("last_order"),
    )


def extract_line_breaks(run: Refresh) -> DataFrame:
    """Orders whose category holds line breaks, quotes and commas, back from splittable files.

    Every 97th key adds a line with too many fields.
    """
    path = f"{run.folder}/orders_with_breaks.csv"
    if path not in _extracts:
        key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
        note = (
            F.when(key % 3 == 0, F.concat(priority, F.lit("\nsecond, line\n"), key.cast("string")))
            .when(key % 5 == 0, F.concat(F.lit('say "'), priority, F.lit('"\n')))
            .otherwise(priority)
        )
        lines = F.array("line", F.when(key % 97 == 0, _surplus(key.cast("string"))))
        made = _order_lines(run, note).select(F.explode(F.array_compact(lines)).alias("line"))
        made.repartition(4, "line").write.mode("overwrite").text(path)
        _extracts.add(path)
    table = raw.read_csv(run.spark, path, C.ORDERS, header=C.ORDERS.source_columns)
    return table.frame.select("order_id", "customer_id", "product_category").unionByName(
        table.malformed.select(
            F.lit(None).cast("string").alias("order_id"),
            F.lit(None).cast("string").alias("customer_id"),
            F.col("line").alias("product_category"),
        )
    )


def _cleaned(
    run: Refresh, name: str, wanted: Callable[[C.Field], bool], fill: bool = False
) -> DataFrame:
    """Raw id and the cleaned columns of one table that ``wanted`` picks."""
    table = C.TABLES[name]
    cleaned = clean.values(table, run.raw[name].frame, F.col(table.key).alias("raw_id"))
    return cleaned.select(
        F.lit(name).alias("source_table"),
        "raw_id",
        *[
            (clean.filled(f) if fill else F.col(f.name)).alias(f.name)
            for f in table.fields
            if wanted(f)
        ],
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def clean_dates(run: Refresh) -> DataFrame:
    return _union([_cleaned(run, n, lambda f: f.kind == C.DATE) for n in ("orders", "shipments")])


def clean_text(run: Refresh) -> DataFrame:
    return _union(
        [
            _cleaned(run, n, lambda f: f.kind == C.TEXT and f.case != "carrier")
            for n in C.TABLES
        ]
    )


def clean_carrier(run: Refresh) -> DataFrame:
    return clean.values(
        C.SHIPMENTS,
        run.raw["shipments"].frame,
        F.col("shipment_id").alias("raw_id"),
        F.col("carrier").alias("raw_carrier"),
    ).select("raw_id", "raw_carrier", "carrier")


def clean_numbers(run: Refresh) -> DataFrame:
    return _union([_cleaned(run, n, lambda f: f.kind == C.WHOLE) for n in C.TABLES])


def clean_fill(run: Refresh) -> DataFrame:
    return _union(
        [
            _cleaned(run, n, lambda f: f.fill is not None, fill=True)
            for n in ("orders", "shipments")
        ]
    )


def clean_dedup(run: Refresh) -> DataFrame:
    """Distinct rows of all tables with the number of raw rows each stands for."""
    return _union(
        [
            run.distinct(n).select(
                F.lit(n).alias("source_table"), *C.TABLES[n].source_columns, dedup.COPIES
            )
            for n in C.TABLES
        ]
    )


# --- refusal ----------------------------------------------------------------------


def _refused_for(*reasons: str) -> Callable[[Refresh], DataFrame]:
    """Refused rows with one of the reasons, from the tables that can have it."""

    def query(run: Refresh) -> DataFrame:
        parts = []
        for name, table in C.TABLES.items():
            possible = [reason for reason, _, _ in refuse.rules(table)] + [refuse.ORPHAN.get(name)]
            if set(possible) & set(reasons):
                parts.append(
                    run.judged(name)
                    .where(F.col(refuse.OUTCOME) == refuse.REJECTED)
                    .where(F.col(refuse.REASON).isin(*reasons))
                    .select(
                        F.lit(name).alias("source_table"),
                        F.col(table.key).alias("key"),
                        refuse.REASON,
                        refuse.DETAIL,
                        clean.UNPARSED,
                    )
                )
        return _union(parts)

    return query


def rejects_csv_roundtrip(run: Refresh) -> DataFrame:
    """The rejects, with hard texts among their unread ones, written as CSV and read back."""
    kind = F.length(refuse.DETAIL) % 4
    hard = (
        F.when(kind == 0, F.concat(F.lit('say "'), refuse.DETAIL, F.lit('",\n\\n\r next ')))
        .when(kind == 1, F.lit(" "))
        .when(kind == 2, F.lit(""))
    )
    path = f"{run.folder}/rejects.csv"
    rejects = run.rejects().withColumn(clean.UNPARSED, hard)
    if path not in _extracts:
        write_rejects_csv(rejects, path)
        _extracts.add(path)
    return read_rejects_csv(run.spark, path, rejects.schema)


def derive_delivery(run: Refresh) -> DataFrame:
    """Derived columns of every shipment that passed its own rules, orphans included."""
    return profiles.validated(run.judged("shipments")).select(
        "shipment_id",
        "expected_delivery_date",
        "actual_delivery_date",
        "delay_reason",
        "days_late",
        "on_time",
    )


# --- constraints and referential actions ------------------------------------------


def _unrefused(run: Refresh) -> dict[str, DataFrame]:
    """The tables as they would be loaded if no row were refused."""
    derived = {n: build() for n, build in refuse.DELIVERY.items()}
    return {
        name: run.distinct(name).withColumns(derived if name == "shipments" else {})
        for name in C.TABLES
    }


def contract_violations(run: Refresh) -> DataFrame:
    """The gate over the loaded tables, and over what it would see if no row were refused."""
    return _union(
        [
            gate.violations(tables).select(F.lit(population).alias("population"), "*")
            for population, tables in (("loaded", run.tables()), ("unrefused", _unrefused(run)))
        ]
    )


def violating_rows(run: Refresh) -> DataFrame:
    """Keys that break the contract if no row is refused."""
    return gate.violating_rows(_unrefused(run))


def publish_twice(run: Refresh) -> DataFrame:
    """Row counts of two versions published from the same source, and rows only one has."""
    root = f"{run.folder}/store"
    if root not in _extracts:
        publish(run.spark, run.raw, root)
        publish(run.spark, run.raw, root)
        _extracts.add(root)
    newer, older = Store(run.spark, root).folders()

    def stored(folder: str, name: str) -> DataFrame:
        whole = run.spark.read.schema(refuse.judged_schema(C.TABLES[name]))
        return loaded_part(name, whole.parquet(f"{folder}/{name}"))

    return _union(
        [
            _compared(run, f"{root}/compared/{n}", stored(older, n), stored(newer, n)).select(
                F.lit(n).alias("source_table"), "old", "new", "differing"
            )
            for n in C.TABLES
        ]
    )


def _compared(run: Refresh, path: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of either table, and rows that only one of them has, as one line.

    Equal rows (null equals null) meet in one group, with the number of copies either has. They
    are dealt to slices by their values; what one slice shuffles goes before the next.
    """
    both = old.select("*", F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select("*", F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    slice_of = F.pmod(F.xxhash64(*old.columns), F.lit(SLICES))
    for number in range(SLICES):
        if f"{path}/{number}" not in _extracts:
            alike = both.where(slice_of == number).groupBy(*old.columns)
            copies = alike.agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
            counts = copies.agg(
                F.sum("_old").alias("old"),
                F.sum("_new").alias("new"),
                F.sum(F.abs(F.col("_old") - F.col("_new"))).alias("differing"),
            )
            stage(run.spark, f"{path}/{number}", counts)
            _extracts.add(f"{path}/{number}")
    slices = run.spark.read.schema("old long, new long, differing long").parquet(
        *[f"{path}/{number}" for number in range(SLICES)]
    )
    return slices.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in slices.columns])


def restrict_delete(run: Refresh) -> DataFrame:
    """Which warehouses may be deleted, and how many orders hold each of the others."""
    sites, orders = run.loaded("warehouses"), run.loaded("orders")
    held = keys.children_of(sites, "warehouse_id", orders)
    return sites.join(held, "warehouse_id", "left").select(
        "warehouse_id",
        F.coalesce("children", F.lit(0)).alias("orders_held"),
        F.col("children").isNotNull().cast("int").alias("refused"),
    )


def restrict_delete_applied(run: Refresh) -> DataFrame:
    """Sites left by two deletes: of the sites without orders, and of all, which is refused whole."""
    sites, orders = run.loaded("warehouses"), run.loaded("orders")
    # Folded to the sites that have orders first: no task gets all orders of a site.
    free = sites.join(orders.select("warehouse_id").distinct(), "warehouse_id", "left_anti")
    left = []
    for attempt, doomed in (("without orders", free), ("all", sites)):
        try:
            kept, refused = keys.restrict_delete(sites, "warehouse_id", doomed, orders), 0
        except keys.RestrictedDelete:
            kept, refused = sites, 1
        left.append(
            kept.select(
                F.lit(attempt).alias("attempt"), F.lit(refused).alias("refused"), "warehouse_id"
            )
        )
    return _union(left)


def _marked(parent: DataFrame, column: str, child: DataFrame, child_key: str) -> DataFrame:
    return _union(
        [
            parent.select(F.lit("parent").alias("side"), F.col(column).alias("id"), column),
            child.select(F.lit("child").alias("side"), F.col(child_key).alias("id"), column),
        ]
    )


def cascade_delete(run: Refresh) -> DataFrame:
    """Keys left in orders and shipments after the orders of 1995 are deleted."""
    orders = run.loaded("orders")
    doomed = orders.where(F.year("order_date") == 1995)
    kept = keys.cascade_delete(orders, "order_id", doomed, run.loaded("shipments"))
    return _marked(kept[0], "order_id", kept[1], "shipment_id")


def cascade_update(run: Refresh) -> DataFrame:
    """Keys in all tables after Asia's warehouses and uncategorised orders get new ones."""
    tables = {n: run.loaded(n) for n in C.TABLES}
    new_sites = tables["warehouses"].where("region = 'Asia'").select(
        "warehouse_id", (F.col("warehouse_id") + 1000).alias("new_key")
    )
    new_orders = tables["orders"].where(F.col("product_category") == C.UNKNOWN_CATEGORY).select(
        "order_id", (-F.col("order_id")).alias("new_key")
    )
    tables = keys.cascade_update(tables, C.WAREHOUSES, new_sites)
    tables = keys.cascade_update(tables, C.ORDERS, new_orders)
    wanted = ("warehouse_id", "order_id", "shipment_id")
    return _union(
        [
            frame.select(F.lit(name).alias("source_table"), *[c for c in wanted if c in frame.columns])
            for name, frame in tables.items()
        ]
    )


def loaded(name: str) -> Callable[[Refresh], DataFrame]:
    return lambda run: run.loaded(name).select(*C.TABLES[name].columns)


def dates_as_text(run: Refresh) -> DataFrame:
    """Loaded shipments with ISO text dates, the encoding of a text sink."""
    days = [f.name for f in C.SHIPMENTS.of_kind(C.DATE)]
    return run.loaded("shipments").select(
        "shipment_id", *[F.date_format(d, "yyyy-MM-dd").alias(d) for d in days]
    )


def _over_tables(build: Callable[[reports.Tables], DataFrame]) -> Callable[[Refresh], DataFrame]:
    return lambda run: build(run.tables())


def _counted_reading(
    build: Callable[[SparkSession, dict[str, Counts]], DataFrame],
) -> Callable[[Refresh], DataFrame]:
    return lambda run: build(run.spark, {n: run.counts_read(n) for n in C.TABLES})


QUERIES: dict[str, Callable[[Refresh], DataFrame]] = {
    **{f"extract_{name}": extract(name) for name in C.TABLES},
    "reject_malformed": reject_malformed,
    "source_order": source_order,
    "extract_line_breaks": extract_line_breaks,
    "clean_dates": clean_dates,
    "clean_text": clean_text,
    "clean_carrier": clean_carrier,
    "clean_numbers": clean_numbers,
    "clean_fill": clean_fill,
    "clean_dedup": clean_dedup,
    "date_format_profile": _counted_reading(profiles.date_format_profile),
    "unmapped_carriers": lambda run: profiles.unmapped_carriers(run.raw["shipments"].frame),
    "mess_profile": _counted_reading(profiles.mess_profile),
    "reject_numeric": _refused_for(C.BAD_NUMBER),
    "reject_pk": _refused_for(C.KEY_CONFLICT),
    "reject_required_date": _refused_for(C.MISSING_DATE),
    "reject_actual_before_ship": _refused_for(C.ACTUAL_BEFORE_SHIP),
    "reject_quantity": _refused_for(C.QUANTITY_NOT_POSITIVE),
    "reject_expected_before_ship": _refused_for(C.EXPECTED_BEFORE_SHIP),
    "reject_orphan_order": _refused_for(C.ORPHAN_ORDER),
    "reject_orphan_shipment": _refused_for(C.ORPHAN_SHIPMENT),
    "rejects_all": lambda run: run.rejects(),
    "rejects_csv_roundtrip": rejects_csv_roundtrip,
    "rejects_summary": lambda run: refuse.rejects_summary(run.rejects()),
    "stage_counts": lambda run: profiles.stage_counts(run.spark, {n: run.counts(n) for n in C.TABLES}),
    "derive_delivery": derive_delivery,
    "delivery_split": lambda run: profiles.delivery_split(run.judged("shipments")),
    "loaded_warehouses": loaded("warehouses"),
    "loaded_orders": loaded("orders"),
    "loaded_shipments": loaded("shipments"),
    "dates_as_text": dates_as_text,
    "load_counts": lambda run: row_counts(run.tables()),
    "fk_check": lambda run: gate.foreign_key_violations(run.tables()),
    "contract_violations": contract_violations,
    "violating_rows": violating_rows,
    "publish_twice": publish_twice,
    "restrict_delete": restrict_delete,
    "restrict_delete_applied": restrict_delete_applied,
    "cascade_delete": cascade_delete,
    "cascade_update": cascade_update,
    **{name: _over_tables(report.build) for name, report in reports.REPORTS.items()},
    "monthly_trend_by_order": _over_tables(reports.monthly_trend_by_order),
    "orders_per_month": _over_tables(profiles.orders_per_month),
    "delivery_totals": _over_tables(profiles.delivery_totals),
    "late_rate_by_carrier": _over_tables(profiles.late_rate_by_carrier),
    "late_rate_by_warehouse": _over_tables(profiles.late_rate_by_warehouse),
    "delay_reason_share": _over_tables(profiles.delay_reason_share),
    "delay_reason_by_warehouse": _over_tables(profiles.delay_reason_by_warehouse),
    "warehouse_vs_network": _over_tables(profiles.warehouse_vs_network),
    "trailing_month": _over_tables(profiles.trailing_month),
    "delay_reason_chart": _over_tables(profiles.delay_reason_chart),
}


def named(name: str) -> Query:
    return lambda spark, sf_dir: QUERIES[name](refresh_of(spark, sf_dir))
