"""Domain tables derived from the driver tables (see FIXTURES.md, part 2).

Every adapter is a narrow projection over one scan (plus a join for PO lines), so work
grows with the input tables and nothing is materialised. The same definitions exist as SQL
text in ``stockroom.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions.events import signed_quantity, valid_signed_event
from stockroom.sources.tables import read_table, spread


def _org_of(key: Column) -> Column:
    return (key % 5 + 1).cast("int")


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return r.select(
        (F.col("r_regionkey") + 1).cast("int").alias("organization_id"),
        F.col("r_name").alias("name"),
        (F.col("r_regionkey") != 4).alias("is_active"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        _org_of(F.col("p_partkey")).alias("organization_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_type").alias("unit"),
        F.lit("2020-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("supplier_id"),
        _org_of(F.col("s_suppkey")).alias("organization_id"),
        F.col("s_name").alias("name"),
    )


def raw_events_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inventory_events_e``: one row per driver ``events`` row, quantity still unsigned."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    mapped = (
        F.when(et == "signup", "PURCHASE")
        .when(et == "purchase", "SALE")
        .when(et == "view", "RETURN")
        .when(et == "click", "ADJUSTMENT")
        .otherwise(F.when(F.col("event_id") % 2 == 0, "DAMAGE").otherwise("WASTE"))
    )
    sign = F.when((et == "click") & (F.col("event_id") % 2 == 1), -1).otherwise(1)
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("user_id").alias("product_id"),
        _org_of(F.col("user_id")).alias("organization_id"),
        mapped.alias("event_type"),
        (F.ceil("value").cast("int") * sign).alias("raw_quantity"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def raw_events_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inventory_events_l``: lineitem as events, with repeated ids and zero quantities."""
    li = read_table(spark, sf_dir, "lineitem")
    ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    mapped = (
        F.when(ls == "F", F.when(ln == 7, "RETURN").otherwise("PURCHASE"))
        .when(rf == "R", "ADJUSTMENT")
        .when(rf == "A", "SALE")
        .when(ln % 3 == 0, "DAMAGE")
        .when(ln % 3 == 1, "WASTE")
        .otherwise("SALE")
    )
    qty = F.col("l_quantity").cast("int")
    raw = F.when((ls == "O") & (rf == "R"), -(qty % 7)).otherwise(qty)
    return li.select(
        F.concat(
            F.lit("li-"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")
        ).alias("event_id"),
        F.col("l_partkey").alias("product_id"),
        _org_of(F.col("l_partkey")).alias("organization_id"),
        mapped.alias("event_type"),
        raw.alias("raw_quantity"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").alias("price"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log (S1 shape, 7 columns) built from ``events``.

    Only rows that pass the sign rule are in a log; the stored quantity is the signed delta.
    """
    raw = raw_events_e(spark, sf_dir)
    return raw.filter(valid_signed_event("event_type", "raw_quantity")).select(
        "id",
        "event_id",
        "product_id",
        "event_type",
        signed_quantity("event_type", "raw_quantity").alias("quantity"),
        "created_at",
        "organization_id",
    )


def event_log_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger, sparse log built from ``lineitem`` (ids repeat; no serial id column)."""
    raw = raw_events_l(spark, sf_dir)
    return raw.filter(valid_signed_event("event_type", "raw_quantity")).select(
        "event_id",
        "product_id",
        "event_type",
        signed_quantity("event_type", "raw_quantity").alias("quantity"),
        "created_at",
        "organization_id",
        "supplier_id",
        "price",
    )


def ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV-shaped rows (all strings) with planted faults, one batch per organization."""
    e = read_table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    sku = F.when(eid % 97 == 0, F.lit("SKU-unknown")).otherwise(
        F.concat(F.lit("SKU-"), F.col("user_id").cast("string"))
    )
    etype = (
        F.when(eid % 89 == 0, "NOPE")
        .when(et.isin("signup", "view", "click"), "PURCHASE")
        .when(et == "purchase", "SALE")
        .otherwise("WASTE")
    )
    qty = (
        F.when(eid % 83 == 0, "0")
        .when(eid % 79 == 0, "-3")
        .when(eid % 73 == 0, "x")
        .otherwise(F.ceil("value").cast("int").cast("string"))
    )
    repeat = F.when((eid > 0) & (eid % 101 == 0), 1).otherwise(0)
    return e.select(
        (eid + 1).alias("row_number"),
        sku.alias("sku"),
        etype.alias("event_type"),
        qty.alias("quantity"),
        F.concat(F.lit("in-"), (eid - repeat).cast("string")).alias("event_id"),
        _org_of(F.col("user_id")).alias("organization_id"),
    )


def recipe_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-level BOM: groups of six products, components may be shared by two dishes.

    Each dish row fans out to its (at most three) recipe slots with ``explode`` of a fixed
    array: a generator over the scan, no join.
    """
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    p = p.filter(F.col("p_partkey") % 25 < 5)
    k, pk = F.col("k"), F.col("p_partkey")
    rows = p.select("p_partkey", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")).filter(
        (k < 3) | (pk % 50 >= 25)
    )
    offset = F.when(k == 1, 5).when(k == 2, 10).otherwise(-15)
    qty = F.when(k == 1, (pk % 3 + 1).cast("int")).when(k == 2, 2).otherwise(1).cast("int")
    return rows.select(
        (pk * 10 + k).alias("recipe_item_id"),
        pk.alias("finished_product_id"),
        (pk + offset).alias("component_product_id"),
        qty.alias("quantity"),
        _org_of(pk).alias("organization_id"),
    )


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("purchase_order_id"),
        (F.col("o_custkey") % 10).alias("supplier_id"),
        _org_of(F.col("o_custkey")).alias("organization_id"),
        F.when(st == "F", "RECEIVED").when(st == "O", "SUBMITTED").otherwise("DRAFT").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def purchase_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PO lines: product moved into the PO's org; repeated line numbers collapsed.

    lineitem and orders are both fact-sized, so this is a shuffle join on the order key
    followed by an aggregation on the same key (Spark reuses the partitioning). The number of
    partitions follows the rows (a count from the file footers), and joins on the order keep it.
    """
    table = read_table(spark, sf_dir, "lineitem")
    li = spread(table.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"), table.count(), "l_orderkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.col("l_partkey") - F.col("l_partkey") % 5 + F.col("o_custkey") % 5).alias("product_id"),
        F.max("l_quantity").cast("int").alias("quantity"),
        F.floor(F.min(F.col("l_extendedprice") / F.col("l_quantity"))).cast("decimal(10,2)").alias("unit_cost"),
        F.min(F.col("o_custkey") % 5 + 1).cast("int").alias("organization_id"),
    ).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.col("l_orderkey").alias("purchase_order_id"),
        "product_id",
        "quantity",
        "unit_cost",
        "organization_id",
    )
