"""Star schema: staging view, product and date dimensions, fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions.events import date_id


def staged_events(log: DataFrame) -> DataFrame:
    """Staging projection of the lake/log with the ``date_id`` text key."""
    return log.select(
        "event_id",
        "product_id",
        "event_type",
        "quantity",
        "created_at",
        "organization_id",
        date_id("created_at").alias("date_id"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "sku", "created_at", "organization_id")


def _calendar(spine: DataFrame) -> DataFrame:
    d = F.col("d")
    return spine.select(
        F.date_format(d, "yyyy-MM-dd").alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_dates(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """Inclusive calendar spine between two fixed dates (the reference's defaults)."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"), F.to_date(F.lit(end)).alias("hi"))
    return dim_dates_between(bounds)


def dim_dates_between(bounds: DataFrame) -> DataFrame:
    """S11 over data-driven bounds: ``bounds`` is a one-row frame with dates ``lo`` and ``hi``.

    The spine is generated by ``explode(sequence(...))`` on the executor that holds the row;
    its size is the number of days in the range (thousands), not the data volume.
    """
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return _calendar(spine)


def fact_inventory_events(staged: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Inner equi-join on ``(product_id, organization_id)``.

    Events without a product, or with a NULL org (legacy files), drop out. The product
    dimension grows with the catalogue, so no unconditional broadcast hint: AQE turns the
    sort-merge join into a broadcast join at runtime when the measured side fits
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    # Products are unique on (product_id, organization_id), so the inner join keeps exactly the
    # events that have a product: a semi join says that and carries no build-side columns.
    keys = dim_prod.select("product_id", "organization_id")
    return staged.join(keys, ["product_id", "organization_id"], "left_semi").select(
        "event_id", "product_id", "date_id", "event_type", "quantity", "created_at", "organization_id"
    )


def org_backfill(child: DataFrame, parent: DataFrame, key: str, parent_org: str = "organization_id") -> DataFrame:
    """Fill a child's NULL ``organization_id`` from its parent row; NULL quantity -> 0."""
    p = parent.select(F.col(key), F.col(parent_org).alias("_parent_org"))
    out = child.join(p, key, "left").withColumn(
        "organization_id", F.coalesce(F.col("organization_id"), F.col("_parent_org"))
    )
    if "quantity" in child.columns:
        out = out.withColumn("quantity", F.coalesce(F.col("quantity"), F.lit(0)))
    return out.drop("_parent_org")


def event_id_backfill(log: DataFrame) -> DataFrame:
    """V3: rows from before idempotency have no event id; theirs becomes ``backfill_`` and the row id."""
    made = F.concat(F.lit("backfill_"), F.col("id").cast("string"))
    return log.withColumn("event_id", F.coalesce(F.col("event_id"), made))
