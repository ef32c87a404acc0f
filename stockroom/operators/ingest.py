"""Batch ingest: validate rows, resolve SKUs, apply with idempotency and the oversell guard
(P10, P11, J2, W4, O4, A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.operators import ledger
from stockroom.session import materialize

_INT_TEXT = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"


def parsed_quantity(text: Column) -> Column:
    """Integer reading of a quantity text (``' 3 '`` and ``'2.0'`` are integers; ``'1.5'`` is not)."""
    return F.when(text.rlike(_INT_TEXT), F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("long"))


def row_error(sku: Column, event_type: Column, quantity: Column, event_id: Column) -> Column:
    """The first failing field, in the order sku, event_type, quantity, event_id."""
    q = parsed_quantity(quantity)

    def text_rule(c: Column, field: str, short: str, long: str) -> Column:
        return (
            F.when(c.isNull(), F.lit(S.MSG_FIELD_MISSING_STR.format(field=field)))
            .when(F.length(c) < 1, F.lit(short))
            .when(F.length(c) > S.MAX_TEXT_LEN, F.lit(long))
        )

    return F.coalesce(
        text_rule(sku, "sku", S.MSG_FIELD_SKU, S.MSG_FIELD_SKU_LONG),
        F.when(event_type.isNull() | ~event_type.isin(*S.EVENT_TYPES), F.lit(S.MSG_FIELD_TYPE)),
        F.when(quantity.isNull(), F.lit(S.MSG_FIELD_QTY_MISSING))
        .when(q.isNull(), F.lit(S.MSG_FIELD_QTY_INT))
        .when(q == 0, F.lit(S.MSG_FIELD_QTY_ZERO)),
        text_rule(event_id, "event_id", S.MSG_FIELD_EVENT_ID, S.MSG_FIELD_EVENT_ID_LONG),
    )


def validate(rows: DataFrame) -> DataFrame:
    """Adds ``error`` (NULL when the row is well formed) and the integer ``quantity_value``."""
    c = F.col
    return rows.withColumn("error", row_error(c("sku"), c("event_type"), c("quantity"), c("event_id"))).withColumn(
        "quantity_value", parsed_quantity(c("quantity"))
    )


def resolve_sku(rows: DataFrame, products: DataFrame) -> DataFrame:
    """``(org, sku) -> product_id``; a miss becomes the row's error."""
    p = products.select("organization_id", "sku", "product_id")
    j = rows.join(p, ["organization_id", "sku"], "left")
    miss = F.concat(F.lit("Product with SKU '"), F.col("sku"), F.lit("' not found"))
    return j.withColumn(
        "error", F.coalesce(F.col("error"), F.when(F.col("product_id").isNull(), miss))
    )


def ingest(
    rows: DataFrame,
    products: DataFrame,
    log: DataFrame | None = None,
    recipe_items: DataFrame | None = None,
    start_state: DataFrame | None = None,
) -> DataFrame:
    """Per-row results ``(organization_id, row_number, event_id, status, error)`` plus the
    fold columns needed downstream (``applied``, ``delta``, ``product_id``).

    ``rows``: organization_id, row_number (1-based arrival order), sku, event_type, quantity
    (text), event_id (text). Rows failing validation or SKU lookup never reach the fold.
    """
    checked = check_rows(rows, products)
    folded = apply_checked(checked, log, recipe_items, start_state)
    return row_results(checked, folded), folded


def check_rows(rows: DataFrame, products: DataFrame) -> DataFrame:
    """The validated batch. It feeds the fold, the failures and the result assembly: written once."""
    return materialize(resolve_sku(validate(rows), products), "ingest-checked")


def apply_checked(checked: DataFrame, log: DataFrame | None, recipe_items: DataFrame | None, start_state: DataFrame | None) -> DataFrame:
    """Fold rows of the well-formed rows of a checked batch."""
    good = checked.filter(F.col("error").isNull()).select(
        "organization_id",
        "product_id",
        "event_id",
        "event_type",
        F.col("quantity_value").alias("quantity"),
        F.col("row_number").alias("seq"),
    )
    log_ids = None if log is None else log.select(*ledger.KEY)
    return ledger.apply_batch(good, log_ids=log_ids, start_state=start_state, recipe_items=recipe_items)


def row_results(checked: DataFrame, folded: DataFrame) -> DataFrame:
    """(organization_id, row_number, event_id, status, error) for every row of a batch. Leader rows
    (pos 0) of the fold are the batch rows that reached it; they carry the raw id."""
    ok = folded.filter(F.col("pos") == 0).select(
        "organization_id", F.col("seq").alias("row_number"), "event_id", "status", "error"
    )
    bad = checked.filter(F.col("error").isNotNull()).select(
        "organization_id", "row_number", "event_id", F.lit("failed").alias("status"), "error"
    )
    return bad.unionByName(ok)


def summary(results: DataFrame) -> DataFrame:
    """Rows processed / succeeded / failed per batch (org)."""
    return results.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("status") == "success").alias("rows_succeeded"),
        F.count_if(F.col("status") == "failed").alias("rows_failed"),
    )
