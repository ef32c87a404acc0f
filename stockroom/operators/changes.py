"""Change batches applied to snapshot tables (C1-C4): ``apply -> (snapshot', results)``.

A whole batch of requests is judged with joins against the snapshot and a ``when`` chain of refusal
reasons in check order; requests for one key take effect in ``change_id`` order. New rows get
``max(id) + change_id`` (a scalar subquery, no global numbering pass).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.session import materialize


def _first_wins(changes: DataFrame, key: list[str], where: Column | None = None) -> DataFrame:
    """``_first``: whether a request is the earliest (by ``change_id``) of its key. An
    aggregation joined back, so a key repeated on very many requests is not one task."""
    cand = changes if where is None else changes.filter(where)
    first = cand.groupBy(*key).agg(F.min("change_id").alias("_first_id"))
    out = changes.join(first, key, "left")
    return out.withColumn("_first", F.coalesce(F.col("change_id") == F.col("_first_id"), F.lit(True))).drop("_first_id")


def _results(judged: DataFrame, ok_status: str, *cols: str) -> DataFrame:
    return judged.select(
        *cols,
        F.when(F.col("error").isNull(), F.lit(ok_status)).otherwise(F.lit("rejected")).alias("status"),
        "error",
    )


def _text_rule(field: str, most: int, needed: bool = True) -> Column:
    """The first fault of a text field: absent (if needed), empty (if needed) or too long."""
    c = F.col(field)
    long = F.when(F.length(c) > most, F.lit(S.MSG_FIELD_TEXT_LONG.format(field=field, most=most)))
    if not needed:
        return long
    return F.coalesce(
        F.when(c.isNull(), F.lit(S.MSG_FIELD_MISSING_STR.format(field=field))), F.when(F.length(c) < 1, F.lit(S.MSG_FIELD_TEXT_SHORT.format(field=field))), long
    )


def product_inserts(snapshot: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert products; texts of a wrong length are refused (name, sku, unit, in this order), and
    so is a duplicate ``(org, sku)`` (existing, or earlier in the batch). ``changes``: change_id, organization_id, sku, name, unit."""
    existing = snapshot.select("organization_id", "sku").distinct().withColumn("_exists", F.lit(True))
    malformed = F.coalesce(_text_rule("name", 255), _text_rule("sku", S.MAX_TEXT_LEN), _text_rule("unit", 20, needed=False))
    changes = changes.withColumn("_malformed", malformed)
    first = _first_wins(changes, ["organization_id", "sku"], F.col("_malformed").isNull())
    j = first.join(existing, ["organization_id", "sku"], "left")
    err = F.coalesce(
        F.col("_malformed"),
        F.when(F.col("_exists").isNotNull() | ~F.col("_first"), F.concat(F.lit(S.MSG_DUPLICATE_SKU), F.col("sku"))),
    )
    judged = j.withColumn("error", err)
    max_id = snapshot.agg(F.max("product_id")).scalar()
    new_rows = judged.filter(F.col("error").isNull()).select(
        (F.col("change_id") + max_id).alias("product_id"),
        "organization_id",
        "name",
        "sku",
        "unit",
        F.current_timestamp().alias("created_at"),
    )
    snap = snapshot.unionByName(new_rows, allowMissingColumns=True)
    return snap, _results(judged, "inserted", "change_id", "organization_id", "sku")


def supplier_inserts(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Suppliers have no uniqueness rule: the new snapshot is the union."""
    max_id = snapshot.agg(F.max("supplier_id")).scalar()
    new_rows = changes.select((F.col("change_id") + max_id).alias("supplier_id"), "organization_id", "name")
    return snapshot.select("supplier_id", "organization_id", "name").unionByName(new_rows)


def _recipe_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Requests of a partition, sorted by pair and change id: which of them hold, and the pair's
    live item after each. The state is one pair's item, whatever the number of its requests."""
    pair, live, quantity = None, None, None
    for batch in batches:
        out = []
        columns = ("organization_id", "finished_product_id", "component_product_id", "op", "item", "quantity", "held_item", "held_quantity")
        for org, dish, part, op, item, wanted, held, held_quantity in zip(*(batch[c].tolist() for c in columns)):
            if pair != (org, dish, part):
                pair = (org, dish, part)
                live, quantity = (None, None) if pd.isna(held) else (int(held), int(held_quantity))
            holds = live is None if op == "insert" else live == item
            if holds:
                live, quantity = (None, None) if op == "delete" else (int(item), int(wanted))
            out.append((holds, live, quantity))
        result = batch[["organization_id", "finished_product_id", "component_product_id", "change_id"]].copy()
        result["holds"] = [r[0] for r in out]
        result["live_item"] = pd.array([r[1] for r in out], dtype="Int64")
        result["live_quantity"] = pd.array([r[2] for r in out], dtype="Int32")
        yield result


RECIPE_FOLD = (
    "organization_id int, finished_product_id long, component_product_id long, change_id long, holds boolean, "
    "live_item long, live_quantity int"
)


def recipe_changes(snapshot: DataFrame, products: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert / update / delete recipe items, judged one after another in ``change_id`` order.

    ``changes``: change_id, organization_id, op, recipe_item_id (update/delete),
    finished_product_id, component_product_id (insert), quantity (insert/update).
    Checks, in order: quantity > 0; self reference; unknown dish; unknown component; duplicate
    pair; unknown item id. A request refused by the first four leaves no trace; the last two depend
    on what earlier requests of the same pair did, so those are folded per pair, in order. A new
    item's id is the largest old one plus its change id, and later requests may name it.
    """
    pair = ["organization_id", "finished_product_id", "component_product_id"]
    prods = products.select("organization_id", "product_id").distinct()
    dish = prods.select("organization_id", F.col("product_id").alias("finished_product_id"), F.lit(True).alias("_dish"))
    comp = prods.select("organization_id", F.col("product_id").alias("component_product_id"), F.lit(True).alias("_comp"))
    max_id = F.coalesce(snapshot.agg(F.max("recipe_item_id")).scalar(), F.lit(0))
    ins = F.col("op") == "insert"
    j = changes.join(dish, ["organization_id", "finished_product_id"], "left").join(comp, ["organization_id", "component_product_id"], "left")
    missing = F.when(F.col("_dish").isNull(), F.col("finished_product_id")).otherwise(F.col("component_product_id"))
    refused = (
        F.when((F.col("op") != "delete") & (F.col("quantity") <= 0), F.lit("quantity: Input should be greater than 0"))
        .when(ins & (F.col("finished_product_id") == F.col("component_product_id")), F.lit(S.MSG_SELF_RECIPE))
        .when(ins & (F.col("_dish").isNull() | F.col("_comp").isNull()), F.concat(F.lit("Product "), missing.cast("string"), F.lit(" not found")))
    )
    item = F.when(ins, F.col("change_id") + max_id).otherwise(F.col("recipe_item_id"))
    j = materialize(j.withColumn("refused", refused).withColumn("item", item).drop("_dish", "_comp"), "recipe-requests")
    held = snapshot.select(*pair, F.col("recipe_item_id").alias("held_item"), F.col("quantity").alias("held_quantity"))
    born = j.where(ins & F.col("refused").isNull()).select(*pair, "item")
    ids = held.select(*pair, F.col("held_item").alias("item")).unionByName(born)
    owner = ids.select("organization_id", "item", *[F.col(c).alias(f"_{c}") for c in pair[1:]])
    named = j.where(F.col("refused").isNull()).join(owner, ["organization_id", "item"], "left")
    named = named.select("organization_id", *[F.col(f"_{c}").alias(c) for c in pair[1:]], "change_id", "op", "item", "quantity")
    asked = named.where("finished_product_id is not null").join(held, pair, "left")
    folded = materialize(asked.repartition(*pair).sortWithinPartitions(*pair, "change_id").mapInPandas(_recipe_fold, RECIPE_FOLD), "recipe-fold")
    dup_text = F.format_string(
        "Recipe item already exists for finished product %d and component product %d", F.col("finished_product_id"), F.col("component_product_id")
    )
    judged = j.join(folded.select("organization_id", "change_id", "holds"), ["organization_id", "change_id"], "left")
    late = F.when(F.coalesce("holds", F.lit(False)), None).when(ins, dup_text).otherwise(F.format_string("Recipe item %d not found", F.col("recipe_item_id")))
    judged = judged.withColumn("error", F.coalesce("refused", late))
    last = folded.groupBy(*pair).agg(F.max_by(F.struct("live_item", "live_quantity"), "change_id").alias("end"))
    kept = snapshot.join(last.select(*pair), pair, "left_anti")
    fresh = last.where("end.live_item is not null").select(
        F.col("end.live_item").alias("recipe_item_id"), "finished_product_id", "component_product_id", F.col("end.live_quantity").alias("quantity"), "organization_id"
    )
    snap = kept.select(*snapshot.columns).unionByName(fresh)
    return snap, _results(judged, "applied", "change_id", "organization_id", "op")


PO_ACTION = {"insert": "add a line to", "update": "edit a line on", "delete": "remove a line from"}


def po_line_changes(orders: DataFrame, lines: DataFrame, products: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C4: PO line insert / update / delete, only while the PO is DRAFT, in ``change_id`` order.

    ``changes``: change_id, organization_id, op, purchase_order_id (insert), line_id
    (update/delete), product_id (insert), quantity and unit_cost (insert/update; without a
    unit_cost column costs stay as they are). A new line's id is the largest old one plus its
    change id, and later requests may name it. A line lives from its insert to its first accepted
    delete, and its last accepted update holds: grouped minima and maxima per line, no order of
    requests has to be gathered.
    """
    costs = "unit_cost" in changes.columns
    cost = F.col("unit_cost") if costs else F.lit(None)
    ch = changes.withColumn("unit_cost", cost.cast("decimal(10,2)"))
    max_id = F.coalesce(lines.agg(F.max("line_id")).scalar(), F.lit(0))
    po = orders.select("organization_id", F.col("purchase_order_id").alias("_po"), F.col("status").alias("_status"))
    prods = products.select("organization_id", "product_id").distinct().withColumn("_prod", F.lit(True))
    bad_quantity = F.when((F.col("op") != "delete") & (F.col("quantity") <= 0), F.lit("quantity: Input should be greater than 0"))
    action = F.when(F.col("op") == "insert", PO_ACTION["insert"]).when(F.col("op") == "update", PO_ACTION["update"]).otherwise(
        PO_ACTION["delete"]
    )
    no_order = F.when(F.col("_status").isNull(), F.format_string("Purchase order %d not found", F.col("_po"))).when(
        F.col("_status") != "DRAFT",
        F.format_string("Cannot %s purchase order %d in status %s", action, F.col("_po"), F.col("_status")),
    )
    inserts = ch.where("op = 'insert'").withColumn("_po", F.col("purchase_order_id")).join(po, ["organization_id", "_po"], "left")
    inserts = inserts.join(prods, ["organization_id", "product_id"], "left").withColumn(
        "error", F.coalesce(bad_quantity, no_order, F.when(F.col("_prod").isNull(), F.format_string("Product %d not found", F.col("product_id"))))
    )
    born = inserts.where("error is null").select(
        (F.col("change_id") + max_id).alias("line_id"),
        F.col("_po").alias("purchase_order_id"),
        "product_id",
        F.col("quantity").cast("int"),
        "unit_cost",
        "organization_id",
        F.col("change_id").alias("_from"),
    )
    alive = materialize(lines.withColumn("_from", F.lit(None).cast("long")).unionByName(born, allowMissingColumns=True), "po-lines-all")
    spot = alive.select("organization_id", "line_id", F.col("purchase_order_id").alias("_line_po"), "_from")
    edits = ch.where("op <> 'insert'").join(spot, ["organization_id", "line_id"], "left")
    there = F.col("_line_po").isNotNull() & (F.col("_from").isNull() | (F.col("change_id") > F.col("_from")))
    no_line = F.format_string("Purchase order line %d not found", F.col("line_id"))
    edits = edits.withColumn("_po", F.coalesce("_line_po", "purchase_order_id")).join(po, ["organization_id", "_po"], "left")
    edits = edits.withColumn("error", F.coalesce(bad_quantity, F.when(~there, no_line), no_order))
    # only lines of DRAFT orders change: few rows, and no request has to be sent by its order to find them
    draft = spot.join(po.where("_status = 'DRAFT'").select("organization_id", F.col("_po").alias("_line_po")), ["organization_id", "_line_po"])
    draft = materialize(draft.select("organization_id", "line_id", "_line_po", "_from"), "po-lines-draft")
    sound = ch.where("op in ('update', 'delete')").where(bad_quantity.isNull()).join(draft, ["organization_id", "line_id"]).where(there)
    deletes = sound.where("op = 'delete'").groupBy("organization_id", "line_id").agg(F.min("change_id").alias("_until"))
    edits = edits.join(deletes, ["organization_id", "line_id"], "left").withColumn(
        "error", F.coalesce("error", F.when(F.col("change_id") > F.col("_until"), no_line))
    )
    live = sound.where("op = 'update'").join(deletes, ["organization_id", "line_id"], "left").where(~F.coalesce(F.col("change_id") > F.col("_until"), F.lit(False)))
    updates = live.groupBy("organization_id", "line_id").agg(F.max_by(F.struct("quantity", "unit_cost"), "change_id").alias("_new"))
    kept = alive.join(deletes, ["organization_id", "line_id"], "left_anti").join(updates, ["organization_id", "line_id"], "left")
    kept = kept.withColumn("quantity", F.coalesce(F.col("_new.quantity"), F.col("quantity")).cast("int"))
    if costs:
        kept = kept.withColumn("unit_cost", F.when(F.col("_new").isNotNull(), F.col("_new.unit_cost")).otherwise(F.col("unit_cost")))
    result = ["change_id", "organization_id", "op", "purchase_order_id", "error"]
    judged = inserts.withColumn("purchase_order_id", F.col("_po")).select(*result).unionByName(
        edits.withColumn("purchase_order_id", F.col("_po")).select(*result)
    )
    return kept.select(*lines.columns), _results(judged, "applied", *result[:-1])
