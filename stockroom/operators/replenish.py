"""Recipes, restock decisions, fleet status and purchase-order flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.sources.tables import spread


def recipe_list(items: DataFrame, products: DataFrame) -> DataFrame:
    """P16 for every dish at once: items of known dishes ordered by item id, with component labels."""
    p = products.select("product_id", "organization_id", "name", "sku")
    dishes = p.select(F.col("product_id").alias("finished_product_id"), "organization_id")
    comps = p.select(
        F.col("product_id").alias("component_product_id"),
        "organization_id",
        F.col("name").alias("component_name"),
        F.col("sku").alias("component_sku"),
    )
    known = items.join(dishes, ["finished_product_id", "organization_id"], "left_semi")
    return (
        known.join(comps, ["component_product_id", "organization_id"], "left")
        .select(
            "recipe_item_id",
            "finished_product_id",
            "component_product_id",
            "quantity",
            "organization_id",
            "component_name",
            "component_sku",
        )
        .orderBy("finished_product_id", "recipe_item_id")
    )


def recipe_lookup(asked: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """P16 for a batch of asked dishes (organization_id, product_id): the items of each with labels, or
    one row with the error of a dish that the organization does not have. A known dish without a
    recipe has no row."""
    key = ["organization_id", "finished_product_id"]
    dishes = asked.select("organization_id", F.col("product_id").alias("finished_product_id")).distinct()
    known = products.select("organization_id", F.col("product_id").alias("finished_product_id"))
    listed = recipe_list(items, products).join(dishes, key, "left_semi").withColumn("error", F.lit(None).cast("string"))
    unknown = dishes.join(known, key, "left_anti")
    text = F.concat(F.lit("Product "), F.coalesce(F.col("finished_product_id").cast("string"), F.lit("null")), F.lit(" not found"))
    return listed.unionByName(unknown.withColumn("error", text), allowMissingColumns=True)


SERIES = ["organization_id", "product_id"]


def restock(stock: DataFrame, demand: DataFrame) -> DataFrame:
    """R1 for every product with a forecast: safety stock, order quantity, days of stock and
    the urgency ladder (stockout is tested first, on ``== 0``). Rounding is half-even."""
    cur = F.coalesce(F.col("quantity"), F.lit(0)).cast("long")
    d = F.greatest(F.lit(0.0), F.col("projected_demand"))
    j = demand.join(stock.select(*SERIES, "quantity"), SERIES, "left").select(*SERIES, cur.alias("current"), d.alias("d"))
    safety = F.bround(F.col("d") * S.SAFETY_FRACTION, 0)
    order = F.greatest(F.lit(0.0), F.bround(F.col("d") + F.col("safety") - F.col("current"), 0))
    daily = F.col("d") / S.HORIZON_DAYS
    days = F.when(daily > 0, F.bround(F.col("current") / daily, 0)).otherwise(F.lit(float(S.NO_DEMAND_DAYS)))
    j = j.withColumn("safety", safety).withColumn("days", days)
    urgency = (
        F.when(F.col("current") == 0, "STOCKOUT")
        .when(F.col("days") < 4, "URGENT")
        .when(F.col("days") < 7, "LOW")
        .otherwise("OK")
    )
    return j.select(
        *SERIES,
        F.col("current").alias("current_inventory"),
        F.bround("d", 1).alias("projected_demand_7d"),
        F.col("safety").cast("long").alias("safety_stock"),
        order.cast("long").alias("recommended_order_qty"),
        F.col("days").cast("long").alias("days_of_stock_remaining"),
        urgency.alias("urgency"),
    )


def fleet_status(products: DataFrame, stock: DataFrame, restock_rows: DataFrame) -> DataFrame:
    """Every product of the org with its stock and restock row; products without a
    model keep their real stock and get NO_FORECAST. Two left joins, no per-product loop."""
    p = products.select(*SERIES, "name", "sku")
    s = stock.select(*SERIES, F.col("quantity").alias("_stock"))
    r = restock_rows.drop("current_inventory")
    j = p.join(s, SERIES, "left").join(r, SERIES, "left")
    return j.select(
        *SERIES,
        "name",
        "sku",
        F.coalesce("_stock", F.lit(0)).cast("long").alias("current_inventory"),
        "projected_demand_7d",
        "safety_stock",
        "recommended_order_qty",
        "days_of_stock_remaining",
        F.coalesce("urgency", F.lit("NO_FORECAST")).alias("urgency"),
    )


def fleet_urgent(fleet: DataFrame, levels: tuple[str, ...] = ("STOCKOUT", "URGENT")) -> DataFrame:
    """The rows a dashboard filter shows for the chosen urgency levels."""
    return fleet.filter(F.col("urgency").isin(*levels))


def fleet_kpis(fleet: DataFrame) -> DataFrame:
    """Per org KPIs plus a count for every urgency level, zeros included: one
    aggregation with a conditional count per level of the fixed list (no join to a level
    table, no pivot pass)."""
    u = F.col("urgency")
    return fleet.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("current_inventory").cast("long").alias("total_inventory"),
        F.count_if(u == "STOCKOUT").alias("stockouts"),
        F.count_if(u.isin("URGENT", "LOW")).alias("urgent_or_low"),
        *[F.count_if(u == level).alias(f"count_{level.lower()}") for level in S.URGENCY_LEVELS],
    )


# ---- purchase orders -------------------------------------------------------------------------------------------
def po_nested(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Each PO with its lines as an array ordered by line id; POs without lines kept."""
    li = lines.select(
        "purchase_order_id",
        F.struct("line_id", "product_id", "quantity", "unit_cost").alias("line"),
    )
    agg = li.groupBy("purchase_order_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return orders.join(agg, "purchase_order_id", "left").withColumn(
        "lines", F.coalesce("lines", F.array().cast("array<struct<line_id:bigint,product_id:bigint,quantity:int,unit_cost:decimal(10,2)>>"))
    )


def po_by_status(orders: DataFrame, status: str | None = None) -> DataFrame:
    """Filter by status, newest first (presentation order)."""
    f = orders if status is None else orders.filter(F.col("status") == status)
    return f.orderBy(F.col("created_at").desc(), F.col("purchase_order_id").desc())


def po_lines_labelled(orders: DataFrame, lines: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Display labels with fallbacks ``Product {id}`` / ``Supplier {id}``."""
    p = products.select("product_id", "organization_id", F.col("name").alias("product_name"))
    s = suppliers.select("supplier_id", "organization_id", F.col("name").alias("supplier_name"))
    o = orders.select("purchase_order_id", "supplier_id", "status")
    j = lines.join(o, "purchase_order_id", "left").join(p, ["product_id", "organization_id"], "left").join(
        s, ["supplier_id", "organization_id"], "left"
    )
    return j.select(
        "line_id",
        "purchase_order_id",
        "organization_id",
        "product_id",
        "supplier_id",
        "quantity",
        "unit_cost",
        F.coalesce("product_name", F.concat(F.lit("Product "), F.col("product_id").cast("string"))).alias(
            "product_label"
        ),
        F.coalesce("supplier_name", F.concat(F.lit("Supplier "), F.col("supplier_id").cast("string"))).alias(
            "supplier_label"
        ),
    )


def receipt_events(orders: DataFrame, lines: DataFrame, log_ids: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """SUBMITTED POs -> one PURCHASE event per line, id ``po-{po}-line-{line}``; lines
    already recorded by an earlier, partly failed receive are flagged and not applied again.
    ``rows``: about how many lines there are, so that the test of their ids is spread by them."""
    sub = orders.filter(F.col("status") == "SUBMITTED").select("purchase_order_id", "organization_id")
    ev = lines.join(sub, ["purchase_order_id", "organization_id"], "inner").select(
        "organization_id",
        "purchase_order_id",
        "line_id",
        "product_id",
        F.lit("PURCHASE").alias("event_type"),
        "quantity",
        F.format_string("po-%d-line-%d", F.col("purchase_order_id"), F.col("line_id")).alias("event_id"),
    )
    if log_ids is None:
        return ev.withColumn("already_recorded", F.lit(False))
    if rows is not None:
        ev = spread(ev, rows, "organization_id", "event_id")
    # only log rows with an id of these lines matter: the log itself is not shuffled for a small batch
    asked = ev.select("organization_id", "event_id")
    seen = log_ids.select("organization_id", "event_id").join(asked, ["organization_id", "event_id"], "left_semi")
    seen = seen.distinct().withColumn("already_recorded", F.lit(True))
    return ev.join(seen, ["organization_id", "event_id"], "left").withColumn(
        "already_recorded", F.coalesce("already_recorded", F.lit(False))
    )


def po_transitions(orders: DataFrame, lines: DataFrame, requests: DataFrame) -> DataFrame:
    """DRAFT -> SUBMITTED (needs >= 1 line) -> RECEIVED; other requests are refused, unknown
    actions too. ``requests``: purchase_order_id, organization_id, action and request_id, in whose
    order the requests of an order are judged (without that column: one request per order).

    An order changes twice at most: the first submit of a DRAFT with lines takes effect, and then
    the first receive after it. So the status that a request meets follows from two minima per
    order, joined back, and no order's requests have to be gathered.
    """
    n_lines = lines.groupBy("purchase_order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    key = ["purchase_order_id", "organization_id"]
    if "request_id" not in requests.columns:
        requests = requests.withColumn("request_id", F.lit(0).cast("long"))
    j = requests.join(orders.select(*key, "status"), key, "left")
    j = j.join(n_lines, "purchase_order_id", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))
    can_submit = (F.col("status") == "DRAFT") & (F.col("n_lines") > 0)
    submitted = j.groupBy(*key).agg(F.min(F.when((F.col("action") == "submit") & can_submit, F.col("request_id"))).alias("_submit"))
    j = j.join(submitted, key, "left")
    open_from = F.when(F.col("status") == "SUBMITTED", F.lit(-1).cast("long")).otherwise(F.col("_submit"))
    received = j.groupBy(*key).agg(F.min(F.when((F.col("action") == "receive") & (F.col("request_id") > open_from), F.col("request_id"))).alias("_receive"))
    j = j.join(received, key, "left")
    at = F.col("request_id")
    st = (
        F.when(at > F.col("_receive"), "RECEIVED")
        .when(at > F.col("_submit"), "SUBMITTED")
        .otherwise(F.col("status"))
    )
    j = j.withColumn("old_status", st)
    a, st, po = F.col("action"), F.col("old_status"), F.col("purchase_order_id").cast("string")
    refusal = lambda what: F.concat(F.lit(f"Cannot {what} purchase order "), po, F.lit(" in status "), st)
    err = (
        F.when(st.isNull(), F.concat(F.lit("Purchase order "), po, F.lit(" not found")))
        .when(a.isNull() | ~a.isin("submit", "receive"), F.concat(F.lit("Unknown action "), F.coalesce(a, F.lit("null"))))
        .when((a == "submit") & (st != "DRAFT"), refusal("submit"))
        .when((a == "submit") & (F.col("n_lines") == 0), refusal("submit (no lines)"))
        .when((a == "receive") & (st != "SUBMITTED"), refusal("receive"))
    )
    new = F.when(err.isNull(), F.when(a == "submit", "SUBMITTED").otherwise("RECEIVED")).otherwise(st)
    return j.select(
        "purchase_order_id",
        "organization_id",
        "request_id",
        "action",
        "old_status",
        new.alias("new_status"),
        err.isNull().alias("accepted"),
        err.alias("error"),
    )


def judge_orders(requests: DataFrame, lines: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Whether each requested order can be made, all its lines or none. ``requests``: request_id,
    organization_id, supplier_id; ``lines``: request_id, position, product_id, quantity. The first reason
    counts: a line whose quantity is not above 0, an unknown supplier, the first line (by position) whose
    product the organization does not have. An order without lines is accepted, as a draft."""
    known = products.select("organization_id", "product_id").withColumn("_p", F.lit(True))
    found = suppliers.select("organization_id", "supplier_id").withColumn("_s", F.lit(True))
    mine = lines.join(requests.select("request_id", "organization_id"), "request_id").join(known, SERIES, "left")
    faults = mine.groupBy("request_id").agg(
        F.max((F.coalesce(F.col("quantity"), F.lit(0)) <= 0).cast("int")).alias("_empty"),
        F.min(F.when(F.col("_p").isNull(), F.struct("position", "product_id"))).alias("_missing"),
    )
    missing = F.concat(F.lit("Product "), F.coalesce(F.col("_missing.product_id").cast("string"), F.lit("null")), F.lit(" not found"))
    supplier = F.concat(F.lit("Supplier "), F.coalesce(F.col("supplier_id").cast("string"), F.lit("null")), F.lit(" not found"))
    error = (
        F.when(F.col("_empty") == 1, F.lit("quantity: Input should be greater than 0"))
        .when(F.col("_s").isNull(), supplier)
        .when(F.col("_missing").isNotNull(), missing)
    )
    judged = requests.join(found, ["organization_id", "supplier_id"], "left").join(faults, "request_id", "left")
    return judged.select("request_id", "organization_id", "supplier_id", error.isNull().alias("accepted"), error.alias("error"))


def draft_orders(restock_rows: DataFrame, requests: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """R4 + R7: for (product, supplier) requests, a DRAFT PO with one line of the recommended
    quantity where it is > 0; otherwise 'not needed'. Unknown supplier/product are refused."""
    p = products.select(*SERIES).withColumn("_p", F.lit(True))
    s = suppliers.select("supplier_id", "organization_id").withColumn("_s", F.lit(True))
    r = restock_rows.select(*SERIES, "recommended_order_qty")
    j = requests.join(p, SERIES, "left").join(s, ["supplier_id", "organization_id"], "left").join(r, SERIES, "left")
    qty = F.col("recommended_order_qty")
    err = (
        F.when(F.col("_s").isNull(), F.concat(F.lit("Supplier "), F.col("supplier_id").cast("string"), F.lit(" not found")))
        .when(F.col("_p").isNull(), F.concat(F.lit("Product "), F.col("product_id").cast("string"), F.lit(" not found")))
        .when(qty.isNull(), F.lit("no forecast"))
        .when(
            qty <= 0,
            F.concat(
                F.lit("Product "), F.col("product_id").cast("string"), F.lit("'s recommended order quantity is "),
                qty.cast("string"), F.lit(" — no PO needed right now"),
            ),
        )
    )
    return j.select(
        *SERIES,
        "supplier_id",
        F.when(err.isNull(), F.lit("DRAFT")).alias("status"),
        F.when(err.isNull(), qty).alias("quantity"),
        err.alias("error"),
    )
