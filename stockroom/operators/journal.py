"""Jobs that append to the log: batch ingest (O4, U3) and receipt of purchase orders.

Each job reads the newest published version of the tables, works out its rows, and publishes log
rows, balances, order status, row results and audit rows as one version (``sources.store``). A job
that dies leaves nothing behind that readers see, and runs again under the same run id.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom import schemas as S
from stockroom.operators import ingest, ledger, projection, replenish
from stockroom.session import materialize
from stockroom.sources.batches import numbered_rows
from stockroom.sources.store import Store


INT, LONG, TEXT, TIME, FLAG = T.IntegerType(), T.LongType(), T.StringType(), T.TimestampType(), T.BooleanType()


def _shape(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS = {
    "log": T.StructType([*S.EVENT_LOG.fields, T.StructField("created_by_id", LONG)]),
    "state": _shape(organization_id=INT, product_id=LONG, quantity=LONG),
    "orders": _shape(purchase_order_id=LONG, supplier_id=LONG, organization_id=INT, status=TEXT, created_at=TIME),
    "lines": _shape(line_id=LONG, purchase_order_id=LONG, product_id=LONG, quantity=INT, unit_cost=T.DecimalType(10, 2), organization_id=INT),
    "audit": _shape(actor_id=LONG, action=TEXT, detail=TEXT, organization_id=INT, created_at=TIME),
    "results": _shape(run_id=TEXT, organization_id=INT, row_number=LONG, event_id=TEXT, status=TEXT, error=TEXT),
    "verdicts": _shape(run_id=TEXT, purchase_order_id=LONG, organization_id=INT, request_id=LONG, accepted=FLAG, error=TEXT),
}
KEYS = {"state": ["organization_id", "product_id"], "orders": ["organization_id", "purchase_order_id"]}
LAST_ID, LAST_ORDER, LAST_LINE = "last_id", "last_order", "last_line"


def open_journal(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, SCHEMAS, KEYS)


def start(store: Store, log: DataFrame, orders: DataFrame | None = None, run_id: str = "start") -> bool:
    """First version: an existing log (its ids stay), the projection replayed from it, and orders."""
    shaped = log if "created_by_id" in log.columns else log.withColumn("created_by_id", F.lit(None).cast("long"))
    rows = {"log": shaped, "state": projection.replay_state(log)}
    if orders is not None:
        rows["orders"] = orders
    return store.publish(run_id, rows, {LAST_ID: log.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]})


def log_rows(events: DataFrame, last_id: int, at: datetime, actor_id: int | None, *order: str) -> tuple[DataFrame, int]:
    """``events`` in the log's shape with serial ids behind ``last_id`` in ``order``, and the new
    last id. The same events get the same ids when a job runs again."""
    numbered = numbered_rows(events, *order)
    rows = numbered.select(
        (F.col("row_number") + last_id).alias("id"),
        "event_id",
        "product_id",
        "event_type",
        "quantity",
        F.lit(at).cast("timestamp").alias("created_at"),
        "organization_id",
        F.lit(actor_id).cast("long").alias("created_by_id"),
    )
    return rows, last_id + numbered.count()


def _audit(rows: DataFrame, at: datetime, actor_id: int | None, action: str) -> DataFrame:
    return rows.select(
        F.lit(actor_id).cast("long").alias("actor_id"), F.lit(action).alias("action"), "detail", "organization_id", F.lit(at).cast("timestamp").alias("created_at")
    )


def record_batch(
    store: Store,
    run_id: str,
    rows: DataFrame,
    products: DataFrame,
    at: datetime,
    actor_id: int | None = None,
    recipe_items: DataFrame | None = None,
) -> DataFrame:
    """O4 as a whole: validate, resolve, apply in arrival order, append; returns the batch's summary
    (A6). ``rows`` as for ``ingest.ingest``, of any number of organizations. Events get ids in the
    order (organization, row, recipe position), ``at`` as their time and ``actor_id`` (None: a
    webhook) as their actor. A run id that was recorded before changes nothing and gives the summary
    of what it did then."""
    if not store.published(run_id):
        head = store.head()
        checked = ingest.check_rows(rows, products)
        folded = ingest.apply_checked(checked, store.read("log", head), recipe_items, store.read("state", head))
        folded = materialize(folded, "ingest-folded")
        results = materialize(ingest.row_results(checked, folded), "ingest-results")
        accepted = ledger.accepted_events(folded)
        fresh, last_id = log_rows(accepted, (head.marks or {}).get(LAST_ID, 0), at, actor_id, "organization_id", "seq", "pos")
        moved = ledger.final_balances(folded).join(accepted.select("organization_id", "product_id").distinct(), ["organization_id", "product_id"], "left_semi")
        tables = {"log": fresh, "state": moved, "results": results.withColumn("run_id", F.lit(run_id))}
        store.publish(run_id, tables, {LAST_ID: last_id})
    return ingest.summary(batch_results(store, run_id))


def batch_results(store: Store, run_id: str) -> DataFrame:
    """Row results of one recorded batch."""
    return store.read("results").where(F.col("run_id") == run_id).drop("run_id")


def receive_orders(
    store: Store, run_id: str, requests: DataFrame, lines: DataFrame, products: DataFrame, at: datetime, actor_id: int | None
) -> DataFrame:
    """R5 + R6: receive SUBMITTED orders. Per accepted order one PURCHASE event for each line that is
    not yet in the log, the new balances, status RECEIVED and an audit row; all in one version.
    Returns the verdicts of the run. ``requests``: purchase_order_id, organization_id, request_id.

    An order with a line whose product is gone is refused as a whole. A run id that was published
    before changes nothing and returns its verdicts."""
    if not store.published(run_id):
        head = store.head()
        key = ["organization_id", "purchase_order_id"]
        orders = store.read("orders", head)
        asked = materialize(replenish.po_transitions(orders, lines, requests.withColumn("action", F.lit("receive"))), "receipt-verdicts")
        known = products.select("organization_id", "product_id")
        mine = lines.join(asked.where("accepted").select(*key), key, "left_semi")
        gone = mine.join(known, ["organization_id", "product_id"], "left_anti").groupBy(*key).agg(F.min("product_id").alias("missing"))
        missing = F.concat(F.lit("Product "), F.col("missing").cast("string"), F.lit(" not found"))
        judged = asked.join(gone, key, "left").select(
            *key,
            "request_id",
            (F.col("accepted") & F.col("missing").isNull()).alias("accepted"),
            F.coalesce("error", F.when(F.col("missing").isNotNull(), missing)).alias("error"),
        )
        judged = materialize(judged, "receipt-judged")
        received = orders.join(judged.where("accepted").select(*key), key, "left_semi")
        events = replenish.receipt_events(received, lines, store.read("log", head)).where("not already_recorded")
        events = events.select("organization_id", "purchase_order_id", "line_id", "product_id", "event_type", "quantity", "event_id")
        fresh, last_id = log_rows(events, (head.marks or {}).get(LAST_ID, 0), at, actor_id, "organization_id", "purchase_order_id", "line_id")
        fresh = materialize(fresh, "receipt-events")
        came = projection.replay_state(fresh).withColumnRenamed("quantity", "came")
        balances = came.join(store.read("state", head), ["organization_id", "product_id"], "left").select(
            "organization_id", "product_id", (F.coalesce("quantity", F.lit(0)) + F.col("came")).alias("quantity")
        )
        told = received.withColumn("detail", F.concat(F.lit("purchase_order_id="), F.col("purchase_order_id").cast("string")))
        tables = {
            "log": fresh,
            "state": balances,
            "orders": received.withColumn("status", F.lit("RECEIVED")),
            "audit": _audit(told, at, actor_id, "po_received"),
            "verdicts": judged.withColumn("run_id", F.lit(run_id)),
        }
        store.publish(run_id, tables, {LAST_ID: last_id})
    return store.read("verdicts").where(F.col("run_id") == run_id).drop("run_id")


def create_orders(store: Store, run_id: str, requests: DataFrame, lines: DataFrame, products: DataFrame, suppliers: DataFrame, at: datetime) -> DataFrame:
    """New DRAFT orders of any number of lines, each accepted or refused as a whole; returns the
    verdicts of the run. ``requests``: request_id, organization_id, supplier_id; ``lines``: request_id,
    position, product_id, quantity, unit_cost. Orders and lines get serial ids in request order."""
    if not store.published(run_id):
        head = store.head()
        marks = head.marks or {}
        judged = materialize(replenish.judge_orders(requests, lines, products, suppliers), "order-verdicts")
        ok = judged.where("accepted").select("request_id", "organization_id", "supplier_id")
        orders = numbered_rows(ok, "request_id").withColumn("purchase_order_id", F.col("row_number") + marks.get(LAST_ORDER, 0)).drop("row_number")
        orders = materialize(orders, "orders-new")
        mine = lines.join(orders.select("request_id", "purchase_order_id", "organization_id"), "request_id")
        rows = numbered_rows(mine, "request_id", "position").withColumn("line_id", F.col("row_number") + marks.get(LAST_LINE, 0))
        tables = {
            "orders": orders.select("*", F.lit("DRAFT").alias("status"), F.lit(at).cast("timestamp").alias("created_at")),
            "lines": rows,
            "verdicts": judged.join(orders.select("request_id", "purchase_order_id"), "request_id", "left").withColumn("run_id", F.lit(run_id)),
        }
        store.publish(run_id, tables, {LAST_ORDER: marks.get(LAST_ORDER, 0) + orders.count(), LAST_LINE: marks.get(LAST_LINE, 0) + rows.count()})
    return store.read("verdicts").where(F.col("run_id") == run_id).drop("run_id")
