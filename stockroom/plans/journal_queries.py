"""Registered queries: batches and receipts recorded as published versions of log, state, orders and audit."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.operators import journal
from stockroom.plans.ingest_oracle import INGEST_CTES, INGEST_VIEWS, NEW_STATE
from stockroom.plans.ledger_queries import WEBHOOK_ROWS_SQL
from stockroom.plans.oracle import with_views
from stockroom.plans.registry import register
from stockroom.session import materialize, work_dir
from stockroom.sources import adapters as A
from stockroom.sources import batches
from stockroom.sources.tables import TASK_ROWS

AT = datetime(2030, 1, 2, 3, 4, 5)
ACTOR = 7

# Accepted rows of the ingest fold in log order, with the ids that follow the log's last one.
APPENDED_SQL = """SELECT (SELECT max(id) FROM event_log) + row_number() OVER (ORDER BY f.organization_id, f.row_number) AS id, f.event_id,
       f.product_id, g.event_type, CAST(f.delta AS INT) AS quantity, '2030-01-02 03:04:05' AS created_at, f.organization_id,
       CAST(7 AS BIGINT) AS created_by_id
FROM fold f JOIN good g ON g.organization_id = f.organization_id AND g.k = f.k WHERE f.applied"""


def _csv_files(spark, sf_dir: str, name: str) -> dict[int, str]:
    """The planted-fault rows as CSV files, a folder for each organization; as many files in a row as
    keep the rows of one task near ``TASK_ROWS``."""
    path = work_dir(spark, name)
    rows = A.ingest_rows(spark, sf_dir)
    files = max(3, -(-rows.count() // TASK_ROWS))
    rows = rows.repartitionByRange(files, "row_number").sortWithinPartitions("organization_id", "row_number")
    rows.select("sku", "event_type", "quantity", "event_id", "organization_id").write.partitionBy("organization_id").option("header", True).csv(path)
    orgs = A.organizations(spark, sf_dir).select("organization_id").collect()
    return {r[0]: f"{path}/organization_id={r[0]}" for r in orgs}


@register(
    "csv_ingest",
    with_views(APPENDED_SQL, *INGEST_VIEWS, extra=INGEST_CTES, recursive=True),
)
def q_csv_ingest(spark, sf_dir):
    # S2 -> O4 -> U3: CSV files of all tenants on top of the log; the batch is sent twice, and the
    # second time adds nothing. Returned: what stands behind the old log's last id.
    store = journal.open_journal(spark, work_dir(spark, "csv_ingest"))
    log = A.event_log(spark, sf_dir)
    journal.start(store, log)
    last_id = store.mark(journal.LAST_ID)
    files = _csv_files(spark, sf_dir, "csv_ingest_files")
    rows = reduce(DataFrame.unionByName, [batches.read_csv_batch(spark, path, org) for org, path in files.items()])
    for _ in range(2):
        journal.record_batch(store, "csv-1", rows, A.products(spark, sf_dir), AT, ACTOR)
    fresh = store.read("log").where(F.col("id") > last_id)
    return fresh.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@register(
    "csv_ingest_summary",
    with_views(
        "SELECT organization_id, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE status = 'success') AS rows_succeeded, "
        "COUNT(*) FILTER (WHERE status = 'failed') AS rows_failed FROM ingest_out GROUP BY organization_id",
        *INGEST_VIEWS,
        extra=INGEST_CTES,
        recursive=True,
    ),
)
def q_csv_ingest_summary(spark, sf_dir):
    # A6 from the published results of the batch
    store = journal.open_journal(spark, work_dir(spark, "csv_ingest"))
    journal.start(store, A.event_log(spark, sf_dir))
    files = _csv_files(spark, sf_dir, "csv_ingest_files")
    rows = reduce(DataFrame.unionByName, [batches.read_csv_batch(spark, path, org) for org, path in files.items()])
    return journal.record_batch(store, "csv-1", rows, A.products(spark, sf_dir), AT, ACTOR)


@register(
    "webhook_ingest_state",
    with_views(
        "SELECT * FROM new_state",
        *INGEST_VIEWS,
        extra=[
            ("webhook_rows", WEBHOOK_ROWS_SQL),
            *((n, sql.replace("ingest_rows r", "webhook_rows r")) for n, sql in INGEST_CTES),
            ("new_state", NEW_STATE),
        ],
        recursive=True,
    ),
)
def q_webhook_ingest_state(spark, sf_dir):
    # S3 -> O4 -> U3: webhook payloads (no actor) recorded in one publish; returned: the balances.
    store = journal.open_journal(spark, work_dir(spark, "webhook_ingest"))
    journal.start(store, A.event_log(spark, sf_dir))
    payloads = batches.webhook_payloads(A.ingest_rows(spark, sf_dir), 40)
    rows, _refused = batches.parse_webhooks(payloads, A.organizations(spark, sf_dir))
    journal.record_batch(store, "hook-1", batches.arrival_order(rows).drop("batch"), A.products(spark, sf_dir), AT)
    return store.read("state")


# Lines that an earlier, partly failed receipt recorded.
RECORDED_SQL = """SELECT l.* FROM purchase_order_lines l JOIN purchase_orders o USING (organization_id, purchase_order_id)
WHERE l.line_id % 10 = 1 AND l.purchase_order_id % 5 = 0 AND o.status = 'SUBMITTED'"""

RECEIVED_SQL = """SELECT o.* FROM purchase_orders o WHERE o.status = 'SUBMITTED' AND o.purchase_order_id % 7 <> 0
  AND NOT EXISTS (SELECT 1 FROM purchase_order_lines l LEFT JOIN products p USING (organization_id, product_id)
                  WHERE l.organization_id = o.organization_id AND l.purchase_order_id = o.purchase_order_id AND p.sku IS NULL)"""

BROUGHT_SQL = """SELECT l.* FROM purchase_order_lines l JOIN received r USING (organization_id, purchase_order_id)
WHERE l.line_id NOT IN (SELECT line_id FROM recorded)"""

PO_RECEIPT_SQL = """SELECT 'balance' AS kind, organization_id, product_id AS key, CAST(SUM(quantity) AS STRING) AS value FROM (
  SELECT organization_id, product_id, quantity FROM event_log UNION ALL SELECT organization_id, product_id, quantity FROM recorded
  UNION ALL SELECT organization_id, product_id, quantity FROM brought) t GROUP BY organization_id, product_id
UNION ALL
SELECT 'status', o.organization_id, o.purchase_order_id,
       CASE WHEN o.purchase_order_id IN (SELECT purchase_order_id FROM received) THEN 'RECEIVED' ELSE o.status END FROM purchase_orders o
UNION ALL
SELECT 'audit', organization_id, CAST(7 AS BIGINT), concat('po_received purchase_order_id=', CAST(purchase_order_id AS STRING)) FROM received
UNION ALL
SELECT 'event', organization_id, product_id, concat('po-', CAST(purchase_order_id AS STRING), '-line-', CAST(line_id AS STRING), ' ',
       CAST(quantity AS STRING), ' 2030-01-02 03:04:05 7') FROM brought
UNION ALL
SELECT 'ids', CAST(0 AS INT), CAST(COUNT(*) AS BIGINT), CAST((SELECT max(id) FROM event_log) + (SELECT COUNT(*) FROM recorded) + COUNT(*) AS STRING)
FROM brought"""


@register(
    "po_receipt",
    with_views(
        PO_RECEIPT_SQL,
        "event_log",
        "purchase_orders",
        "purchase_order_lines",
        "products",
        extra=[("recorded", RECORDED_SQL), ("received", RECEIVED_SQL), ("brought", BROUGHT_SQL)],
    ),
)
def q_po_receipt(spark, sf_dir):
    # R5 + R6 + U3 + S10: receipts in two runs (the first is sent again under its id), on a log in which
    # an earlier attempt left some lines. Returned: balances, status, audit rows, events and the last id.
    store = journal.open_journal(spark, work_dir(spark, "po_receipt"))
    # both runs read the lines several times: their join is made once
    lines = materialize(A.purchase_order_lines(spark, sf_dir), "receipt-lines")
    orders, log = A.purchase_orders(spark, sf_dir), A.event_log(spark, sf_dir)
    key = ["organization_id", "purchase_order_id"]
    old = lines.where("line_id % 10 = 1 and purchase_order_id % 5 = 0").join(orders.where("status = 'SUBMITTED'").select(*key), key, "left_semi")
    top = log.agg(F.max("id")).first()[0]
    old = batches.numbered_rows(old, "line_id").select(
        (F.col("row_number") + top).alias("id"),
        F.format_string("po-%d-line-%d", "purchase_order_id", "line_id").alias("event_id"),
        "product_id",
        F.lit("PURCHASE").alias("event_type"),
        "quantity",
        F.lit(datetime(2029, 1, 1)).alias("created_at"),
        "organization_id",
    )
    journal.start(store, log.unionByName(old), orders)
    before = store.mark(journal.LAST_ID)
    asked = orders.where("purchase_order_id % 7 <> 0").select(*key, F.col("purchase_order_id").alias("request_id"))
    for run, rest in (("receive-0", 0), ("receive-1", 1), ("receive-0", 0)):
        requests = asked.where(F.col("purchase_order_id") % 2 == rest)
        journal.receive_orders(store, run, requests, lines, A.products(spark, sf_dir), AT, ACTOR)
    fresh = store.read("log").where(F.col("id") > before)
    said = F.concat_ws(" ", "event_id", "quantity", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), "created_by_id")
    parts = [
        store.read("state").select(F.lit("balance").alias("kind"), "organization_id", F.col("product_id").alias("key"), F.col("quantity").cast("string").alias("value")),
        store.read("orders").select(F.lit("status"), "organization_id", "purchase_order_id", "status"),
        store.read("audit").select(F.lit("audit"), "organization_id", "actor_id", F.concat_ws(" ", "action", "detail")),
        fresh.select(F.lit("event"), "organization_id", "product_id", said),
        fresh.agg(F.lit("ids"), F.lit(0), F.count(F.lit(1)), F.max("id").cast("string")),
    ]
    return reduce(DataFrame.union, parts)
