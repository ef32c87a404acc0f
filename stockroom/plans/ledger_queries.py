"""Registered queries: oversell-guarded apply, idempotent ingest, recipe cascade, BOM groups,
webhook and CSV batch sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockroom.operators import ingest, ledger, projection, quality
from stockroom.plans.ingest_oracle import CASCADE_CTES, CASCADE_VIEWS, INGEST_CTES, INGEST_VIEWS, NEW_STATE
from stockroom.plans.oracle import with_views
from stockroom.plans.registry import register
from stockroom.session import work_dir
from stockroom.sources import adapters as A
from stockroom.sources import batches

OUTFLOW_SQL = "('SALE', 'DAMAGE', 'WASTE')"


@register(
    "oversell_apply",
    with_views(
        f"""SELECT e.organization_id, e.product_id, e.event_id, e.event_type, e.quantity, f.accepted,
       CASE WHEN f.accepted THEN f.bal END AS balance_after
FROM ev e JOIN fold f ON f.product_id = e.product_id AND f.organization_id = e.organization_id AND f.rn = e.rn""",
        "event_log_l",
        extra=[
            (
                "ev",
                """SELECT organization_id, product_id, event_id, event_type, quantity,
       row_number() OVER (PARTITION BY organization_id, product_id
                          ORDER BY created_at, event_id, supplier_id, quantity, price, event_type) AS rn
FROM event_log_l""",
            ),
            (
                "fold",
                f"""SELECT organization_id, product_id, rn,
       NOT (event_type IN {OUTFLOW_SQL} AND quantity < 0) AS accepted,
       CAST(CASE WHEN event_type IN {OUTFLOW_SQL} AND quantity < 0 THEN 0 ELSE quantity END AS BIGINT) AS bal
FROM ev WHERE rn = 1
UNION ALL
SELECT e.organization_id, e.product_id, e.rn,
       NOT (e.event_type IN {OUTFLOW_SQL} AND f.bal + e.quantity < 0),
       CASE WHEN e.event_type IN {OUTFLOW_SQL} AND f.bal + e.quantity < 0 THEN f.bal ELSE f.bal + e.quantity END
FROM fold f JOIN ev e ON e.organization_id = f.organization_id AND e.product_id = f.product_id AND e.rn = f.rn + 1""",
            ),
        ],
        recursive=True,
    ),
)
def q_oversell_apply(spark, sf_dir):
    # O1 on the lineitem log: every row is its own event (ids made unique by arrival number),
    # applied in the total order per product from a zero balance.
    log = A.event_log_l(spark, sf_dir)
    order = ["created_at", "event_id", "supplier_id", "quantity", "price", "event_type"]
    raw = F.when(F.col("event_type").isin("SALE", "DAMAGE", "WASTE"), -F.col("quantity")).otherwise(F.col("quantity"))
    # numbered within (product, day) plus the counts of earlier days: no product's rows meet in one task
    numbered = quality.occurrence_numbers(log, ["organization_id", "product_id"], order, F.to_date("created_at"))
    events = numbered.withColumn("seq", F.col("occurrence").cast("long")).select(
        "organization_id",
        "product_id",
        F.concat(F.col("event_id"), F.lit("#"), F.col("seq").cast("string")).alias("event_id"),
        "event_type",
        raw.alias("quantity"),
        "seq",
    )
    out = ledger.apply_batch(events, groups="product", unique_ids=True)
    return out.select(
        "organization_id",
        "product_id",
        F.substring_index("event_id", "#", 1).alias("event_id"),
        "event_type",
        F.col("delta").cast("int").alias("quantity"),
        F.col("applied").alias("accepted"),
        "balance_after",
    )


@register(
    "oversell_balances",
    with_views(
        f"""SELECT organization_id, product_id, CAST(last(bal ORDER BY rn) AS BIGINT) AS quantity,
       CAST(COUNT(*) FILTER (WHERE accepted) AS BIGINT) AS accepted_events,
       CAST(COUNT(*) FILTER (WHERE NOT accepted) AS BIGINT) AS refused_events
FROM fold GROUP BY organization_id, product_id""",
        "event_log_l",
        extra=[
            (
                "ev",
                """SELECT organization_id, product_id, event_id, event_type, quantity,
       row_number() OVER (PARTITION BY organization_id, product_id
                          ORDER BY created_at, event_id, supplier_id, quantity, price, event_type) AS rn
FROM event_log_l""",
            ),
            (
                "fold",
                f"""SELECT organization_id, product_id, rn,
       NOT (event_type IN {OUTFLOW_SQL} AND quantity < 0) AS accepted,
       CAST(CASE WHEN event_type IN {OUTFLOW_SQL} AND quantity < 0 THEN 0 ELSE quantity END AS BIGINT) AS bal
FROM ev WHERE rn = 1
UNION ALL
SELECT e.organization_id, e.product_id, e.rn,
       NOT (e.event_type IN {OUTFLOW_SQL} AND f.bal + e.quantity < 0),
       CASE WHEN e.event_type IN {OUTFLOW_SQL} AND f.bal + e.quantity < 0 THEN f.bal ELSE f.bal + e.quantity END
FROM fold f JOIN ev e ON e.organization_id = f.organization_id AND e.product_id = f.product_id AND e.rn = f.rn + 1""",
            ),
        ],
        recursive=True,
    ),
)
def q_oversell_balances(spark, sf_dir):
    # Final projection after the guarded apply: start + accepted deltas, and the counts.
    folded = q_oversell_apply(spark, sf_dir)
    return folded.groupBy("organization_id", "product_id").agg(
        F.sum(F.when(F.col("accepted"), F.col("quantity")).otherwise(0)).cast("bigint").alias("quantity"),
        F.count_if("accepted").cast("bigint").alias("accepted_events"),
        F.count_if(~F.col("accepted")).cast("bigint").alias("refused_events"),
    )


def _ingest(spark, sf_dir):
    rows = A.ingest_rows(spark, sf_dir)
    log = A.event_log(spark, sf_dir)
    state = projection.replay_state(log)
    return ingest.ingest(rows, A.products(spark, sf_dir), log=log, start_state=state)


@register(
    "ingest_results",
    with_views("SELECT * FROM ingest_out", *INGEST_VIEWS, extra=INGEST_CTES, recursive=True),
)
def q_ingest_results(spark, sf_dir):
    # The planted-fault batch applied on top of the events log's current state.
    results, _ = _ingest(spark, sf_dir)
    return results


@register(
    "ingest_summary",
    with_views(
        "SELECT organization_id, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE status = 'success') AS rows_succeeded, "
        "COUNT(*) FILTER (WHERE status = 'failed') AS rows_failed FROM ingest_out GROUP BY organization_id",
        *INGEST_VIEWS,
        extra=INGEST_CTES,
        recursive=True,
    ),
)
def q_ingest_summary(spark, sf_dir):
    results, _ = _ingest(spark, sf_dir)
    return ingest.summary(results)


@register("cascade_apply")
def q_cascade_apply(spark, sf_dir):
    # O3: the raw events as an incoming batch (arrival = id) with recipe cascades; one row per
    # fold row (leaders and cascaded components).
    raw = A.raw_events_e(spark, sf_dir)
    events = raw.select(
        "organization_id", "product_id", "event_id", "event_type", F.col("raw_quantity").alias("quantity"),
        F.col("id").alias("seq"),
    )
    out = ledger.apply_batch(events, recipe_items=A.recipe_items(spark, sf_dir))
    return out.select(
        "organization_id", "group_id", "product_id", "event_id", "event_type", "seq", "pos", "status", "error",
        "applied", "balance_after",
    )


@register(
    "recipe_cascade",
    with_views(
        """SELECT e.organization_id, r.component_product_id AS product_id,
       concat(e.event_id, ':component:', CAST(r.component_product_id AS STRING)) AS event_id,
       'SALE' AS event_type, CAST(r.quantity * e.raw_quantity AS BIGINT) AS quantity, e.id AS seq,
       CAST(row_number() OVER (PARTITION BY e.id ORDER BY r.recipe_item_id) AS INT) AS pos
FROM inventory_events_e e JOIN recipe_items r
  ON r.organization_id = e.organization_id AND r.finished_product_id = e.product_id
WHERE e.event_type = 'SALE' AND e.raw_quantity > 0""",
        "inventory_events_e",
        "recipe_items",
    ),
)
def q_recipe_cascade(spark, sf_dir):
    raw = A.raw_events_e(spark, sf_dir)
    events = raw.select(
        "organization_id", "product_id", "event_id", "event_type", F.col("raw_quantity").alias("quantity"),
        F.col("id").alias("seq"),
    )
    rows = ledger.expand_units(events, A.recipe_items(spark, sf_dir))
    return rows.filter(F.col("pos") > 0)


@register(
    "bom_groups",
    with_views(
        """SELECT organization_id, node AS product_id, min(label) AS group_id FROM reach GROUP BY organization_id, node""",
        "recipe_items",
        extra=[
            (
                "e",
                """SELECT organization_id, finished_product_id AS a, component_product_id AS b FROM recipe_items
UNION SELECT organization_id, component_product_id, finished_product_id FROM recipe_items""",
            ),
            (
                "reach",
                """SELECT organization_id, a AS node, a AS label FROM e
UNION
SELECT r.organization_id, e.b, r.label FROM reach r JOIN e ON e.organization_id = r.organization_id AND e.a = r.node""",
            ),
        ],
        recursive=True,
    ),
)
def q_bom_groups(spark, sf_dir):
    return ledger.connected_groups(ledger.recipe_edges(A.recipe_items(spark, sf_dir)))


WEBHOOK_ITEM_OK = """(length(sku) BETWEEN 1 AND 100 AND length(event_id) BETWEEN 1 AND 100
       AND regexp_matches(quantity, '^\\s*[+-]?[0-9]+(\\.0*)?\\s*$'))"""


@register(
    "webhook_events",
    with_views(
        """SELECT r.organization_id, CAST(floor((r.row_number - 1) / 500) AS BIGINT) AS batch,
       CAST(row_number() OVER (PARTITION BY r.organization_id, floor((r.row_number - 1) / 500) ORDER BY r.row_number) AS BIGINT) AS row_number,
       r.sku, r.event_type, CAST(CAST(regexp_extract(r.quantity, '^\\s*([+-]?[0-9]+)', 1) AS BIGINT) AS STRING) AS quantity,
       concat('generic:', r.event_id) AS event_id
FROM ingest_rows r
WHERE NOT EXISTS (
  SELECT 1 FROM ingest_rows b WHERE b.organization_id = r.organization_id
     AND floor((b.row_number - 1) / 500) = floor((r.row_number - 1) / 500) AND NOT """
        + WEBHOOK_ITEM_OK.replace("(length(sku)", "(length(b.sku)").replace("length(event_id)", "length(b.event_id)").replace("regexp_matches(quantity", "regexp_matches(b.quantity")
        + """)""",
        "ingest_rows",
    ),
)
def q_webhook_events(spark, sf_dir):
    # S3 + P10: the ingest rows re-nested as webhook bodies (500 items each), then parsed back;
    # payloads with a malformed item (non-integer quantity) are refused whole.
    rows = A.ingest_rows(spark, sf_dir)
    payloads = batches.webhook_payloads(rows)
    parsed, _refused = batches.parse_webhooks(payloads, A.organizations(spark, sf_dir))
    return parsed


@register(
    "webhook_refusals",
    with_views(
        """SELECT DISTINCT organization_id, CAST(floor((row_number - 1) / 500) AS BIGINT) AS batch,
       'events: malformed item' AS reason
FROM ingest_rows WHERE NOT """
        + WEBHOOK_ITEM_OK,
        "ingest_rows",
    ),
)
def q_webhook_refusals(spark, sf_dir):
    rows = A.ingest_rows(spark, sf_dir)
    payloads = batches.webhook_payloads(rows)
    _parsed, refused = batches.parse_webhooks(payloads, A.organizations(spark, sf_dir))
    return refused.select("organization_id", "batch", "reason")


WEBHOOK_ROWS_SQL = (
    """SELECT r.organization_id, CAST(row_number() OVER (PARTITION BY r.organization_id ORDER BY r.row_number) AS BIGINT) AS row_number,
       r.sku, r.event_type, CAST(CAST(regexp_extract(r.quantity, '^\\s*([+-]?[0-9]+)', 1) AS BIGINT) AS STRING) AS quantity,
       concat('generic:', r.event_id) AS event_id
FROM ingest_rows r
WHERE (r.organization_id, floor((r.row_number - 1) / 40)) NOT IN (
  SELECT (b.organization_id, floor((b.row_number - 1) / 40)) FROM ingest_rows b WHERE NOT """
    + WEBHOOK_ITEM_OK
    + ")"
)


@register(
    "webhook_ingest_results",
    with_views(
        "SELECT * FROM ingest_out",
        *INGEST_VIEWS,
        extra=[("webhook_rows", WEBHOOK_ROWS_SQL), *((n, sql.replace("ingest_rows r", "webhook_rows r")) for n, sql in INGEST_CTES)],
        recursive=True,
    ),
)
def q_webhook_ingest_results(spark, sf_dir):
    # S3 -> O4: many payloads per organization, numbered by arrival, folded in that order.
    payloads = batches.webhook_payloads(A.ingest_rows(spark, sf_dir), 40)
    rows, _refused = batches.parse_webhooks(payloads, A.organizations(spark, sf_dir))
    log = A.event_log(spark, sf_dir)
    arrived = batches.arrival_order(rows).drop("batch")
    results, _folded = ingest.ingest(arrived, A.products(spark, sf_dir), log=log, start_state=projection.replay_state(log))
    return results


@register(
    "csv_batch_rows",
    with_views(
        "SELECT row_number, sku, event_type, quantity, event_id FROM ingest_rows",
        "ingest_rows",
    ),
)
def q_csv_batch_rows(spark, sf_dir):
    # S2 + W4: the rows written as a multi-file CSV batch (in arrival order, plus an extra
    # column the reader must drop), read back and numbered 1..n in file order.
    path = work_dir(spark, "csv_batch")
    rows = A.ingest_rows(spark, sf_dir)
    (
        rows.withColumn("note", F.lit("extra"))
        .repartitionByRange(4, "row_number")
        .sortWithinPartitions("row_number")
        .select("sku", "event_type", "quantity", "event_id", "note")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    batch = batches.read_csv_batch(spark, path, organization_id=0)
    return batch.select("row_number", "sku", "event_type", "quantity", "event_id")


@register(
    "ingest_new_state",
    with_views("SELECT * FROM new_state", *INGEST_VIEWS, extra=INGEST_CTES + [("new_state", NEW_STATE)], recursive=True),
)
def q_ingest_new_state(spark, sf_dir):
    # U3 + projection update: the log plus the batch's newly accepted events, replayed, equals
    # the fold's final balances for every touched product (tested in tests/).
    _, folded = _ingest(spark, sf_dir)
    log = A.event_log(spark, sf_dir).select("organization_id", "product_id", "event_id", "event_type", "quantity")
    appended = log.unionByName(ledger.accepted_events(folded).drop("seq", "pos"))
    return projection.replay_state(appended)


def _cascade_fold(spark, sf_dir):
    raw = A.raw_events_e(spark, sf_dir)
    events = raw.select(
        "organization_id", "product_id", "event_id", "event_type", F.col("raw_quantity").alias("quantity"),
        F.col("id").alias("seq"),
    )
    return ledger.apply_batch(events, recipe_items=A.recipe_items(spark, sf_dir))


@register(
    "cascade_results",
    with_views(
        "SELECT organization_id, product_id, event_id, event_type, seq, status, error FROM fold WHERE k > 0",
        *CASCADE_VIEWS,
        extra=CASCADE_CTES,
        recursive=True,
    ),
)
def q_cascade_results(spark, sf_dir):
    # O3 per incoming row: a sale of a dish and its component sales succeed or fail together.
    out = _cascade_fold(spark, sf_dir).filter(F.col("pos") == 0)
    return out.select("organization_id", "product_id", "event_id", "event_type", "seq", "status", "error")


@register(
    "cascade_balances",
    with_views("SELECT * FROM final", *CASCADE_VIEWS, extra=CASCADE_CTES, recursive=True),
)
def q_cascade_balances(spark, sf_dir):
    # Final stock of every product the batch touched (dishes and components).
    return ledger.final_balances(_cascade_fold(spark, sf_dir))
