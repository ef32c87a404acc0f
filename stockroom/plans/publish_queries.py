"""Registered queries: jobs on stored state (snapshots, statistics, commits, gates), deep pages and
lookups that name what they do not find."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom import schemas as S
from stockroom.operators import analytics, changes, forecast, journal, projection, quality, replenish, warehouse
from stockroom.plans.decision_queries import FORECAST_CTES, FORECAST_VIEWS, ROUND, fit_ctes
from stockroom.plans.oracle import with_views
from stockroom.plans.po_queries import PCHG_SQL, product_change_batch
from stockroom.plans.registry import ORACLE, register
from stockroom.session import materialize, work_dir
from stockroom.sources import adapters as A
from stockroom.sources import lake
from stockroom.sources.store import Store
from stockroom.sources.tables import read_table


# ---- S4 + S6, L6, A5 ---------------------------------------------------------------------------------------------
@register(
    "export_exactly_once",
    with_views(
        "SELECT COUNT(*) AS db_rows, COUNT(*) AS parquet_rows, true AS row_count_match, CAST(0 AS BIGINT) AS duplicate_event_ids, "
        "true AS schema_valid, true AS orphans_listed, true AS files_counted, max(id) AS last_id FROM event_log",
        "event_log",
    ),
)
def q_export_exactly_once(spark, sf_dir):
    # The crash of export_validation: the last day's rows reach the lake, and the run dies before its
    # commit. Readers of the commits see every row once; the files left behind are listed.
    root = work_dir(spark, "export_once")
    log = A.event_log(spark, sf_dir)
    last_day = log.agg(F.max(F.to_date("created_at"))).scalar()
    first = lake.export_once(spark, log.filter(F.to_date("created_at") < last_day), root)
    commits = lake.lake_commits(spark, root)
    lake.write_lake(lake.incremental(lake.base_scan(log), commits.mark(lake.LAST_ID)), root)
    second = lake.export_once(spark, log, root)
    report = quality.export_validation(log, lake.read_committed(spark, root).select(*S.EVENT_LOG_COLUMNS))
    told = first.unionByName(second).agg(F.sum("files_written")).first()[0]
    return report.select(
        "*",
        F.lit(not lake.uncommitted_files(spark, root).isEmpty()).alias("orphans_listed"),
        F.lit(told == commits.read("files").count()).alias("files_counted"),
        F.lit(commits.mark(lake.LAST_ID)).alias("last_id"),
    )


@register(
    "lake_file_order",
    with_views("SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM event_log", "event_log"),
)
def q_lake_file_order(spark, sf_dir):
    root = work_dir(spark, "lake_file_order")
    lake.export_once(spark, A.event_log(spark, sf_dir), root)
    return lake.file_order(spark, root).agg(F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order"))


# ---- A1 / T3 -----------------------------------------------------------------------------------------------------
@register("snapshot_state", ORACLE["replay_state"])
def q_snapshot_state(spark, sf_dir):
    # Snapshot versions of two stretches of the log, folded into one, plus the rows that came after.
    log = A.event_log(spark, sf_dir)
    low, high = log.agg(F.min("id"), F.max("id")).first()
    store = projection.snapshots(spark, work_dir(spark, "snapshot"))
    for part in (3, 2):
        projection.advance_snapshot(store, log.where(F.col("id") <= high - (high - low) // part), most_versions=1)
    return projection.current_state(store, log).select("organization_id", "product_id", F.col("quantity").cast("bigint").alias("quantity"))


# ---- F2 / F6 / F8 --------------------------------------------------------------------------------------------------
@register(
    "retrain_versions",
    with_views(
        f"""SELECT w.organization_id, w.product_id, CASE WHEN v.product_id IS NULL THEN 1 ELSE 2 END AS version, 'week-2' AS run, w.training_rows,
       round(w.slope, {ROUND}) AS slope, round(w.intercept, {ROUND}) AS intercept, round(w.sigma, {ROUND}) AS sigma, w.first_ds, w.last_ds, true AS is_champion
FROM w_m w LEFT JOIN v1_m v USING (organization_id, product_id)
UNION ALL
SELECT v.organization_id, v.product_id, 1, 'week-1', v.training_rows, round(v.slope, {ROUND}), round(v.intercept, {ROUND}), round(v.sigma, {ROUND}),
       v.first_ds, v.last_ds, w.product_id IS NULL
FROM v1_m v LEFT JOIN w_m w USING (organization_id, product_id)""",
        *FORECAST_VIEWS,
        extra=FORECAST_CTES
        + [
            ("early", "SELECT * FROM train WHERE CAST(date AS DATE) <= (SELECT max(CAST(created_at AS DATE)) FROM event_log) - 7"),
            *fit_ctes("early", "v1"),
        ],
    ),
)
def q_retrain_versions(spark, sf_dir):
    # Two scheduled runs a week apart; the second reads only the days of that week, and is sent twice.
    log = A.event_log(spark, sf_dir)
    fact = warehouse.fact_inventory_events(warehouse.staged_events(log), warehouse.dim_products(A.products(spark, sf_dir)))
    newest = log.agg(F.max(F.to_date("created_at")).alias("d")).select("d", F.date_sub("d", 7).alias("w")).first()
    store = forecast.training_store(spark, work_dir(spark, "retrain"))
    for run, until in (("week-1", newest.w), ("week-2", newest.d), ("week-2", newest.d)):
        forecast.retrain(store, fact, A.organizations(spark, sf_dir), str(until), run)
    now = store.read("champions").withColumn("is_champion", F.lit(True))
    rows = store.read("versions").join(now, [*forecast.SERIES, "version"], "left")
    return rows.select(
        *forecast.SERIES, "version", "run", "training_rows", *[F.round(c, ROUND).alias(c) for c in ("slope", "intercept", "sigma")],
        "first_ds", "last_ds", F.coalesce("is_champion", F.lit(False)).alias("is_champion"),
    )


# ---- Q7 ----------------------------------------------------------------------------------------------------------
FACT = T.StructType([f for f in S.EVENT_LOG.fields if f.name != "id"] + [T.StructField("date_id", T.StringType())])

GATE_SQL = """SELECT 'published' AS outcome, '' AS failing, (SELECT COUNT(*) FROM fact_e) AS rows_in_force
UNION ALL
SELECT 'refused', concat('check_event_type_domain: ', CAST(COUNT(*) FILTER (WHERE e.event_type = 'SALE') AS STRING),
       '; fk_event_product_org: ', CAST(COUNT(*) FILTER (WHERE p.product_id IS NULL OR p.organization_id <> e.organization_id) AS STRING),
       '; not_null_quantity: ', CAST(COUNT(*) FILTER (WHERE e.id % 2 = 0) AS STRING),
       '; relationships_product_id: ', CAST(COUNT(*) FILTER (WHERE p.product_id IS NULL) AS STRING),
       '; unique_event_key: ', CAST(COUNT(*) AS STRING)), (SELECT COUNT(*) FROM fact_e)
FROM event_log e LEFT JOIN products p ON p.product_id = e.product_id + CASE WHEN e.id % 5 = 0 THEN 1000000000 ELSE 0 END"""


@register("fact_gate", with_views(GATE_SQL, "event_log", "products", "fact_e"))
def q_fact_gate(spark, sf_dir):
    # A sound fact table is published; the next run brings rows of wrong type, product and quantity, each
    # twice, and is refused: the old table stays in force.
    products = warehouse.dim_products(A.products(spark, sf_dir))
    log = A.event_log(spark, sf_dir)
    store = Store(spark, work_dir(spark, "fact_gate"), {"fact": FACT})
    sound = warehouse.staged_events(log).join(products.select("product_id", "organization_id"), ["product_id", "organization_id"], "left_semi")
    bad = log.select(
        "event_id",
        (F.col("product_id") + F.when(F.col("id") % 5 == 0, 1_000_000_000).otherwise(0)).alias("product_id"),
        F.when(F.col("event_type") == "SALE", "SOLD").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("id") % 2 == 1, F.col("quantity")).alias("quantity"),
        "created_at",
        "organization_id",
    )
    # each row twice, by an explode of one scan
    bad = warehouse.staged_events(bad).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    out = []
    for run, rows in (("day-1", sound), ("day-2", bad)):
        try:
            quality.publish_fact(store, "fact", rows, products, run)
            outcome, failing = "published", ""
        except quality.QualityError as refused:
            halved = {n: v // 2 if n != "unique_event_key" else v for n, v in refused.failing.items()}
            outcome, failing = "refused", "; ".join(f"{n}: {v}" for n, v in sorted(halved.items()))
        out.append(store.read("fact").agg(F.lit(outcome).alias("outcome"), F.lit(failing).alias("failing"), F.count(F.lit(1)).alias("rows_in_force")))
    return reduce(DataFrame.unionByName, out)


# ---- Q5, Q6 ------------------------------------------------------------------------------------------------------
CATALOGUE_CHECKS = {
    "check_product_name_length": "SELECT COUNT(*) AS n FROM goods WHERE NOT COALESCE(length(name) BETWEEN 1 AND 255, false)",
    "check_product_sku_length": "SELECT COUNT(*) AS n FROM goods WHERE NOT COALESCE(length(sku) BETWEEN 1 AND 100, false)",
    "check_product_unit_length": "SELECT COUNT(*) AS n FROM goods WHERE length(unit) > 20",
    "check_supplier_name_length": "SELECT COUNT(*) AS n FROM suppliers WHERE NOT COALESCE(length(name) BETWEEN 1 AND 255, false)",
    "fk_state_product_org": "SELECT COUNT(*) AS n FROM (SELECT DISTINCT organization_id, product_id FROM event_log) s ANTI JOIN goods USING (organization_id, product_id)",
    "fk_event_actor_org": "SELECT COUNT(*) AS n FROM event_log e WHERE e.id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.id % 2000 AND c.c_custkey % 5 + 1 = e.organization_id)",
    "unique_state_key": "SELECT 0 AS n",
}


@register(
    "catalogue_report",
    with_views(
        "\nUNION ALL\n".join(f"SELECT '{c}' AS \"check\", CAST(n AS BIGINT) AS failing_rows, n = 0 AS passed FROM ({q}) q" for c, q in CATALOGUE_CHECKS.items()),
        "event_log",
        "products",
        "suppliers",
        extra=[
            (
                "goods",
                """SELECT product_id, organization_id, CASE WHEN product_id % 50 = 3 THEN '' WHEN product_id % 50 = 4 THEN NULL ELSE name END AS name,
       CASE WHEN product_id % 50 = 5 THEN repeat('s', 101) ELSE sku END AS sku, unit FROM products WHERE product_id % 20 <> 7""",
            )
        ],
    ),
)
def q_catalogue_report(spark, sf_dir):
    # Products with planted faults: no name, a long sku, and some that are gone though they have stock.
    k = F.col("product_id")
    goods = A.products(spark, sf_dir).where(k % 20 != 7).select(
        "product_id",
        "organization_id",
        F.when(k % 50 == 3, "").when(k % 50 == 4, None).otherwise(F.col("name")).alias("name"),
        F.when(k % 50 == 5, F.lit("s" * 101)).otherwise(F.col("sku")).alias("sku"),
        "unit",
    )
    log = A.event_log(spark, sf_dir).withColumn("created_by_id", F.when(F.col("id") % 3 != 0, F.col("id") % 2000))
    c = read_table(spark, sf_dir, "customer")
    users = c.select((F.col("c_custkey") % 5 + 1).cast("int").alias("organization_id"), F.col("c_custkey").alias("user_id"))
    return quality.catalogue_report(goods, A.suppliers(spark, sf_dir), projection.replay_state(log), log, users)


# ---- L1 ------------------------------------------------------------------------------------------------------------
BUSY_SQL = "SELECT organization_id, product_id FROM event_log GROUP BY ALL ORDER BY COUNT(*) DESC, organization_id, product_id LIMIT 1"


def _busiest(log):
    counts = log.groupBy("organization_id", "product_id").count()
    return counts.orderBy(F.desc("count"), "organization_id", "product_id").first()


@register(
    "event_page_single",
    with_views(
        f"""SELECT e.* FROM event_log e JOIN ({BUSY_SQL}) b USING (organization_id, product_id)
WHERE e.event_type = 'SALE' ORDER BY e.created_at DESC, e.id DESC LIMIT 7 OFFSET 3""",
        "event_log",
    ),
)
def q_event_page_single(spark, sf_dir):
    # L1 + L2: one page of one product's sales, newest first.
    log = A.event_log(spark, sf_dir)
    busy = _busiest(log)
    return analytics.event_page(log, busy.product_id, busy.organization_id, limit=7, offset=3, event_type="SALE", descending=True)


@register(
    "event_page_deep",
    with_views(
        f"""SELECT e.* FROM event_log e JOIN ({BUSY_SQL}) b USING (organization_id, product_id)
ORDER BY e.created_at, e.id LIMIT 5 OFFSET 41""",
        "event_log",
    ),
)
def q_event_page_deep(spark, sf_dir):
    # L1 far into the busiest product's history: the day index names the days, the lake opens only those.
    log = A.event_log(spark, sf_dir)
    root = work_dir(spark, "event_page_deep")
    lake.export_once(spark, log, root)
    rows = lake.read_committed(spark, root)
    busy = _busiest(log)
    page = analytics.deep_page(rows, analytics.day_index(log), busy.product_id, busy.organization_id, limit=5, offset=41)
    return page.select(*S.EVENT_LOG_COLUMNS)


# ---- P16, P17 --------------------------------------------------------------------------------------------------------
ASKED_SQL = "SELECT CAST(o_orderkey % 5 + 1 AS INT) AS organization_id, o_custkey AS product_id FROM orders"


def _asked(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select((F.col("o_orderkey") % 5 + 1).cast("int").alias("organization_id"), F.col("o_custkey").alias("product_id"))


@register(
    "stock_lookup",
    with_views(
        """SELECT a.organization_id, a.product_id, CASE WHEN p.product_id IS NOT NULL THEN CAST(COALESCE(s.quantity, 0) AS BIGINT) END AS quantity,
       CASE WHEN p.product_id IS NULL THEN concat('Product ', CAST(a.product_id AS STRING), ' not found') END AS error
FROM asked a LEFT JOIN products p USING (organization_id, product_id)
LEFT JOIN (SELECT organization_id, product_id, SUM(quantity) AS quantity FROM event_log GROUP BY ALL) s USING (organization_id, product_id)""",
        "products",
        "event_log",
        extra=[("asked", ASKED_SQL)],
    ),
)
def q_stock_lookup(spark, sf_dir):
    return projection.stock_lookup(_asked(spark, sf_dir), A.products(spark, sf_dir), projection.replay_state(A.event_log(spark, sf_dir)))


@register(
    "recipe_lookup",
    with_views(
        """SELECT r.recipe_item_id, r.finished_product_id, r.component_product_id, r.quantity, r.organization_id, c.name AS component_name,
       c.sku AS component_sku, CAST(NULL AS VARCHAR) AS error
FROM recipe_items r JOIN (SELECT DISTINCT * FROM asked) a ON a.organization_id = r.organization_id AND a.product_id = r.finished_product_id
JOIN products d ON d.organization_id = r.organization_id AND d.product_id = r.finished_product_id
LEFT JOIN products c ON c.organization_id = r.organization_id AND c.product_id = r.component_product_id
UNION ALL
SELECT NULL, a.product_id, NULL, NULL, a.organization_id, NULL, NULL, concat('Product ', CAST(a.product_id AS STRING), ' not found')
FROM (SELECT DISTINCT * FROM asked) a WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.organization_id = a.organization_id AND p.product_id = a.product_id)""",
        "products",
        "recipe_items",
        extra=[("asked", ASKED_SQL)],
    ),
)
def q_recipe_lookup(spark, sf_dir):
    return replenish.recipe_lookup(_asked(spark, sf_dir), A.recipe_items(spark, sf_dir), A.products(spark, sf_dir))


# ---- R7 --------------------------------------------------------------------------------------------------------------
ORDER_REQUESTS_SQL = "SELECT o_orderkey AS request_id, CAST(o_custkey % 5 + 1 AS INT) AS organization_id, o_custkey % 125 AS supplier_id FROM orders"
ORDER_LINES_SQL = """SELECT DISTINCT l_orderkey AS request_id, l_linenumber AS position,
       min(l_partkey - l_partkey % 5 + CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE o_custkey % 5 END) AS product_id,
       CAST(max(CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE l_quantity END) AS INT) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber"""

PO_CREATE_SQL = """SELECT r.request_id, r.organization_id, r.supplier_id, x.e AS error,
       CASE WHEN x.e IS NULL THEN row_number() OVER (ORDER BY x.e IS NOT NULL, r.request_id) END AS purchase_order_id,
       CASE WHEN x.e IS NULL THEN CAST(COALESCE(l.n, 0) AS BIGINT) ELSE 0 END AS n_lines,
       CASE WHEN x.e IS NULL AND l.n > 0 THEN CAST(1 + COALESCE(SUM(CASE WHEN x.e IS NULL THEN COALESCE(l.n, 0) END) OVER (ORDER BY x.e IS NOT NULL, r.request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) END AS first_line
FROM req r
LEFT JOIN (SELECT request_id, COUNT(*) AS n, min(quantity) AS least FROM lin GROUP BY request_id) l USING (request_id)
LEFT JOIN suppliers s USING (organization_id, supplier_id)
LEFT JOIN (SELECT l.request_id, arg_min(l.product_id, l.position) AS product_id FROM lin l JOIN req q USING (request_id)
           WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.organization_id = q.organization_id AND p.product_id = l.product_id)
           GROUP BY l.request_id) m USING (request_id),
LATERAL (SELECT CASE WHEN l.least <= 0 THEN 'quantity: Input should be greater than 0'
    WHEN s.name IS NULL THEN concat('Supplier ', CAST(r.supplier_id AS STRING), ' not found')
    WHEN m.product_id IS NOT NULL THEN concat('Product ', CAST(m.product_id AS STRING), ' not found') END AS e) x"""


@register(
    "po_create",
    with_views(PO_CREATE_SQL, "products", "suppliers", extra=[("req", ORDER_REQUESTS_SQL), ("lin", ORDER_LINES_SQL)]),
)
def q_po_create(spark, sf_dir):
    # Orders of several lines, accepted or refused whole; ids follow request order. Sent twice.
    o, li = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    requests = o.select(F.col("o_orderkey").alias("request_id"), (F.col("o_custkey") % 5 + 1).cast("int").alias("organization_id"), (F.col("o_custkey") % 125).alias("supplier_id"))
    part = F.col("l_partkey")
    joined = li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    lines = joined.groupBy(F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("position")).agg(
        F.min(part - part % 5 + F.when(part % 11 == 0, 0).otherwise(F.col("o_custkey") % 5)).alias("product_id"),
        F.max(F.when(part % 29 == 0, 0).otherwise(F.col("l_quantity"))).cast("int").alias("quantity"),
        F.lit(None).cast("decimal(10,2)").alias("unit_cost"),
    )
    store = journal.open_journal(spark, work_dir(spark, "po_create"))
    for _ in range(2):
        verdicts = journal.create_orders(store, "create-1", requests, lines, A.products(spark, sf_dir), A.suppliers(spark, sf_dir), datetime(2030, 1, 2))
    made = store.read("lines").groupBy("purchase_order_id").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("first"))
    orders = store.read("orders").where("status = 'DRAFT'").select("purchase_order_id", "supplier_id")
    out = verdicts.join(made, "purchase_order_id", "left").join(orders, "purchase_order_id", "left").drop("supplier_id")
    return out.join(requests.select("request_id", "supplier_id"), "request_id").select(
        "request_id", "organization_id", "supplier_id", "error", "purchase_order_id", F.coalesce("n", F.lit(0)).alias("n_lines"), F.col("first").alias("first_line")
    )


# ---- C1 ----------------------------------------------------------------------------------------------------------------
LONG_SQL = f"""SELECT change_id, organization_id,
       CASE WHEN change_id % 41 = 0 THEN repeat('s', 101) WHEN change_id % 43 = 0 THEN '' ELSE sku END AS sku,
       CASE WHEN change_id % 37 = 0 THEN repeat('n', 256) WHEN change_id % 31 = 0 THEN NULL ELSE name END AS name,
       CASE WHEN change_id % 29 = 0 THEN repeat('u', 21) WHEN change_id % 23 = 0 THEN NULL ELSE unit END AS unit
FROM ({PCHG_SQL}) b"""


@register(
    "product_snapshot",
    with_views(
        """SELECT product_id, organization_id, name, sku, unit FROM products
UNION ALL
SELECT c.change_id + (SELECT max(product_id) FROM products), c.organization_id, c.name, c.sku, c.unit FROM valid c
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.organization_id = c.organization_id AND p.sku = c.sku)
  AND c.change_id = (SELECT min(v.change_id) FROM valid v WHERE v.organization_id = c.organization_id AND v.sku = c.sku)""",
        "products",
        extra=[
            ("pchg", LONG_SQL),
            ("valid", "SELECT * FROM pchg WHERE length(name) BETWEEN 1 AND 255 AND length(sku) BETWEEN 1 AND 100 AND COALESCE(length(unit), 0) <= 20"),
        ],
    ),
)
def q_product_snapshot(spark, sf_dir):
    # The catalogue after a batch with texts of wrong lengths, which are refused and do not hide a later sku.
    batch = product_change_batch(spark, sf_dir)
    k = F.col("change_id")
    planted = batch.select(
        "change_id",
        "organization_id",
        F.when(k % 41 == 0, F.lit("s" * 101)).when(k % 43 == 0, "").otherwise(F.col("sku")).alias("sku"),
        F.when(k % 37 == 0, F.lit("n" * 256)).when(k % 31 == 0, None).otherwise(F.col("name")).alias("name"),
        F.when(k % 29 == 0, F.lit("u" * 21)).when(k % 23 == 0, None).otherwise(F.col("unit")).alias("unit"),
    )
    snapshot, _ = changes.product_inserts(A.products(spark, sf_dir), planted)
    return snapshot.select("product_id", "organization_id", "name", "sku", "unit")


# ---- C4 in request order -----------------------------------------------------------------------------------------------
WAVE = 1_000_000_000


def _line_requests(lines):
    """Each line gets three requests, one wave after the other: an edit, a delete or a new line; then an
    edit of the new line or of one that may be gone; then another of these."""
    top = lines.agg(F.max("line_id")).scalar()
    kind, wave, new = F.col("line_id") % 3, F.col("wave"), F.col("line_id") % 3 == 2
    op = (
        F.when(new & (wave == 0), "insert")
        .when((kind == 0) & (wave == 1) | (kind == 1) & (wave == 0) | new & (wave == 2) & (F.col("line_id") % 2 == 0), "delete")
        .otherwise("update")
    )
    return lines.withColumn("wave", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        (F.col("line_id") + wave * WAVE).alias("change_id"),
        "organization_id",
        op.alias("op"),
        F.when(op == "insert", F.col("purchase_order_id")).alias("purchase_order_id"),
        F.when(op != "insert", F.when(new, F.col("line_id") + top).otherwise(F.col("line_id"))).alias("line_id"),
        F.when(op == "insert", F.col("product_id")).alias("product_id"),
        F.when(op != "delete", F.when(F.col("line_id") % 7 == 0, 0).otherwise(10 * (wave + 1))).cast("int").alias("quantity"),
    )


LINE_REQUESTS_SQL = f"""SELECT line_id + wave * {WAVE} AS change_id, organization_id, op, purchase_order_id, product_id,
       CASE WHEN line_id % 3 = 2 THEN line_id + (SELECT max(line_id) FROM purchase_order_lines) ELSE line_id END AS line_id,
       CASE WHEN line_id % 7 = 0 THEN 0 ELSE CAST(10 * (wave + 1) AS INT) END AS quantity
FROM purchase_order_lines, (SELECT unnest([0, 1, 2]) AS wave) w,
LATERAL (SELECT CASE WHEN line_id % 3 = 2 AND wave = 0 THEN 'insert'
    WHEN (line_id % 3 = 0 AND wave = 1) OR (line_id % 3 = 1 AND wave = 0) OR (line_id % 3 = 2 AND wave = 2 AND line_id % 2 = 0) THEN 'delete'
    ELSE 'update' END AS op) o"""

# One request after another on each line: n numbers them, alive and quantity are the line after each.
LINE_STEPS_SQL = """SELECT organization_id, line_id, CAST(0 AS BIGINT) AS n, bool_or(was) AS alive, max(quantity) AS quantity,
       max(purchase_order_id) AS purchase_order_id, max(product_id) AS product_id
FROM (SELECT organization_id, line_id, true AS was, quantity, purchase_order_id, product_id FROM purchase_order_lines
      UNION ALL SELECT organization_id, line_id, false, NULL, purchase_order_id, product_id FROM numbered WHERE op = 'insert') b
GROUP BY organization_id, line_id
UNION ALL
SELECT s.organization_id, s.line_id, r.n,
       CASE WHEN NOT r.sound THEN s.alive WHEN r.op = 'insert' THEN true WHEN r.op = 'delete' THEN false ELSE s.alive END,
       CASE WHEN r.sound AND (r.op = 'insert' OR (r.op = 'update' AND s.alive)) THEN r.quantity ELSE s.quantity END,
       s.purchase_order_id, s.product_id
FROM line_steps s JOIN numbered r ON r.organization_id = s.organization_id AND r.line_id = s.line_id AND r.n = s.n + 1"""


@register(
    "po_line_snapshot",
    with_views(
        """SELECT line_id, purchase_order_id, product_id, quantity, organization_id FROM line_steps s
WHERE alive AND n = (SELECT max(n) FROM line_steps t WHERE t.organization_id = s.organization_id AND t.line_id = s.line_id)""",
        "purchase_order_lines",
        "purchase_orders",
        "products",
        extra=[
            ("requests", LINE_REQUESTS_SQL),
            (
                "numbered",
                """SELECT r.*, row_number() OVER (PARTITION BY r.organization_id, r.line_id ORDER BY r.change_id) AS n,
       (r.op = 'delete' OR r.quantity > 0) AND o.status = 'DRAFT' AND (r.op <> 'insert' OR p.sku IS NOT NULL) AS sound
FROM requests r JOIN purchase_orders o USING (organization_id, purchase_order_id)
LEFT JOIN products p ON p.organization_id = r.organization_id AND p.product_id = r.product_id""",
            ),
            ("line_steps", LINE_STEPS_SQL),
        ],
        recursive=True,
    ),
)
def q_po_line_snapshot(spark, sf_dir):
    # The lines after requests on old, new, changed and deleted lines, in request order.
    lines = materialize(A.purchase_order_lines(spark, sf_dir), "snapshot-lines")
    snapshot, _ = changes.po_line_changes(A.purchase_orders(spark, sf_dir), lines, A.products(spark, sf_dir), _line_requests(lines))
    return snapshot.select("line_id", "purchase_order_id", "product_id", "quantity", "organization_id")
