"""Registered queries: purchase-order views and flows, and change batches on snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockroom.operators import changes, replenish
from stockroom.plans.oracle import with_views
from stockroom.plans.registry import register
from stockroom.sources import adapters as A
from stockroom.sources.tables import read_table


# ---- change-batch inputs derived from the driver tables -------------------------------------------------------
def product_change_batch(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("change_id"),
        (F.col("c_nationkey") % 5 + 1).cast("int").alias("organization_id"),
        F.concat(F.lit("SKU-"), (F.col("c_custkey") % 1200 * 2).cast("string")).alias("sku"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("unit"),
    )


PCHG_SQL = """SELECT c_custkey AS change_id, CAST(c_nationkey % 5 + 1 AS INT) AS organization_id,
       concat('SKU-', CAST(c_custkey % 1200 * 2 AS STRING)) AS sku, c_name AS name, c_mktsegment AS unit FROM customer"""


def recipe_change_batch(spark, sf_dir):
    """Three requests per part: a first one; then the same insert with a valid quantity, or a delete
    of the item that was named; then an update of the new item, or of the deleted one."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k, s, wave = F.col("p_partkey"), F.col("p_size"), F.col("wave")
    insert = s % 3 == 0
    top = A.recipe_items(spark, sf_dir).agg(F.max("recipe_item_id")).scalar()
    op = (
        F.when(insert & (wave < 2), "insert").when(wave == 2, "update").when(wave == 1, "delete").when(s % 3 == 1, "update").otherwise("delete")
    )
    return p.withColumn("wave", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        (k + wave * 10_000_000).alias("change_id"),
        (k % 5 + 1).cast("int").alias("organization_id"),
        op.alias("op"),
        F.when(insert, F.when(wave == 2, k + 10_000_000 + top)).otherwise(k * 10 + s % 3).alias("recipe_item_id"),
        F.when(insert & (wave < 2), k).alias("finished_product_id"),
        F.when(insert & (wave < 2), k + 5 * (s % 7 - 3)).alias("component_product_id"),
        F.when(wave > 0, F.lit(7)).when(s % 3 != 2, s % 5 - 1).cast("int").alias("quantity"),
    )


RCHG_SQL = """SELECT p_partkey + wave * 10000000 AS change_id, CAST(p_partkey % 5 + 1 AS INT) AS organization_id,
       CASE WHEN p_size % 3 = 0 AND wave < 2 THEN 'insert' WHEN wave = 2 THEN 'update' WHEN wave = 1 THEN 'delete'
            WHEN p_size % 3 = 1 THEN 'update' ELSE 'delete' END AS op,
       CASE WHEN p_size % 3 = 0 THEN CASE WHEN wave = 2 THEN p_partkey + 10000000 + (SELECT max(recipe_item_id) FROM recipe_items) END
            ELSE p_partkey * 10 + p_size % 3 END AS recipe_item_id,
       CASE WHEN p_size % 3 = 0 AND wave < 2 THEN p_partkey END AS finished_product_id,
       CASE WHEN p_size % 3 = 0 AND wave < 2 THEN p_partkey + 5 * (p_size % 7 - 3) END AS component_product_id,
       CASE WHEN wave > 0 THEN 7 WHEN p_size % 3 <> 2 THEN CAST(p_size % 5 - 1 AS INT) END AS quantity
FROM part, (SELECT unnest([0, 1, 2]) AS wave)"""

# The requests of a pair one after another: n numbers them, live is the pair's item after each.
RCHG_CTES = [
    ("rchg", RCHG_SQL),
    (
        "asked",
        """SELECT c.*, CASE WHEN op = 'insert' THEN change_id + (SELECT max(recipe_item_id) FROM recipe_items) ELSE recipe_item_id END AS item,
       CASE WHEN op <> 'delete' AND quantity <= 0 THEN 'quantity: Input should be greater than 0'
            WHEN op = 'insert' AND finished_product_id = component_product_id THEN 'A product cannot be an ingredient of itself'
            WHEN op = 'insert' AND NOT EXISTS (SELECT 1 FROM products p WHERE p.organization_id = c.organization_id AND p.product_id = finished_product_id)
                 THEN 'Product ' || finished_product_id || ' not found'
            WHEN op = 'insert' AND NOT EXISTS (SELECT 1 FROM products p WHERE p.organization_id = c.organization_id AND p.product_id = component_product_id)
                 THEN 'Product ' || component_product_id || ' not found' END AS refused
FROM rchg c""",
    ),
    (
        "items",
        """SELECT organization_id, recipe_item_id AS item, finished_product_id AS f, component_product_id AS c FROM recipe_items
UNION ALL SELECT organization_id, item, finished_product_id, component_product_id FROM asked WHERE op = 'insert' AND refused IS NULL""",
    ),
    (
        "numbered",
        """SELECT a.change_id, a.organization_id, a.op, a.item, a.quantity, i.f, i.c,
       row_number() OVER (PARTITION BY a.organization_id, i.f, i.c ORDER BY a.change_id) AS n
FROM asked a JOIN items i ON i.organization_id = a.organization_id AND i.item = a.item WHERE a.refused IS NULL""",
    ),
    (
        "steps",
        """SELECT DISTINCT n.organization_id, n.f, n.c, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS change_id, false AS holds,
       r.recipe_item_id AS live, r.quantity
FROM numbered n LEFT JOIN recipe_items r ON r.organization_id = n.organization_id AND r.finished_product_id = n.f AND r.component_product_id = n.c
UNION ALL
SELECT s.organization_id, s.f, s.c, m.n, m.change_id, x.ok,
       CASE WHEN NOT x.ok THEN s.live WHEN m.op = 'delete' THEN NULL ELSE m.item END,
       CASE WHEN NOT x.ok THEN s.quantity WHEN m.op = 'delete' THEN NULL ELSE m.quantity END
FROM steps s JOIN numbered m ON m.organization_id = s.organization_id AND m.f = s.f AND m.c = s.c AND m.n = s.n + 1,
LATERAL (SELECT CASE WHEN m.op = 'insert' THEN s.live IS NULL ELSE COALESCE(s.live = m.item, false) END AS ok) x""",
    ),
]


def po_line_change_batch(spark, sf_dir):
    li = A.purchase_order_lines(spark, sf_dir)
    m = F.col("line_id") % 3
    return li.select(
        F.col("line_id").alias("change_id"),
        "organization_id",
        F.when(m == 0, "update").when(m == 1, "delete").otherwise("insert").alias("op"),
        F.when(m == 2, F.col("purchase_order_id")).alias("purchase_order_id"),
        F.when(m != 2, F.col("line_id")).alias("line_id"),
        F.when(m == 2, F.col("product_id")).alias("product_id"),
        F.when(m == 0, F.col("quantity") + 1).when(m == 2, F.lit(1)).alias("quantity"),
    )


LCHG_SQL = """SELECT line_id AS change_id, organization_id,
       CASE line_id % 3 WHEN 0 THEN 'update' WHEN 1 THEN 'delete' ELSE 'insert' END AS op,
       CASE WHEN line_id % 3 = 2 THEN purchase_order_id END AS purchase_order_id,
       CASE WHEN line_id % 3 <> 2 THEN line_id END AS line_id,
       CASE WHEN line_id % 3 = 2 THEN product_id END AS product_id,
       CASE WHEN line_id % 3 = 0 THEN quantity + 1 WHEN line_id % 3 = 2 THEN 1 END AS quantity
FROM purchase_order_lines"""


# ---- J5, P6, J7 ----------------------------------------------------------------------------------------------------
@register("po_nested")
def q_po_nested(spark, sf_dir):
    # Every PO with its lines nested in line-id order (rows-only check: nested arrays).
    return replenish.po_nested(A.purchase_orders(spark, sf_dir), A.purchase_order_lines(spark, sf_dir))


@register(
    "po_nested_flat",
    with_views(
        """SELECT o.purchase_order_id, o.status, COUNT(l.line_id) AS line_count,
       CAST(COALESCE(SUM(l.quantity), 0) AS BIGINT) AS total_quantity, min(l.line_id) AS first_line_id
FROM purchase_orders o LEFT JOIN purchase_order_lines l ON l.purchase_order_id = o.purchase_order_id
GROUP BY o.purchase_order_id, o.status""",
        "purchase_orders",
        "purchase_order_lines",
    ),
)
def q_po_nested_flat(spark, sf_dir):
    # The nested view read back through array functions: count, sum and first line per PO.
    n = q_po_nested(spark, sf_dir)
    return n.select(
        "purchase_order_id",
        "status",
        F.size("lines").cast("long").alias("line_count"),
        F.aggregate("lines", F.lit(0).cast("long"), lambda acc, x: acc + x["quantity"]).alias("total_quantity"),
        F.get(F.col("lines"), 0)["line_id"].alias("first_line_id"),
    )


@register(
    "po_by_status",
    with_views(
        "SELECT * FROM purchase_orders WHERE status = 'SUBMITTED' ORDER BY created_at DESC, purchase_order_id DESC",
        "purchase_orders",
    ),
)
def q_po_by_status(spark, sf_dir):
    return replenish.po_by_status(A.purchase_orders(spark, sf_dir), "SUBMITTED")


@register(
    "po_lines_labelled",
    with_views(
        """SELECT l.line_id, l.purchase_order_id, l.organization_id, l.product_id, o.supplier_id, l.quantity, l.unit_cost,
       COALESCE(p.name, concat('Product ', CAST(l.product_id AS STRING))) AS product_label,
       COALESCE(s.name, concat('Supplier ', CAST(o.supplier_id AS STRING))) AS supplier_label
FROM purchase_order_lines l
LEFT JOIN purchase_orders o ON o.purchase_order_id = l.purchase_order_id
LEFT JOIN products p ON p.product_id = l.product_id AND p.organization_id = l.organization_id
LEFT JOIN suppliers s ON s.supplier_id = o.supplier_id AND s.organization_id = l.organization_id""",
        "purchase_order_lines",
        "purchase_orders",
        "products",
        "suppliers",
    ),
)
def q_po_lines_labelled(spark, sf_dir):
    return replenish.po_lines_labelled(
        A.purchase_orders(spark, sf_dir),
        A.purchase_order_lines(spark, sf_dir),
        A.products(spark, sf_dir),
        A.suppliers(spark, sf_dir),
    )


# ---- R5, R6 ----------------------------------------------------------------------------------------------------------
@register(
    "po_receipt_events",
    with_views(
        """SELECT l.organization_id, l.purchase_order_id, l.line_id, l.product_id, 'PURCHASE' AS event_type, l.quantity,
       concat('po-', CAST(l.purchase_order_id AS STRING), '-line-', CAST(l.line_id AS STRING)) AS event_id,
       l.line_id % 10 = 1 AS already_recorded
FROM purchase_order_lines l JOIN purchase_orders o
  ON o.purchase_order_id = l.purchase_order_id AND o.organization_id = l.organization_id
WHERE o.status = 'SUBMITTED'""",
        "purchase_order_lines",
        "purchase_orders",
    ),
)
def q_po_receipt_events(spark, sf_dir):
    # Retry of a partly failed receive: line 1 of every submitted PO was recorded before the
    # failure; the retry builds the same deterministic ids and applies only the rest.
    orders = A.purchase_orders(spark, sf_dir)
    lines = A.purchase_order_lines(spark, sf_dir)
    first_try = replenish.receipt_events(orders, lines.filter(F.col("line_id") % 10 == 1))
    return replenish.receipt_events(orders, lines, first_try.select("organization_id", "event_id"), read_table(spark, sf_dir, "lineitem").count())


# Four requests per order, in request order: submit, receive, an unknown action, submit again; every
# third order is asked to be received first.
PO_REQUESTS_SQL = """SELECT o.purchase_order_id, o.organization_id, o.status, COALESCE(n.n, 0) AS n_lines, CAST(i AS BIGINT) AS request_id,
       CASE WHEN i = 3 THEN 'cancel' WHEN (i = 2) = (o.purchase_order_id % 3 <> 0) THEN 'receive' ELSE 'submit' END AS action
FROM purchase_orders o CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS i)
LEFT JOIN (SELECT purchase_order_id, COUNT(*) AS n FROM purchase_order_lines GROUP BY ALL) n USING (purchase_order_id)"""

PO_STEPS_SQL = """SELECT purchase_order_id, organization_id, CAST(0 AS BIGINT) AS request_id, CAST(NULL AS VARCHAR) AS action,
       CAST(NULL AS VARCHAR) AS old_status, ANY_VALUE(status) AS new_status, false AS accepted, CAST(NULL AS VARCHAR) AS error
FROM po_requests GROUP BY purchase_order_id, organization_id
UNION ALL
SELECT s.purchase_order_id, s.organization_id, r.request_id, r.action, s.new_status,
       CASE WHEN x.e IS NOT NULL THEN s.new_status WHEN r.action = 'submit' THEN 'SUBMITTED' ELSE 'RECEIVED' END, x.e IS NULL, x.e
FROM po_steps s JOIN po_requests r ON r.purchase_order_id = s.purchase_order_id AND r.organization_id = s.organization_id AND r.request_id = s.request_id + 1,
LATERAL (SELECT CASE
    WHEN r.action NOT IN ('submit', 'receive') THEN 'Unknown action ' || r.action
    WHEN r.action = 'submit' AND s.new_status <> 'DRAFT' THEN 'Cannot submit purchase order ' || s.purchase_order_id || ' in status ' || s.new_status
    WHEN r.action = 'submit' AND r.n_lines = 0 THEN 'Cannot submit (no lines) purchase order ' || s.purchase_order_id || ' in status ' || s.new_status
    WHEN r.action = 'receive' AND s.new_status <> 'SUBMITTED' THEN 'Cannot receive purchase order ' || s.purchase_order_id || ' in status ' || s.new_status
  END AS e) x"""


@register(
    "po_transitions",
    with_views(
        "SELECT * FROM po_steps WHERE request_id > 0",
        "purchase_orders",
        "purchase_order_lines",
        extra=[("po_requests", PO_REQUESTS_SQL), ("po_steps", PO_STEPS_SQL)],
        recursive=True,
    ),
)
def q_po_transitions(spark, sf_dir):
    orders = A.purchase_orders(spark, sf_dir)
    i = F.col("request_id")
    action = F.when(i == 3, "cancel").when((i == 2) == (F.col("purchase_order_id") % 3 != 0), "receive").otherwise("submit")
    numbers = F.explode(F.array(*[F.lit(n).cast("long") for n in (1, 2, 3, 4)]))
    reqs = orders.select("purchase_order_id", "organization_id", numbers.alias("request_id")).withColumn("action", action)
    return replenish.po_transitions(orders, A.purchase_order_lines(spark, sf_dir), reqs)


# ---- C1-C4 -------------------------------------------------------------------------------------------------------------
@register(
    "product_changes",
    with_views(
        """SELECT change_id, organization_id, sku, CASE WHEN e IS NULL THEN 'inserted' ELSE 'rejected' END AS status, e AS error
FROM (SELECT c.*, CASE WHEN p.product_id IS NOT NULL
                         OR row_number() OVER (PARTITION BY c.organization_id, c.sku ORDER BY c.change_id) > 1
                       THEN concat('Product with this SKU already exists: ', c.sku) END AS e
      FROM pchg c LEFT JOIN products p ON p.organization_id = c.organization_id AND p.sku = c.sku) t""",
        "products",
        extra=[("pchg", PCHG_SQL)],
    ),
)
def q_product_changes(spark, sf_dir):
    _, results = changes.product_inserts(A.products(spark, sf_dir), product_change_batch(spark, sf_dir))
    return results


@register(
    "supplier_changes",
    with_views(
        """SELECT supplier_id, organization_id, name FROM suppliers
UNION ALL
SELECT c_custkey + (SELECT max(supplier_id) FROM suppliers), CAST(c_nationkey % 5 + 1 AS INT), concat('Supplier for ', c_name)
FROM customer""",
        "suppliers",
    ),
)
def q_supplier_changes(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("change_id"),
        (F.col("c_nationkey") % 5 + 1).cast("int").alias("organization_id"),
        F.concat(F.lit("Supplier for "), F.col("c_name")).alias("name"),
    )
    return changes.supplier_inserts(A.suppliers(spark, sf_dir), c)


@register(
    "recipe_changes",
    with_views(
        """SELECT a.change_id, a.organization_id, a.op,
       CASE WHEN x.e IS NULL THEN 'applied' ELSE 'rejected' END AS status, x.e AS error
FROM asked a LEFT JOIN steps s ON s.organization_id = a.organization_id AND s.change_id = a.change_id,
LATERAL (SELECT CASE WHEN a.refused IS NOT NULL THEN a.refused WHEN s.holds THEN NULL
    WHEN a.op = 'insert' THEN 'Recipe item already exists for finished product ' || a.finished_product_id || ' and component product ' || a.component_product_id
    ELSE 'Recipe item ' || a.recipe_item_id || ' not found' END AS e) x""",
        "recipe_items",
        "products",
        extra=RCHG_CTES,
        recursive=True,
    ),
)
def q_recipe_changes(spark, sf_dir):
    _, results = changes.recipe_changes(
        A.recipe_items(spark, sf_dir), A.products(spark, sf_dir), recipe_change_batch(spark, sf_dir)
    )
    return results


@register(
    "recipe_snapshot",
    with_views(
        """SELECT recipe_item_id, finished_product_id, component_product_id, CAST(quantity AS INT) AS quantity, organization_id
FROM recipe_items r WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.organization_id = r.organization_id
    AND s.f = r.finished_product_id AND s.c = r.component_product_id)
UNION ALL
SELECT live, f, c, CAST(quantity AS INT), organization_id FROM steps s
WHERE live IS NOT NULL AND n = (SELECT max(n) FROM steps t WHERE t.organization_id = s.organization_id AND t.f = s.f AND t.c = s.c)""",
        "recipe_items",
        "products",
        extra=RCHG_CTES,
        recursive=True,
    ),
)
def q_recipe_snapshot(spark, sf_dir):
    snap, _ = changes.recipe_changes(
        A.recipe_items(spark, sf_dir), A.products(spark, sf_dir), recipe_change_batch(spark, sf_dir)
    )
    return snap


@register(
    "po_line_changes",
    with_views(
        """SELECT c.change_id, c.organization_id, c.op, COALESCE(c.purchase_order_id, l.purchase_order_id) AS purchase_order_id,
       CASE WHEN x.e IS NULL THEN 'applied' ELSE 'rejected' END AS status, x.e AS error
FROM lchg c
LEFT JOIN purchase_order_lines l ON l.organization_id = c.organization_id AND l.line_id = c.line_id
LEFT JOIN purchase_orders o ON o.organization_id = c.organization_id
     AND o.purchase_order_id = COALESCE(c.purchase_order_id, l.purchase_order_id)
LEFT JOIN products p ON p.organization_id = c.organization_id AND p.product_id = c.product_id,
LATERAL (SELECT CASE
    WHEN c.op <> 'delete' AND c.quantity <= 0 THEN 'quantity: Input should be greater than 0'
    WHEN c.op <> 'insert' AND l.line_id IS NULL THEN concat('Purchase order line ', CAST(c.line_id AS STRING), ' not found')
    WHEN o.status IS NULL THEN concat('Purchase order ', CAST(COALESCE(c.purchase_order_id, l.purchase_order_id) AS STRING), ' not found')
    WHEN o.status <> 'DRAFT' THEN concat('Cannot ', CASE c.op WHEN 'insert' THEN 'add a line to' WHEN 'update' THEN 'edit a line on'
         ELSE 'remove a line from' END, ' purchase order ', CAST(o.purchase_order_id AS STRING), ' in status ', o.status)
    WHEN c.op = 'insert' AND p.product_id IS NULL THEN concat('Product ', CAST(c.product_id AS STRING), ' not found')
  END AS e) x""",
        "purchase_order_lines",
        "purchase_orders",
        "products",
        extra=[("lchg", LCHG_SQL)],
    ),
)
def q_po_line_changes(spark, sf_dir):
    _, results = changes.po_line_changes(
        A.purchase_orders(spark, sf_dir),
        A.purchase_order_lines(spark, sf_dir),
        A.products(spark, sf_dir),
        po_line_change_batch(spark, sf_dir),
    )
    return results
