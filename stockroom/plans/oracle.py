"""SQL text of the domain adapters, for the DuckDB cross-check of every registered query.

These are the FIXTURES.md adapter statements (they run unchanged in DuckDB and Spark SQL
under a UTC session). ``with_views(sql, ...)`` prepends the needed ones as CTEs.
"""

from __future__ import annotations

ADAPTERS: dict[str, tuple[str, tuple[str, ...]]] = {
    "organizations": (
        "SELECT CAST(r_regionkey + 1 AS INT) AS organization_id, r_name AS name, "
        "r_regionkey <> 4 AS is_active FROM region",
        (),
    ),
    "products": (
        "SELECT p_partkey AS product_id, CAST(p_partkey % 5 + 1 AS INT) AS organization_id, "
        "p_name AS name, concat('SKU-', CAST(p_partkey AS STRING)) AS sku, p_type AS unit, "
        "CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS created_at FROM part",
        (),
    ),
    "suppliers": (
        "SELECT s_suppkey AS supplier_id, CAST(s_suppkey % 5 + 1 AS INT) AS organization_id, "
        "s_name AS name FROM supplier",
        (),
    ),
    "inventory_events_e": (
        """SELECT event_id AS id, concat('evt-', CAST(event_id AS STRING)) AS event_id, user_id AS product_id,
       CAST(user_id % 5 + 1 AS INT) AS organization_id,
       CASE event_type WHEN 'signup' THEN 'PURCHASE' WHEN 'purchase' THEN 'SALE' WHEN 'view' THEN 'RETURN'
            WHEN 'click' THEN 'ADJUSTMENT'
            ELSE CASE WHEN event_id % 2 = 0 THEN 'DAMAGE' ELSE 'WASTE' END END AS event_type,
       CAST(ceil(value) AS INT) * CASE WHEN event_type = 'click' AND event_id % 2 = 1 THEN -1 ELSE 1 END AS raw_quantity,
       CAST(ts AS TIMESTAMP) AS created_at
FROM events""",
        (),
    ),
    "event_log": (
        """SELECT id, event_id, product_id, event_type,
       CAST(CASE WHEN event_type IN ('SALE', 'DAMAGE', 'WASTE') THEN -raw_quantity ELSE raw_quantity END AS INT) AS quantity,
       created_at, organization_id
FROM inventory_events_e
WHERE raw_quantity <> 0 AND (event_type = 'ADJUSTMENT' OR raw_quantity > 0)""",
        ("inventory_events_e",),
    ),
    "inventory_events_l": (
        """SELECT concat('li-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS event_id, l_partkey AS product_id,
       CAST(l_partkey % 5 + 1 AS INT) AS organization_id,
       CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_linenumber = 7 THEN 'RETURN' ELSE 'PURCHASE' END
            WHEN l_returnflag = 'R' THEN 'ADJUSTMENT' WHEN l_returnflag = 'A' THEN 'SALE'
            WHEN l_linenumber % 3 = 0 THEN 'DAMAGE' WHEN l_linenumber % 3 = 1 THEN 'WASTE' ELSE 'SALE' END AS event_type,
       CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN -(CAST(l_quantity AS INT) % 7)
            ELSE CAST(l_quantity AS INT) END AS raw_quantity,
       CAST(l_shipdate AS TIMESTAMP) AS created_at, l_suppkey AS supplier_id, l_extendedprice AS price
FROM lineitem""",
        (),
    ),
    "event_log_l": (
        """SELECT event_id, product_id, event_type,
       CAST(CASE WHEN event_type IN ('SALE', 'DAMAGE', 'WASTE') THEN -raw_quantity ELSE raw_quantity END AS INT) AS quantity,
       created_at, organization_id, supplier_id, price
FROM inventory_events_l
WHERE raw_quantity <> 0 AND (event_type = 'ADJUSTMENT' OR raw_quantity > 0)""",
        ("inventory_events_l",),
    ),
    "ingest_rows": (
        """SELECT event_id + 1 AS row_number,
       CASE WHEN event_id % 97 = 0 THEN 'SKU-unknown' ELSE concat('SKU-', CAST(user_id AS STRING)) END AS sku,
       CASE WHEN event_id % 89 = 0 THEN 'NOPE' WHEN event_type IN ('signup', 'view', 'click') THEN 'PURCHASE'
            WHEN event_type = 'purchase' THEN 'SALE' ELSE 'WASTE' END AS event_type,
       CASE WHEN event_id % 83 = 0 THEN '0' WHEN event_id % 79 = 0 THEN '-3' WHEN event_id % 73 = 0 THEN 'x'
            ELSE CAST(CAST(ceil(value) AS INT) AS STRING) END AS quantity,
       concat('in-', CAST(event_id - CASE WHEN event_id > 0 AND event_id % 101 = 0 THEN 1 ELSE 0 END AS STRING)) AS event_id,
       CAST(user_id % 5 + 1 AS INT) AS organization_id
FROM events""",
        (),
    ),
    "recipe_items": (
        """SELECT p.p_partkey * 10 + k.k AS recipe_item_id, p.p_partkey AS finished_product_id,
       p.p_partkey + CASE k.k WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE -15 END AS component_product_id,
       CASE k.k WHEN 1 THEN CAST(p.p_partkey % 3 + 1 AS INT) WHEN 2 THEN 2 ELSE 1 END AS quantity,
       CAST(p.p_partkey % 5 + 1 AS INT) AS organization_id
FROM part p CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k UNION ALL SELECT 3 AS k) k
WHERE p.p_partkey % 25 < 5 AND (k.k < 3 OR p.p_partkey % 50 >= 25)""",
        (),
    ),
    "purchase_orders": (
        """SELECT o_orderkey AS purchase_order_id, o_custkey % 10 AS supplier_id, CAST(o_custkey % 5 + 1 AS INT) AS organization_id,
       CASE o_orderstatus WHEN 'F' THEN 'RECEIVED' WHEN 'O' THEN 'SUBMITTED' ELSE 'DRAFT' END AS status,
       CAST(o_orderdate AS TIMESTAMP) AS created_at
FROM orders""",
        (),
    ),
    "purchase_order_lines": (
        """SELECT l.l_orderkey * 10 + l.l_linenumber AS line_id, l.l_orderkey AS purchase_order_id,
       min(l.l_partkey - l.l_partkey % 5 + o.o_custkey % 5) AS product_id,
       CAST(max(l.l_quantity) AS INT) AS quantity,
       CAST(floor(min(l.l_extendedprice / l.l_quantity)) AS DECIMAL(10, 2)) AS unit_cost,
       CAST(min(o.o_custkey % 5 + 1) AS INT) AS organization_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY l.l_orderkey, l.l_linenumber""",
        (),
    ),
    "fact_e": (
        """SELECT e.event_id, e.product_id, strftime(e.created_at, '%Y-%m-%d') AS date_id, e.event_type, e.quantity,
       e.created_at, e.organization_id
FROM event_log e JOIN products p ON e.product_id = p.product_id AND e.organization_id = p.organization_id""",
        ("event_log", "products"),
    ),
    "fact_l": (
        """SELECT e.event_id, e.product_id, strftime(e.created_at, '%Y-%m-%d') AS date_id, e.event_type, e.quantity,
       e.created_at, e.organization_id
FROM event_log_l e JOIN products p ON e.product_id = p.product_id AND e.organization_id = p.organization_id""",
        ("event_log_l", "products"),
    ),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in ADAPTERS[n][1]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(
    sql: str, *names: str, extra: list[tuple[str, str]] | None = None, recursive: bool = False
) -> str:
    """Prefix ``sql`` with ``WITH`` definitions of the named adapters (and extra CTEs)."""
    parts = [f"{n} AS (\n{ADAPTERS[n][0]}\n)" for n in _order(names)]
    parts += [f"{n} AS (\n{body}\n)" for n, body in (extra or [])]
    if not parts:
        return sql
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + sql
