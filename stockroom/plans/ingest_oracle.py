"""DuckDB twin of the batch ingest (O4): row validation, SKU lookup, then a recursive CTE that
folds each organization's valid rows in arrival order, carrying the balance map and the list
of ids recorded so far (idempotency, sign rule after the id test, oversell guard)."""

from __future__ import annotations

CHECKED = r"""SELECT r.*, CASE
    WHEN length(r.sku) < 1 THEN 'sku: String should have at least 1 character'
    WHEN length(r.sku) > 100 THEN 'sku: String should have at most 100 characters'
    WHEN r.event_type NOT IN ('PURCHASE', 'SALE', 'DAMAGE', 'ADJUSTMENT', 'RETURN', 'WASTE')
         THEN 'event_type: Input should be ''PURCHASE'', ''SALE'', ''DAMAGE'', ''ADJUSTMENT'', ''RETURN'' or ''WASTE'''
    WHEN NOT regexp_matches(r.quantity, '^\s*[+-]?[0-9]+(\.0*)?\s*$')
         THEN 'quantity: Input should be a valid integer, unable to parse string as an integer'
    WHEN TRY_CAST(regexp_extract(r.quantity, '^\s*([+-]?[0-9]+)', 1) AS BIGINT) = 0
         THEN 'quantity: Value error, Quantity cannot be zero'
    WHEN length(r.event_id) < 1 THEN 'event_id: String should have at least 1 character'
    WHEN length(r.event_id) > 100 THEN 'event_id: String should have at most 100 characters'
    WHEN p.product_id IS NULL THEN concat('Product with SKU ''', r.sku, ''' not found')
  END AS error, p.product_id,
  TRY_CAST(regexp_extract(r.quantity, '^\s*([+-]?[0-9]+)', 1) AS BIGINT) AS q
FROM ingest_rows r LEFT JOIN products p ON p.organization_id = r.organization_id AND p.sku = r.sku"""

GOOD = """SELECT organization_id, row_number, event_id, product_id, event_type, q,
       CASE WHEN event_type IN ('SALE', 'DAMAGE', 'WASTE') THEN -q ELSE q END AS delta,
       event_type IN ('SALE', 'DAMAGE', 'WASTE') AS guarded,
       CASE WHEN q < 0 AND event_type IN ('PURCHASE', 'RETURN', 'SALE', 'DAMAGE', 'WASTE')
            THEN concat(event_type, ' quantity must be positive') END AS sign_err,
       row_number() OVER (PARTITION BY organization_id ORDER BY row_number) AS k
FROM checked WHERE error IS NULL"""

START_MAP = """SELECT o.organization_id, COALESCE(s.m, MAP([]::BIGINT[], []::BIGINT[])) AS m
FROM (SELECT DISTINCT organization_id FROM good) o
LEFT JOIN (SELECT organization_id, map_from_entries(list(struct_pack(k := product_id, v := bal))) AS m
           FROM (SELECT organization_id, product_id, CAST(SUM(quantity) AS BIGINT) AS bal FROM event_log GROUP BY ALL) b
           GROUP BY organization_id) s ON s.organization_id = o.organization_id"""

FOLD = """SELECT organization_id, CAST(0 AS BIGINT) AS k, m, []::VARCHAR[] AS acc, CAST(NULL AS BIGINT) AS row_number,
       CAST(NULL AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS error,
       false AS applied, CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS BIGINT) AS delta
FROM start_map
UNION ALL
SELECT f.organization_id, g.k,
  CASE WHEN x.applied THEN map_concat(f.m, MAP([g.product_id], [x.cur + g.delta])) ELSE f.m END,
  CASE WHEN x.applied THEN list_append(f.acc, g.event_id) ELSE f.acc END,
  g.row_number, g.event_id,
  CASE WHEN x.dup OR x.applied THEN 'success' ELSE 'failed' END,
  CASE WHEN x.dup OR x.applied THEN NULL WHEN g.sign_err IS NOT NULL THEN g.sign_err ELSE 'Insufficient inventory' END,
  x.applied, g.product_id, g.delta
FROM fold f JOIN good g ON g.organization_id = f.organization_id AND g.k = f.k + 1,
LATERAL (SELECT list_contains(f.acc, g.event_id) AS dup, COALESCE(f.m[g.product_id], 0) AS cur,
                NOT list_contains(f.acc, g.event_id) AND g.sign_err IS NULL
                AND NOT (g.guarded AND COALESCE(f.m[g.product_id], 0) + g.delta < 0) AS applied) x"""

OUT = """SELECT organization_id, row_number, event_id, 'failed' AS status, error FROM checked WHERE error IS NOT NULL
UNION ALL
SELECT organization_id, row_number, event_id, status, error FROM fold WHERE k > 0"""

NEW_STATE = """SELECT organization_id, product_id, CAST(SUM(quantity) AS BIGINT) AS quantity FROM (
  SELECT organization_id, product_id, quantity FROM event_log
  UNION ALL
  SELECT organization_id, product_id, delta FROM fold WHERE k > 0 AND applied) t
GROUP BY organization_id, product_id"""

INGEST_CTES = [("checked", CHECKED), ("good", GOOD), ("start_map", START_MAP), ("fold", FOLD), ("ingest_out", OUT)]
INGEST_VIEWS = ("ingest_rows", "products", "event_log")


# ---- recipe cascade (O3) on the raw events: units of one sale plus its components ----------------------
CASCADE_UNITS = """SELECT e.organization_id, e.product_id, e.event_id, e.event_type, CAST(e.raw_quantity AS BIGINT) AS q, e.id AS seq,
       CASE WHEN e.event_type IN ('SALE', 'DAMAGE', 'WASTE') THEN -e.raw_quantity ELSE e.raw_quantity END AS delta,
       e.event_type IN ('SALE', 'DAMAGE', 'WASTE') AS guarded,
       CASE WHEN e.raw_quantity = 0 THEN 'Quantity cannot be zero'
            WHEN e.raw_quantity < 0 AND e.event_type IN ('PURCHASE', 'RETURN', 'SALE', 'DAMAGE', 'WASTE')
            THEN concat(e.event_type, ' quantity must be positive') END AS sign_err,
       CASE WHEN e.event_type = 'SALE' AND e.raw_quantity > 0 THEN COALESCE(c.comps, []) ELSE [] END AS comps,
       row_number() OVER (PARTITION BY e.organization_id ORDER BY e.id) AS k
FROM inventory_events_e e
LEFT JOIN (SELECT organization_id, finished_product_id,
                  list(struct_pack(pid := component_product_id, per := CAST(quantity AS BIGINT)) ORDER BY recipe_item_id) AS comps
           FROM recipe_items GROUP BY ALL) c
  ON c.organization_id = e.organization_id AND c.finished_product_id = e.product_id"""

CASCADE_FOLD = """SELECT organization_id, CAST(0 AS BIGINT) AS k, MAP([]::BIGINT[], []::BIGINT[]) AS m, []::VARCHAR[] AS acc,
       CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS event_id,
       CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS error
FROM (SELECT DISTINCT organization_id FROM units) o
UNION ALL
SELECT f.organization_id, u.k,
  CASE WHEN x.applied THEN map_concat(f.m, MAP([u.product_id], [x.cur + u.delta]),
       map_from_entries(list_transform(u.comps, lambda c: struct_pack(k := c.pid, v := COALESCE(f.m[c.pid], 0) - c.per * u.q))))
       ELSE f.m END,
  CASE WHEN x.applied THEN list_append(f.acc, u.event_id) ELSE f.acc END,
  u.seq, u.product_id, u.event_id, u.event_type,
  CASE WHEN x.dup OR x.applied THEN 'success' ELSE 'failed' END,
  CASE WHEN x.dup OR x.applied THEN NULL WHEN u.sign_err IS NOT NULL THEN u.sign_err ELSE 'Insufficient inventory' END
FROM fold f JOIN units u ON u.organization_id = f.organization_id AND u.k = f.k + 1,
LATERAL (SELECT list_contains(f.acc, u.event_id) AS dup, COALESCE(f.m[u.product_id], 0) AS cur,
                NOT list_contains(f.acc, u.event_id) AND u.sign_err IS NULL
                AND NOT (u.guarded AND COALESCE(f.m[u.product_id], 0) + u.delta < 0)
                AND COALESCE(list_bool_and(list_transform(u.comps, lambda c: COALESCE(f.m[c.pid], 0) - c.per * u.q >= 0)), true)
                AS applied) x"""

CASCADE_TOUCHED = """SELECT DISTINCT organization_id, product_id FROM units
UNION
SELECT organization_id, c.pid FROM (SELECT organization_id, unnest(comps) AS c FROM units) t"""

CASCADE_FINAL = """SELECT t.organization_id, t.product_id,
       CAST(COALESCE((SELECT f.m[t.product_id] FROM fold f
                      WHERE f.organization_id = t.organization_id
                        AND f.k = (SELECT max(k) FROM fold g WHERE g.organization_id = t.organization_id)), 0) AS BIGINT) AS quantity
FROM touched t"""

CASCADE_CTES = [("units", CASCADE_UNITS), ("fold", CASCADE_FOLD), ("touched", CASCADE_TOUCHED), ("final", CASCADE_FINAL)]
CASCADE_VIEWS = ("inventory_events_e", "recipe_items")
