"""Registered queries: event normalisation, star schema, the three analytical queries,
replay, stock lookups and history paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.functions.events import sign_error, signed_quantity
from stockroom.operators import analytics, projection, warehouse
from stockroom.plans.oracle import with_views
from stockroom.plans.registry import register
from stockroom.sources import adapters as A

SIGN_ERROR_SQL = """CASE WHEN raw_quantity = 0 THEN 'Quantity cannot be zero'
            WHEN event_type IN ('PURCHASE', 'RETURN', 'SALE', 'DAMAGE', 'WASTE') AND raw_quantity < 0
                 THEN concat(event_type, ' quantity must be positive')
            WHEN event_type NOT IN ('PURCHASE', 'SALE', 'DAMAGE', 'ADJUSTMENT', 'RETURN', 'WASTE')
                 THEN 'Unsupported event type' END"""


# ---- shared building blocks -------------------------------------------------------------------
def fact_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = A.event_log(spark, sf_dir)
    return warehouse.fact_inventory_events(
        warehouse.staged_events(log), warehouse.dim_products(A.products(spark, sf_dir))
    )


def fact_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = A.event_log_l(spark, sf_dir)
    return warehouse.fact_inventory_events(
        warehouse.staged_events(log), warehouse.dim_products(A.products(spark, sf_dir))
    )


def stale_state(log: DataFrame) -> DataFrame:
    """A stored projection that missed the log's last day (the O6 demo input)."""
    last_day = log.agg(F.max(F.to_date("created_at"))).scalar()
    return projection.replay_state(log.filter(F.to_date("created_at") < last_day))


# ---- P4 -----------------------------------------------------------------------------------------
@register(
    "signed_events",
    with_views(
        f"""SELECT source, event_id, product_id, organization_id, event_type, raw_quantity,
       CASE WHEN ({SIGN_ERROR_SQL}) IS NULL THEN CAST(CASE WHEN event_type IN ('SALE', 'DAMAGE', 'WASTE')
            THEN -raw_quantity ELSE raw_quantity END AS INT) END AS quantity,
       {SIGN_ERROR_SQL} AS error
FROM (SELECT 'E' AS source, event_id, product_id, organization_id, event_type, raw_quantity FROM inventory_events_e
      UNION ALL
      SELECT 'L' AS source, event_id, product_id, organization_id, event_type, raw_quantity FROM inventory_events_l) u""",
        "inventory_events_e",
        "inventory_events_l",
    ),
)
def q_signed_events(spark, sf_dir):
    cols = ["event_id", "product_id", "organization_id", "event_type", "raw_quantity"]
    e = A.raw_events_e(spark, sf_dir).select(F.lit("E").alias("source"), *cols)
    li = A.raw_events_l(spark, sf_dir).select(F.lit("L").alias("source"), *cols)
    u = e.unionByName(li)
    return u.select(
        "source",
        *cols,
        signed_quantity("event_type", "raw_quantity").alias("quantity"),
        sign_error("event_type", "raw_quantity").alias("error"),
    )


# ---- P3, S7, S11, J1 ----------------------------------------------------------------------------
@register(
    "staged_events",
    with_views(
        """SELECT event_id, product_id, event_type, quantity, created_at, organization_id,
       strftime(created_at, '%Y-%m-%d') AS date_id FROM event_log""",
        "event_log",
    ),
)
def q_staged_events(spark, sf_dir):
    return warehouse.staged_events(A.event_log(spark, sf_dir))


@register(
    "dim_dates",
    with_views(
        """SELECT strftime(d, '%Y-%m-%d') AS date_id, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
       CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter, dayname(d) AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(CAST(min(created_at) AS DATE), CAST(max(created_at) AS DATE), INTERVAL 1 DAY)) AS d
      FROM event_log_l) s""",
        "event_log_l",
    ),
)
def q_dim_dates(spark, sf_dir):
    log = A.event_log_l(spark, sf_dir)
    bounds = log.agg(F.min(F.to_date("created_at")).alias("lo"), F.max(F.to_date("created_at")).alias("hi"))
    return warehouse.dim_dates_between(bounds)


@register(
    "dim_products",
    with_views("SELECT product_id, name, sku, created_at, organization_id FROM products", "products"),
)
def q_dim_products(spark, sf_dir):
    return warehouse.dim_products(A.products(spark, sf_dir))


@register(
    "product_list",
    with_views(
        "SELECT product_id, organization_id, name, sku, unit FROM products ORDER BY name, product_id", "products"
    ),
)
def q_product_list(spark, sf_dir):
    p = A.products(spark, sf_dir)
    return p.select("product_id", "organization_id", "name", "sku", "unit").orderBy("name", "product_id")


@register(
    "supplier_list",
    with_views("SELECT supplier_id, organization_id, name FROM suppliers ORDER BY name, supplier_id", "suppliers"),
)
def q_supplier_list(spark, sf_dir):
    return A.suppliers(spark, sf_dir).orderBy("name", "supplier_id")


@register(
    "recipe_list",
    with_views(
        """SELECT r.recipe_item_id, r.finished_product_id, r.component_product_id, r.quantity, r.organization_id,
       c.name AS component_name, c.sku AS component_sku
FROM recipe_items r
JOIN products d ON d.product_id = r.finished_product_id AND d.organization_id = r.organization_id
LEFT JOIN products c ON c.product_id = r.component_product_id AND c.organization_id = r.organization_id
ORDER BY r.finished_product_id, r.recipe_item_id""",
        "recipe_items",
        "products",
    ),
)
def q_recipe_list(spark, sf_dir):
    from stockroom.operators.replenish import recipe_list

    return recipe_list(A.recipe_items(spark, sf_dir), A.products(spark, sf_dir))


@register(
    "fact_inventory_events",
    with_views(
        "SELECT event_id, product_id, date_id, event_type, quantity, created_at, organization_id FROM fact_e", "fact_e"
    ),
)
def q_fact(spark, sf_dir):
    return fact_e(spark, sf_dir)


# ---- A2, A3, W1 (the warehouse's three queries) ---------------------------------------------------
DAILY_DELTA_SQL = """SELECT product_id, date_id, CAST(SUM(quantity) AS BIGINT) AS daily_delta
FROM {fact} GROUP BY product_id, date_id"""


@register("daily_delta", with_views(DAILY_DELTA_SQL.format(fact="fact_e"), "fact_e"))
def q_daily_delta(spark, sf_dir):
    return analytics.daily_delta(fact_e(spark, sf_dir)).orderBy("date_id", "product_id")


@register("daily_delta_lineitem", with_views(DAILY_DELTA_SQL.format(fact="fact_l"), "fact_l"))
def q_daily_delta_l(spark, sf_dir):
    return analytics.daily_delta(fact_l(spark, sf_dir)).orderBy("date_id", "product_id")


BREAKDOWN_SQL = """SELECT event_type, COUNT(*) AS event_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity
FROM {fact} GROUP BY event_type"""


@register("event_type_breakdown", with_views(BREAKDOWN_SQL.format(fact="fact_e"), "fact_e"))
def q_breakdown(spark, sf_dir):
    return analytics.event_type_breakdown(fact_e(spark, sf_dir)).orderBy(F.desc("event_count"), "event_type")


@register("event_type_breakdown_lineitem", with_views(BREAKDOWN_SQL.format(fact="fact_l"), "fact_l"))
def q_breakdown_l(spark, sf_dir):
    return analytics.event_type_breakdown(fact_l(spark, sf_dir)).orderBy(F.desc("event_count"), "event_type")


RUNNING_SQL = """SELECT f.product_id, f.date_id, f.quantity, CAST(SUM(e.delta) AS BIGINT) AS running_balance
FROM (SELECT *, row_number() OVER () AS n FROM {fact}) f
JOIN (SELECT product_id, date_id, SUM(quantity) AS delta FROM {fact} GROUP BY ALL) e ON e.product_id = f.product_id AND e.date_id <= f.date_id
GROUP BY f.n, f.product_id, f.date_id, f.quantity"""


@register("running_balance", with_views(RUNNING_SQL.format(fact="fact_e"), "fact_e"))
def q_running_balance(spark, sf_dir):
    return analytics.running_balance(fact_e(spark, sf_dir)).orderBy("product_id", "date_id", "quantity")


@register("running_balance_lineitem", with_views(RUNNING_SQL.format(fact="fact_l"), "fact_l"))
def q_running_balance_l(spark, sf_dir):
    return analytics.running_balance(fact_l(spark, sf_dir)).orderBy("product_id", "date_id", "quantity")


# ---- A1, A14, P1, P2, P17, O6 ---------------------------------------------------------------------
REPLAY_SQL = """SELECT organization_id, product_id, CAST(SUM(quantity) AS BIGINT) AS quantity
FROM {log} GROUP BY organization_id, product_id"""


@register("replay_state", with_views(REPLAY_SQL.format(log="event_log"), "event_log"))
def q_replay_state(spark, sf_dir):
    return projection.replay_state(A.event_log(spark, sf_dir))


@register("replay_state_lineitem", with_views(REPLAY_SQL.format(log="event_log_l"), "event_log_l"))
def q_replay_state_l(spark, sf_dir):
    return projection.replay_state(A.event_log_l(spark, sf_dir))


@register(
    "replay_active_orgs",
    with_views(
        """SELECT e.organization_id, COUNT(*) AS events_processed, COUNT(DISTINCT e.product_id) AS products_rebuilt
FROM event_log e WHERE e.organization_id IN (SELECT organization_id FROM organizations WHERE is_active)
GROUP BY e.organization_id""",
        "event_log",
        "organizations",
    ),
)
def q_replay_active(spark, sf_dir):
    log = projection.active_scope(A.event_log(spark, sf_dir), A.organizations(spark, sf_dir))
    return projection.replay_summary(log)


@register(
    "stock_levels",
    with_views(
        """SELECT p.organization_id, p.product_id, CAST(COALESCE(s.quantity, 0) AS BIGINT) AS quantity
FROM products p LEFT JOIN (SELECT organization_id, product_id, SUM(quantity) AS quantity FROM event_log
                           GROUP BY organization_id, product_id) s
  ON p.organization_id = s.organization_id AND p.product_id = s.product_id""",
        "products",
        "event_log",
    ),
)
def q_stock_levels(spark, sf_dir):
    state = projection.replay_state(A.event_log(spark, sf_dir))
    return projection.stock_levels(A.products(spark, sf_dir), state)


@register(
    "state_reconciliation",
    with_views(
        """SELECT organization_id, product_id, CAST(COALESCE(s.q, 0) AS BIGINT) AS stored_quantity,
       CAST(COALESCE(r.q, 0) AS BIGINT) AS replayed_quantity, CAST(COALESCE(r.q, 0) - COALESCE(s.q, 0) AS BIGINT) AS difference
FROM (SELECT organization_id, product_id, SUM(quantity) AS q FROM event_log
      WHERE CAST(created_at AS DATE) < (SELECT max(CAST(created_at AS DATE)) FROM event_log)
      GROUP BY organization_id, product_id) s
FULL OUTER JOIN (SELECT organization_id, product_id, SUM(quantity) AS q FROM event_log GROUP BY organization_id, product_id) r
USING (organization_id, product_id)
WHERE COALESCE(s.q, 0) <> COALESCE(r.q, 0)""",
        "event_log",
    ),
)
def q_state_reconciliation(spark, sf_dir):
    log = A.event_log(spark, sf_dir)
    return projection.state_reconciliation(stale_state(log), log)


# ---- L1-L3, L5, A9, P5, P12 -----------------------------------------------------------------------
@register(
    "event_page",
    with_views(
        """SELECT id, event_id, product_id, event_type, quantity, created_at, organization_id, position FROM (
  SELECT *, row_number() OVER (PARTITION BY organization_id, product_id ORDER BY created_at, id) AS position
  FROM event_log) t WHERE position BETWEEN 11 AND 60""",
        "event_log",
    ),
)
def q_event_page(spark, sf_dir):
    # L1 for every product at once: offset 10, limit 50, ascending (created_at, id).
    log = A.event_log(spark, sf_dir)
    w = Window.partitionBy("organization_id", "product_id").orderBy("created_at", "id")
    return log.withColumn("position", F.row_number().over(w)).filter(F.col("position").between(11, 60))


@register(
    "event_page_by_type",
    with_views(
        """SELECT t.id, t.event_id, t.product_id, t.event_type, t.quantity,
       concat(p.name, ' (', p.sku, ')') AS product_label, strftime(t.created_at, '%Y-%m-%d %H:%M') AS created_text,
       t.position
FROM (SELECT *, row_number() OVER (PARTITION BY organization_id, product_id ORDER BY created_at DESC, id DESC) AS position
      FROM event_log WHERE event_type = 'SALE') t
JOIN products p ON p.product_id = t.product_id AND p.organization_id = t.organization_id
WHERE t.position <= 20""",
        "event_log",
        "products",
    ),
)
def q_event_page_by_type(spark, sf_dir):
    # L2 + P5 + P12: newest 20 SALE events of every product, with display labels.
    log = A.event_log(spark, sf_dir).filter(F.col("event_type") == "SALE")
    page = analytics.event_pages_per_product(log, page=1, page_size=S.DASHBOARD_PAGE, descending=True)
    return analytics.display_rows(page, A.products(spark, sf_dir), keep=("position",))


@register(
    "event_pages_per_product",
    with_views(
        """SELECT t.id, t.event_id, t.product_id, t.event_type, t.quantity, t.created_at, t.organization_id, t.position,
       c.event_count, c.pages
FROM (SELECT *, row_number() OVER (PARTITION BY organization_id, product_id ORDER BY created_at DESC, id DESC) AS position
      FROM event_log) t
JOIN (SELECT organization_id, product_id, COUNT(*) AS event_count,
             CAST(greatest(1, ceil(COUNT(*) / 20.0)) AS INT) AS pages
      FROM event_log GROUP BY organization_id, product_id) c
  ON c.organization_id = t.organization_id AND c.product_id = t.product_id
WHERE t.position BETWEEN 21 AND 40""",
        "event_log",
    ),
)
def q_event_pages(spark, sf_dir):
    # L3 + A9: page 2 (20 per page, newest first) of every product plus its page count.
    log = A.event_log(spark, sf_dir)
    page = analytics.event_pages_per_product(log, page=2)
    counts = analytics.event_count(log)
    return page.join(counts, ["organization_id", "product_id"], "inner")


# ---- J9 ---------------------------------------------------------------------------------------------
@register(
    "org_backfill",
    with_views(
        """SELECT c.id, c.event_id, c.product_id, c.event_type, CAST(COALESCE(c.quantity, 0) AS INT) AS quantity,
       c.created_at, COALESCE(c.organization_id, p.organization_id) AS organization_id
FROM (SELECT id, event_id, product_id, event_type,
             CASE WHEN id % 7 = 0 THEN NULL ELSE quantity END AS quantity, created_at,
             CASE WHEN id % 3 = 0 THEN NULL ELSE organization_id END AS organization_id
      FROM event_log) c
LEFT JOIN products p ON p.product_id = c.product_id""",
        "event_log",
        "products",
    ),
)
def q_org_backfill(spark, sf_dir):
    # A pre-tenancy copy of the log: every third row lost its org, every seventh its quantity.
    log = A.event_log(spark, sf_dir)
    child = log.select(
        "id",
        "event_id",
        "product_id",
        "event_type",
        F.when(F.col("id") % 7 != 0, F.col("quantity")).alias("quantity"),
        "created_at",
        F.when(F.col("id") % 3 != 0, F.col("organization_id")).alias("organization_id"),
    )
    return warehouse.org_backfill(child, A.products(spark, sf_dir), "product_id")


# ---- V3 ---------------------------------------------------------------------------------------------
@register(
    "event_id_backfill",
    with_views(
        """SELECT id, product_id, event_type, quantity, created_at, organization_id,
       CASE id % 5 WHEN 0 THEN 'backfill_' || id ELSE event_id END AS event_id FROM event_log""",
        "event_log",
    ),
)
def q_event_id_backfill(spark, sf_dir):
    # A copy of the log in which every fifth row is older than event ids.
    log = A.event_log(spark, sf_dir)
    old = log.withColumn("event_id", F.when(F.col("id") % 5 != 0, F.col("event_id")))
    return warehouse.event_id_backfill(old).select("id", "product_id", "event_type", "quantity", "created_at", "organization_id", "event_id")


# ---- S9: the same three queries through spark.sql over registered views / tables ----------------------
@register("sql_daily_delta", with_views(DAILY_DELTA_SQL.format(fact="fact_e"), "fact_e"))
def q_sql_daily_delta(spark, sf_dir):
    from stockroom.plans import views
    from stockroom.session import work_dir

    views.register_from_tables(spark, sf_dir, marts_root=work_dir(spark, "marts"))
    return spark.sql(views.QUERY_DAILY_DELTA)


@register("sql_event_breakdown", with_views(BREAKDOWN_SQL.format(fact="fact_e"), "fact_e"))
def q_sql_event_breakdown(spark, sf_dir):
    from stockroom.plans import views

    views.register_from_tables(spark, sf_dir)
    return spark.sql(views.QUERY_EVENT_BREAKDOWN)


@register("sql_running_balance", with_views(RUNNING_SQL.format(fact="fact_e"), "fact_e"))
def q_sql_running_balance(spark, sf_dir):
    from stockroom.plans import views

    views.register_from_tables(spark, sf_dir)
    return spark.sql(views.QUERY_RUNNING_BALANCE)
