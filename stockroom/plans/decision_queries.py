"""Registered queries: daily features, feature store, forecasts, fit metrics, backtest,
model versions, restock, fleet status and KPIs.

Doubles produced by regressions are rounded (4 places) in both engines before comparison.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockroom.operators import features as FE
from stockroom.operators import forecast as FC
from stockroom.operators import projection, replenish
from stockroom.plans.oracle import with_views
from stockroom.plans.registry import register
from stockroom.plans.warehouse_queries import fact_e
from stockroom.session import materialize, work_dir
from stockroom.sources import adapters as A
from stockroom.sources import lake

ROUND = 4

FEATURES_SQL = """SELECT organization_id, product_id, date_id AS date,
       CAST(COALESCE(SUM(abs(quantity)) FILTER (WHERE event_type IN ('SALE', 'DAMAGE', 'WASTE')), 0) AS BIGINT) AS units_sold,
       CAST(COALESCE(SUM(quantity) FILTER (WHERE event_type IN ('PURCHASE', 'RETURN')), 0) AS BIGINT) AS units_purchased,
       CAST(SUM(quantity) AS BIGINT) AS net_delta
FROM fact_e GROUP BY ALL"""

FEATURES_ROLLING_SQL = """SELECT *, avg(units_sold) OVER (PARTITION BY organization_id, product_id ORDER BY date
                                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_7d
FROM feat_base"""

ACTIVE_FEATURES_SQL = """SELECT f.* FROM feat f
WHERE f.organization_id IN (SELECT organization_id FROM organizations WHERE is_active)"""


def fit_ctes(src: str, p: str, weekly: bool = True) -> list[tuple[str, str]]:
    """SQL twin of ``forecast.fit`` over a features relation ``src``; CTE names prefixed by ``p``."""
    effect = "avg(r)" if weekly else "0.0"
    return [
        (
            f"{p}_s",
            f"""SELECT organization_id, product_id, CAST(date AS DATE) AS ds, CAST(units_sold AS DOUBLE) AS y,
       CAST(date_diff('day', min(CAST(date AS DATE)) OVER (PARTITION BY organization_id, product_id), CAST(date AS DATE)) AS DOUBLE) AS x,
       isodow(CAST(date AS DATE)) - 1 AS wd
FROM {src}""",
        ),
        (
            f"{p}_st",
            f"""SELECT organization_id, product_id, COUNT(*) AS training_rows, COALESCE(regr_slope(y, x), 0.0) AS slope,
       COALESCE(regr_intercept(y, x), avg(y)) AS intercept, min(ds) AS first_ds, max(ds) AS last_ds
FROM {p}_s GROUP BY organization_id, product_id HAVING COUNT(*) >= 14""",
        ),
        (
            f"{p}_r",
            f"""SELECT s.*, s.y - (t.intercept + t.slope * s.x) AS r FROM {p}_s s
JOIN {p}_st t ON t.organization_id = s.organization_id AND t.product_id = s.product_id""",
        ),
        (f"{p}_fx", f"SELECT organization_id, product_id, wd, {effect} AS effect FROM {p}_r GROUP BY organization_id, product_id, wd"),
        (
            f"{p}_sg",
            f"""SELECT r.organization_id, r.product_id, COALESCE(stddev_samp(r.r - x.effect), 0.0) AS sigma
FROM {p}_r r JOIN {p}_fx x ON x.organization_id = r.organization_id AND x.product_id = r.product_id AND x.wd = r.wd
GROUP BY r.organization_id, r.product_id""",
        ),
        (
            f"{p}_m",
            f"""SELECT t.*, g.sigma FROM {p}_st t
JOIN {p}_sg g ON g.organization_id = t.organization_id AND g.product_id = t.product_id""",
        ),
    ]


def predict_sql(p: str, dates: str) -> str:
    """yhat for rows (organization_id, product_id, ds, ...) of relation ``dates``."""
    return f"""SELECT d.*, m.intercept + m.slope * CAST(date_diff('day', m.first_ds, d.ds) AS DOUBLE) + COALESCE(x.effect, 0.0) AS yhat,
       m.sigma
FROM {dates} d JOIN {p}_m m ON m.organization_id = d.organization_id AND m.product_id = d.product_id
LEFT JOIN {p}_fx x ON x.organization_id = d.organization_id AND x.product_id = d.product_id AND x.wd = isodow(d.ds) - 1"""


FORECAST_CTES = [
    ("feat_base", FEATURES_SQL),
    ("feat", FEATURES_ROLLING_SQL),
    ("train", ACTIVE_FEATURES_SQL),
    *fit_ctes("train", "w"),
    (
        "horizon",
        "SELECT m.organization_id, m.product_id, CAST(m.last_ds + CAST(h.h AS INTEGER) AS DATE) AS ds FROM w_m m, range(1, 8) h(h)",
    ),
    ("fc", predict_sql("w", "horizon")),
    ("demand", "SELECT organization_id, product_id, SUM(greatest(yhat, 0.0)) AS projected_demand FROM fc GROUP BY ALL"),
    ("stock", "SELECT organization_id, product_id, SUM(quantity) AS quantity FROM event_log GROUP BY ALL"),
    (
        "rs0",
        """SELECT d.organization_id, d.product_id, CAST(COALESCE(s.quantity, 0) AS BIGINT) AS cur,
       greatest(0.0, d.projected_demand) AS d
FROM demand d LEFT JOIN stock s ON s.organization_id = d.organization_id AND s.product_id = d.product_id""",
    ),
    (
        "rs1",
        """SELECT *, round_even(d * 0.2, 0) AS safety,
       CASE WHEN d / 7 > 0 THEN round_even(cur / (d / 7), 0) ELSE 999.0 END AS days FROM rs0""",
    ),
    (
        "restock",
        """SELECT organization_id, product_id, cur AS current_inventory, round_even(d, 1) AS projected_demand_7d,
       CAST(safety AS BIGINT) AS safety_stock, CAST(greatest(0.0, round_even(d + safety - cur, 0)) AS BIGINT) AS recommended_order_qty,
       CAST(days AS BIGINT) AS days_of_stock_remaining,
       CASE WHEN cur = 0 THEN 'STOCKOUT' WHEN days < 4 THEN 'URGENT' WHEN days < 7 THEN 'LOW' ELSE 'OK' END AS urgency
FROM rs1""",
    ),
    (
        "fleet",
        """SELECT p.organization_id, p.product_id, p.name, p.sku, CAST(COALESCE(s.quantity, 0) AS BIGINT) AS current_inventory,
       r.projected_demand_7d, r.safety_stock, r.recommended_order_qty, r.days_of_stock_remaining,
       COALESCE(r.urgency, 'NO_FORECAST') AS urgency
FROM products p
LEFT JOIN stock s ON s.organization_id = p.organization_id AND s.product_id = p.product_id
LEFT JOIN restock r ON r.organization_id = p.organization_id AND r.product_id = p.product_id""",
    ),
]
FORECAST_VIEWS = ("fact_e", "organizations", "event_log", "products")


def _fc_sql(sql: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_views(sql, *FORECAST_VIEWS, extra=FORECAST_CTES + (extra or []))


# ---- Spark side building blocks -------------------------------------------------------------------------------
def features_e(spark, sf_dir):
    return FE.daily_features(fact_e(spark, sf_dir))


def train_features(spark, sf_dir):
    # every series of every active organization, in one job.
    return projection.active_scope(features_e(spark, sf_dir), A.organizations(spark, sf_dir))


def trained(spark, sf_dir, weekly: bool = True):
    return FC.fit(train_features(spark, sf_dir), weekly=weekly)


def restock_rows(spark, sf_dir):
    models, effects, _ = trained(spark, sf_dir)
    fc = FC.forecast(models, effects, 7)
    stock = projection.replay_state(A.event_log(spark, sf_dir))
    return replenish.restock(stock, FC.horizon_demand(fc))


def fleet(spark, sf_dir):
    stock = projection.replay_state(A.event_log(spark, sf_dir))
    return replenish.fleet_status(A.products(spark, sf_dir), stock, restock_rows(spark, sf_dir))


def _r(c):
    return F.round(F.col(c), ROUND).alias(c)


# ---- A4 / W2 / S8 ----------------------------------------------------------------------------------------------
@register(
    "daily_features",
    with_views(
        f"SELECT organization_id, product_id, date, units_sold, units_purchased, net_delta, round(rolling_avg_7d, {ROUND}) AS rolling_avg_7d FROM feat",
        "fact_e",
        extra=[("feat_base", FEATURES_SQL), ("feat", FEATURES_ROLLING_SQL)],
    ),
)
def q_daily_features(spark, sf_dir):
    return features_e(spark, sf_dir).withColumn("rolling_avg_7d", F.round("rolling_avg_7d", ROUND))


@register(
    "features_roundtrip",
    with_views(
        f"SELECT organization_id, product_id, date, units_sold, units_purchased, net_delta, round(rolling_avg_7d, {ROUND}) AS rolling_avg_7d FROM feat",
        "fact_e",
        extra=[("feat_base", FEATURES_SQL), ("feat", FEATURES_ROLLING_SQL)],
    ),
)
def q_features_roundtrip(spark, sf_dir):
    # Write the store for all orgs, then rebuild org 2 alone: dynamic partition overwrite
    # replaces only org_id=2, and reading the whole store gives the full feature table again.
    path = work_dir(spark, "feature_store")
    feats = features_e(spark, sf_dir)
    lake.write_feature_store(feats, path)
    lake.write_feature_store(FE.daily_features(fact_e(spark, sf_dir), org=2), path)
    back = lake.read_feature_store(spark, path)
    return back.select(
        "organization_id", "product_id", "date", "units_sold", "units_purchased", "net_delta",
        F.round("rolling_avg_7d", ROUND).alias("rolling_avg_7d"),
    )


# ---- F1-F5 -----------------------------------------------------------------------------------------------------
@register(
    "forecast_7d",
    _fc_sql(
        f"""SELECT organization_id, product_id, ds, round(greatest(0.0, round_even(yhat, 2)), {ROUND}) AS yhat,
       round(greatest(0.0, round_even(yhat - 1.96 * sigma, 2)), {ROUND}) AS yhat_lower,
       round(greatest(0.0, round_even(yhat + 1.96 * sigma, 2)), {ROUND}) AS yhat_upper FROM fc"""
    ),
)
def q_forecast_7d(spark, sf_dir):
    models, effects, _ = trained(spark, sf_dir)
    out = FC.presented(FC.forecast(models, effects, 7))
    return out.select("organization_id", "product_id", "ds", _r("yhat"), _r("yhat_lower"), _r("yhat_upper"))


@register(
    "forecast_models",
    _fc_sql(
        f"""SELECT organization_id, product_id, training_rows, round(slope, {ROUND}) AS slope,
       round(intercept, {ROUND}) AS intercept, round(sigma, {ROUND}) AS sigma, first_ds, last_ds FROM w_m"""
    ),
)
def q_forecast_models(spark, sf_dir):
    models, _, _ = trained(spark, sf_dir)
    return models.select(
        "organization_id", "product_id", "training_rows", _r("slope"), _r("intercept"), _r("sigma"), "first_ds", "last_ds"
    )


@register(
    "forecast_metrics",
    _fc_sql(
        f"""SELECT organization_id, product_id, round(avg(abs(y - yhat)), {ROUND}) AS mae,
       round(avg(CASE WHEN y <> 0 THEN abs(y - yhat) / y END) * 100, {ROUND}) AS mape_pct, COUNT(*) AS training_rows
FROM ins GROUP BY organization_id, product_id""",
        extra=[("ins", predict_sql("w", "w_s"))],
    ),
)
def q_forecast_metrics(spark, sf_dir):
    feats = materialize(train_features(spark, sf_dir), "features")
    models, effects, _ = FC.fit(feats)
    m = FC.fit_metrics(feats, models, effects)
    return m.select("organization_id", "product_id", _r("mae"), _r("mape_pct"), "training_rows")


BACKTEST_CTES = [
    (
        "ranked",
        "SELECT *, row_number() OVER (PARTITION BY organization_id, product_id ORDER BY date DESC) AS rk FROM train",
    ),
    ("bt_train", "SELECT * EXCLUDE (rk) FROM ranked WHERE rk > 7"),
    (
        "bt_test",
        "SELECT organization_id, product_id, CAST(date AS DATE) AS ds, CAST(units_sold AS DOUBLE) AS y FROM ranked WHERE rk <= 7",
    ),
    *fit_ctes("bt_train", "bw", weekly=True),
    *fit_ctes("bt_train", "bt", weekly=False),
    ("pw", predict_sql("bw", "bt_test")),
    ("pt", predict_sql("bt", "bt_test")),
    ("mw", "SELECT organization_id, product_id, avg(abs(y - yhat)) AS w FROM pw GROUP BY ALL"),
    ("mt", "SELECT organization_id, product_id, avg(abs(y - yhat)) AS t FROM pt GROUP BY ALL"),
]


@register(
    "forecast_backtest",
    _fc_sql(
        f"""SELECT mw.organization_id, mw.product_id, round(w, {ROUND}) AS mae_weekly, round(t, {ROUND}) AS mae_trend,
       w < 0.7 * t AS weekly_passes
FROM mw JOIN mt ON mt.organization_id = mw.organization_id AND mt.product_id = mw.product_id""",
        extra=BACKTEST_CTES,
    ),
)
def q_forecast_backtest(spark, sf_dir):
    bt = FC.backtest(materialize(train_features(spark, sf_dir), "features"))
    return bt.select("organization_id", "product_id", _r("mae_weekly"), _r("mae_trend"), "weekly_passes")


@register("forecast_fourier")
def q_forecast_fourier(spark, sf_dir):
    # Per-series ridge fit with changepoints + weekly Fourier terms (rows-only check;
    # the weekly-gain gate is tested on the seeded series in tests/).
    return FC.fit_fourier(train_features(spark, sf_dir), days=7)


# ---- F6 / F7 / J10 -----------------------------------------------------------------------------------------------
VERSION_CTES = [
    (
        "ranked",
        "SELECT *, row_number() OVER (PARTITION BY organization_id, product_id ORDER BY date DESC) AS rk FROM train",
    ),
    ("early", "SELECT * EXCLUDE (rk) FROM ranked WHERE rk > 7"),
    *fit_ctes("early", "v1"),
    (
        "versions",
        f"""SELECT organization_id, product_id, 1 AS version, 'early' AS run, training_rows, round(slope, {ROUND}) AS slope FROM v1_m
UNION ALL
SELECT w.organization_id, w.product_id, CASE WHEN v.product_id IS NULL THEN 1 ELSE 2 END, 'full', w.training_rows, round(w.slope, {ROUND})
FROM w_m w LEFT JOIN v1_m v ON v.organization_id = w.organization_id AND v.product_id = w.product_id""",
    ),
]


def _versions(spark, sf_dir):
    feats = materialize(train_features(spark, sf_dir), "features")
    ranked = feats.withColumn(
        "_rk",
        F.row_number().over(Window.partitionBy("organization_id", "product_id").orderBy(F.col("date").desc())),
    )
    early = ranked.filter(F.col("_rk") > 7).drop("_rk")
    m1, _, _ = FC.fit(early)
    m2, _, _ = FC.fit(feats)
    cols = ["organization_id", "product_id", "training_rows", F.round("slope", ROUND).alias("slope")]
    v = materialize(FC.log_versions(None, m1.select(*cols), "early"), "model-versions")
    # The version log is a stored table: each run appends to it and readers use the file.
    return materialize(FC.log_versions(v, m2.select(*cols), "full"), "model-versions")


@register(
    "model_versions",
    _fc_sql(
        """SELECT v.*, v.version = max(v.version) OVER (PARTITION BY organization_id, product_id) AS is_champion FROM versions v""",
        extra=VERSION_CTES,
    ),
)
def q_model_versions(spark, sf_dir):
    # F6 + F8: two scheduled runs (history without the last week, then all of it); each run
    # appends version max+1 per series; the newest version is the champion.
    v = _versions(spark, sf_dir)
    champ = FC.champions(v).withColumn("is_champion", F.lit(True))
    return v.join(champ, ["organization_id", "product_id", "version"], "left").select(
        "organization_id", "product_id", "version", "run", "training_rows", "slope",
        F.coalesce("is_champion", F.lit(False)).alias("is_champion"),
    )


@register(
    "model_rollback",
    _fc_sql(
        """SELECT c.organization_id, c.product_id,
       CASE WHEN c.product_id % 2 = 0 AND EXISTS (SELECT 1 FROM versions v WHERE v.organization_id = c.organization_id
                 AND v.product_id = c.product_id AND v.version = 1) THEN 1 ELSE c.version END AS version,
       CASE WHEN c.product_id % 7 = 0 THEN concat('No version 3 found for ''forecast_', CAST(c.product_id AS STRING), '''') END AS error
FROM (SELECT organization_id, product_id, max(version) AS version FROM versions GROUP BY ALL) c""",
        extra=VERSION_CTES,
    ),
)
def q_model_rollback(spark, sf_dir):
    # roll even products back to version 1 and ask for a version 3 that does not exist for
    # every seventh product; report the pointer table after the change, with the rejects.
    v = _versions(spark, sf_dir)
    pointers = FC.champions(v)
    # Even products first ask for the version they have, then for 1: the last request holds.
    even = pointers.filter(F.col("product_id") % 2 == 0).select("organization_id", "product_id", "version")
    reqs = even.withColumn("request_id", F.lit(1)).unionByName(
        even.withColumn("version", F.lit(1)).withColumn("request_id", F.lit(2))
    )
    bad = pointers.filter(F.col("product_id") % 7 == 0).select(
        "organization_id", "product_id", F.lit(3).alias("version"), F.lit(3).alias("request_id")
    )
    newp, rejects = FC.rollback(pointers, v, reqs.unionByName(bad))
    return newp.join(rejects.select("organization_id", "product_id", "error"), ["organization_id", "product_id"], "left")


# ---- R1-R4, A8, P7 -----------------------------------------------------------------------------------------------
@register("restock", _fc_sql("SELECT * FROM restock"))
def q_restock(spark, sf_dir):
    return restock_rows(spark, sf_dir)


@register("fleet_status", _fc_sql("SELECT * FROM fleet ORDER BY name, product_id"))
def q_fleet_status(spark, sf_dir):
    return fleet(spark, sf_dir).orderBy("name", "product_id")


@register("fleet_urgent", _fc_sql("SELECT * FROM fleet WHERE urgency IN ('STOCKOUT', 'URGENT')"))
def q_fleet_urgent(spark, sf_dir):
    return replenish.fleet_urgent(fleet(spark, sf_dir))


@register(
    "fleet_kpis",
    _fc_sql(
        """SELECT organization_id, COUNT(*) AS products, CAST(SUM(current_inventory) AS BIGINT) AS total_inventory,
       COUNT(*) FILTER (WHERE urgency = 'STOCKOUT') AS stockouts,
       COUNT(*) FILTER (WHERE urgency IN ('URGENT', 'LOW')) AS urgent_or_low,
       COUNT(*) FILTER (WHERE urgency = 'STOCKOUT') AS count_stockout,
       COUNT(*) FILTER (WHERE urgency = 'URGENT') AS count_urgent,
       COUNT(*) FILTER (WHERE urgency = 'LOW') AS count_low,
       COUNT(*) FILTER (WHERE urgency = 'OK') AS count_ok,
       COUNT(*) FILTER (WHERE urgency = 'NO_FORECAST') AS count_no_forecast
FROM fleet GROUP BY organization_id"""
    ),
)
def q_fleet_kpis(spark, sf_dir):
    return replenish.fleet_kpis(fleet(spark, sf_dir))


@register(
    "po_drafts",
    with_views(
        """SELECT q.organization_id, q.product_id, q.supplier_id,
       CASE WHEN e IS NULL THEN 'DRAFT' END AS status, CASE WHEN e IS NULL THEN q.recommended_order_qty END AS quantity, e AS error
FROM (SELECT r.organization_id, r.product_id, r.product_id % 10 AS supplier_id, r.recommended_order_qty,
             CASE WHEN s.supplier_id IS NULL THEN concat('Supplier ', CAST(r.product_id % 10 AS STRING), ' not found')
                  WHEN r.recommended_order_qty <= 0 THEN concat('Product ', CAST(r.product_id AS STRING),
                       '''s recommended order quantity is ', CAST(r.recommended_order_qty AS STRING), ' — no PO needed right now')
             END AS e
      FROM restock r LEFT JOIN suppliers s ON s.supplier_id = r.product_id % 10 AND s.organization_id = r.organization_id) q""",
        *FORECAST_VIEWS,
        "suppliers",
        extra=FORECAST_CTES,
    ),
)
def q_po_drafts(spark, sf_dir):
    # R4 + R7: one request per forecast product, supplier = product_id % 10 of the same org.
    rs = restock_rows(spark, sf_dir)
    reqs = rs.select("organization_id", "product_id", (F.col("product_id") % 10).alias("supplier_id"))
    return replenish.draft_orders(rs, reqs, A.products(spark, sf_dir), A.suppliers(spark, sf_dir))


@register(
    "champion_models",
    _fc_sql(
        """SELECT p.organization_id, p.product_id, p.version, v.run, v.training_rows, v.slope
FROM (SELECT c.organization_id, c.product_id,
             CASE WHEN c.product_id % 2 = 0 AND EXISTS (SELECT 1 FROM versions v WHERE v.organization_id = c.organization_id
                       AND v.product_id = c.product_id AND v.version = 1) THEN 1 ELSE c.version END AS version
      FROM (SELECT organization_id, product_id, max(version) AS version FROM versions GROUP BY ALL) c) p
JOIN versions v ON v.organization_id = p.organization_id AND v.product_id = p.product_id AND v.version = p.version""",
        extra=VERSION_CTES,
    ),
)
def q_champion_models(spark, sf_dir):
    # The serving lookup after the rollback: pointer x version log on (org, product, version).
    v = _versions(spark, sf_dir)
    pointers = FC.champions(v)
    reqs = pointers.filter(F.col("product_id") % 2 == 0).select(
        "organization_id", "product_id", F.lit(1).alias("version"), F.lit(1).alias("request_id")
    )
    newp, _ = FC.rollback(pointers, v, reqs)
    return FC.champion_lookup(newp, v).select(
        "organization_id", "product_id", "version", "run", "training_rows", "slope"
    )
