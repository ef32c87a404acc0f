"""Ingest validation, webhook and CSV sources, forecast quality gate, restock and PO flows."""

import numpy as np
import os

import pandas as pd
import pytest

from stockroom import schemas as S
from stockroom.operators import forecast as FC
from stockroom.operators import ingest, replenish
from stockroom.sources import batches

ROWS = "organization_id int, row_number long, sku string, event_type string, quantity string, event_id string"
PRODUCTS = "product_id long, organization_id int, name string, sku string, unit string, created_at timestamp"


def test_mixed_batch_one_good_one_unknown_sku(spark):
    rows = spark.createDataFrame([(1, 1, "SKU-1", "PURCHASE", "5", "x1"), (1, 2, "NOPE", "PURCHASE", "5", "x2")], ROWS)
    prods = spark.createDataFrame([(1, 1, "Widget", "SKU-1", None, None)], PRODUCTS)
    res, _ = ingest.ingest(rows, prods)
    out = {r.row_number: (r.status, r.error) for r in res.collect()}
    assert out == {1: ("success", None), 2: ("failed", "Product with SKU 'NOPE' not found")}
    s = ingest.summary(res).first()
    assert (s.rows_processed, s.rows_succeeded, s.rows_failed) == (2, 1, 1)


def test_first_failing_field_is_reported(spark):
    rows = spark.createDataFrame(
        [
            (1, 1, "", "NOPE", "x", ""),
            (1, 2, "SKU-1", "NOPE", "x", ""),
            (1, 3, "SKU-1", "SALE", "1.5", "e"),
            (1, 4, "SKU-1", "SALE", "0", "e"),
            (1, 5, "SKU-1", "SALE", " 3 ", ""),
            (1, 6, "SKU-1", "SALE", "2.0", "e6"),
        ],
        ROWS,
    )
    errs = {r.row_number: r.error for r in ingest.validate(rows).collect()}
    assert errs == {
        1: S.MSG_FIELD_SKU,
        2: S.MSG_FIELD_TYPE,
        3: S.MSG_FIELD_QTY_INT,
        4: S.MSG_FIELD_QTY_ZERO,
        5: S.MSG_FIELD_EVENT_ID,
        6: None,
    }


def test_csv_batch_requires_columns_and_numbers_rows(spark, tmp_path):
    path, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    os.mkdir(path)
    os.mkdir(bad)
    pd.DataFrame({"sku": ["A", "B"], "event_type": ["SALE", "PURCHASE"], "quantity": ["1", "2"],
                  "event_id": ["e1", "e2"], "extra": ["x", "y"]}).to_csv(f"{path}/batch.csv", index=False)
    b = batches.read_csv_batch(spark, path, organization_id=3).orderBy("row_number").collect()
    assert [(r.row_number, r.sku, r.organization_id) for r in b] == [(1, "A", 3), (2, "B", 3)]
    assert "extra" not in b[0].asDict()
    pd.DataFrame({"sku": ["A"], "quantity": ["1"]}).to_csv(f"{bad}/b.csv", index=False)
    with pytest.raises(batches.MissingColumnsError):
        batches.read_csv_batch(spark, bad, organization_id=1)


def test_webhook_namespacing_and_size_limit(spark):
    orgs = spark.createDataFrame([(1, "org", True)], "organization_id int, name string, is_active boolean")
    item = '{"sku": "SKU-1", "event_type": "SALE", "quantity": 2, "external_id": "ord-9"}'
    small = '{"source": "shop", "events": [' + item + "]}"
    big = '{"source": "shop", "events": [' + ",".join([item] * 1001) + "]}"
    payloads = spark.createDataFrame([(1, 0, small), (1, 1, big), (7, 2, small)], "organization_id int, batch long, body string")
    rows, refused = batches.parse_webhooks(payloads, orgs, max_events=1000)
    r = rows.collect()
    assert [(x.batch, x.row_number, x.event_id, x.quantity) for x in r] == [(0, 1, "shop:ord-9", "2")]
    reasons = {x.batch: x.reason for x in refused.collect()}
    assert reasons == {1: "events: more than 1000 items", 2: "unknown organization"}


def test_backtest_weekly_model_beats_trend_on_seeded_series(spark):
    rng = np.random.default_rng(7)
    pattern = [0.8, 0.85, 0.95, 1.0, 1.3, 1.9, 1.4]
    days = pd.date_range("2026-01-05", periods=28, freq="D")
    y = [max(1.0, 40 * pattern[d.weekday()] + rng.normal(0, 5)) for d in days]
    feats = spark.createDataFrame(
        [(1, 1, d.strftime("%Y-%m-%d"), int(round(v))) for d, v in zip(days, y)],
        "organization_id int, product_id long, date string, units_sold long",
    )
    bt = FC.backtest(feats).first()
    assert bt.weekly_passes and bt.mae_weekly < 0.7 * bt.mae_trend


def test_short_series_are_skipped_not_failed(spark):
    feats = spark.createDataFrame(
        [(1, 1, f"2026-01-{d:02d}", 3) for d in range(1, 8)], "organization_id int, product_id long, date string, units_sold long"
    )
    models, _, skipped = FC.fit(feats)
    assert models.count() == 0 and skipped.first().training_rows == 7


def test_forecast_starts_after_last_history_day_and_bands_are_ordered(spark):
    feats = spark.createDataFrame(
        [(1, 1, f"2026-01-{d:02d}", d % 7 + 1) for d in range(1, 22)], "organization_id int, product_id long, date string, units_sold long"
    )
    models, effects, _ = FC.fit(feats)
    fc = FC.forecast(models, effects, 7).orderBy("ds").collect()
    assert str(fc[0].ds) == "2026-01-22" and len(fc) == 7
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in fc)


def test_fourier_estimator_returns_horizon(spark):
    feats = spark.createDataFrame(
        [(1, 1, f"2026-01-{d:02d}", d % 7 + 1) for d in range(1, 29)], "organization_id int, product_id long, date string, units_sold long"
    )
    out = FC.fit_fourier(feats, days=7).collect()
    assert len(out) == 7 and all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)


def _restock(spark, stock, demand):
    st = spark.createDataFrame([(1, 1, stock)], "organization_id int, product_id long, quantity long")
    dm = spark.createDataFrame([(1, 1, float(demand))], "organization_id int, product_id long, projected_demand double")
    return replenish.restock(st, dm).first()


def test_restock_stockout_and_ok(spark):
    r = _restock(spark, 0, 105)
    assert (r.urgency, r.projected_demand_7d, r.safety_stock, r.recommended_order_qty) == ("STOCKOUT", 105.0, 21, 126)
    r = _restock(spark, 500, 105)
    assert (r.urgency, r.recommended_order_qty) == ("OK", 0)
    r = _restock(spark, -5, 0)
    assert (r.urgency, r.days_of_stock_remaining) == ("OK", 999)


def test_fleet_without_model_is_no_forecast_even_at_zero_stock(spark):
    prods = spark.createDataFrame([(1, 1, "A", "S-1", None, None), (2, 1, "B", "S-2", None, None)], PRODUCTS)
    stock = spark.createDataFrame([(1, 2, 4)], "organization_id int, product_id long, quantity long")
    rs = spark.createDataFrame([], "organization_id int, product_id long, current_inventory long, projected_demand_7d double, "
                               "safety_stock long, recommended_order_qty long, days_of_stock_remaining long, urgency string")
    f = {r.product_id: (r.urgency, r.current_inventory) for r in replenish.fleet_status(prods, stock, rs).collect()}
    assert f == {1: ("NO_FORECAST", 0), 2: ("NO_FORECAST", 4)}
    k = replenish.fleet_kpis(replenish.fleet_status(prods, stock, rs)).first()
    assert (k.products, k.count_no_forecast, k.count_stockout) == (2, 2, 0)


def test_po_receive_retry_applies_each_line_once(spark):
    orders = spark.createDataFrame([(10, 1, 1, "SUBMITTED", None)], "purchase_order_id long, supplier_id long, organization_id int, status string, created_at timestamp")
    lines = spark.createDataFrame([(101, 10, 1, 50, None, 1), (102, 10, 2, 20, None, 1)],
                                  "line_id long, purchase_order_id long, product_id long, quantity int, unit_cost decimal(10,2), organization_id int")
    first = replenish.receipt_events(orders, lines.filter("line_id = 101"))
    retry = replenish.receipt_events(orders, lines, first.select("organization_id", "event_id"))
    got = {r.event_id: r.already_recorded for r in retry.collect()}
    assert got == {"po-10-line-101": True, "po-10-line-102": False}


def test_po_transitions(spark):
    orders = spark.createDataFrame([(1, 1, "DRAFT"), (2, 1, "DRAFT"), (3, 1, "RECEIVED")], "purchase_order_id long, organization_id int, status string")
    lines = spark.createDataFrame([(11, 1)], "line_id long, purchase_order_id long")
    reqs = spark.createDataFrame([(1, 1, "submit"), (2, 1, "submit"), (3, 1, "receive")], "purchase_order_id long, organization_id int, action string")
    t = {r.purchase_order_id: (r.accepted, r.new_status, r.error) for r in replenish.po_transitions(orders, lines, reqs).collect()}
    assert t[1] == (True, "SUBMITTED", None)
    assert t[2] == (False, "DRAFT", "Cannot submit (no lines) purchase order 2 in status DRAFT")
    assert t[3] == (False, "RECEIVED", "Cannot receive purchase order 3 in status RECEIVED")


def test_ingest_second_time_adds_nothing(spark):
    rows = spark.createDataFrame([(1, 1, "SKU-1", "PURCHASE", "5", "x1"), (1, 2, "SKU-1", "SALE", "2", "x2")], ROWS)
    prods = spark.createDataFrame([(1, 1, "Widget", "SKU-1", None, None)], PRODUCTS)
    _, folded = ingest.ingest(rows, prods)
    from stockroom.operators import ledger

    first_log = ledger.accepted_events(folded).select("organization_id", "event_id")
    res2, folded2 = ingest.ingest(rows, prods, log=first_log)
    assert ledger.accepted_events(folded2).count() == 0
    assert {r.status for r in res2.collect()} == {"success"}
