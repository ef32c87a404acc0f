"""Warehouse, lake export, replay and paging cases of the reference's test suite."""

import datetime as dt

from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.operators import analytics, projection, quality, warehouse
from stockroom.session import work_dir
from stockroom.sources import lake

T0 = dt.datetime(2026, 1, 5, 10, 0, 0)


def log_rows(spark, rows):
    """rows: (id, event_id, product_id, event_type, quantity, created_at, org)"""
    return spark.createDataFrame(rows, S.EVENT_LOG)


def products(spark, rows):
    return spark.createDataFrame(
        rows, "product_id long, organization_id int, name string, sku string, unit string, created_at timestamp"
    )


def test_running_balance_reaches_70(spark):
    log = log_rows(
        spark,
        [
            (1, "a", 1, "PURCHASE", 50, T0, 1),
            (2, "b", 1, "PURCHASE", 30, T0 + dt.timedelta(days=1), 1),
            (3, "c", 1, "SALE", -10, T0 + dt.timedelta(days=2), 1),
        ],
    )
    prods = products(spark, [(1, 1, "Widget", "W-1", None, T0)])
    fact = warehouse.fact_inventory_events(warehouse.staged_events(log), warehouse.dim_products(prods))
    rb = analytics.running_balance(fact).orderBy("date_id").collect()
    assert [r.running_balance for r in rb] == [50, 80, 70]


def test_same_day_rows_share_the_range_frame_value(spark):
    log = log_rows(spark, [(1, "a", 1, "PURCHASE", 5, T0, 1), (2, "b", 1, "PURCHASE", 7, T0, 1)])
    prods = products(spark, [(1, 1, "Widget", "W-1", None, T0)])
    fact = warehouse.fact_inventory_events(warehouse.staged_events(log), warehouse.dim_products(prods))
    assert {r.running_balance for r in analytics.running_balance(fact).collect()} == {12}


def test_dim_dates_january(spark):
    d = warehouse.dim_dates(spark, "2026-01-01", "2026-01-31").collect()
    assert len(d) == 31
    jan3 = [r for r in d if r.date_id == "2026-01-03"][0]
    assert jan3.is_weekend and jan3.day_of_week == "Saturday" and jan3.quarter == 1


def test_export_full_incremental_empty_and_checkpoint(spark):
    root = work_dir(spark, "t-export")
    first = log_rows(spark, [(5, "a", 1, "PURCHASE", 5, T0, 1), (2, "b", 2, "PURCHASE", 3, T0 + dt.timedelta(days=1), 2)])
    s1 = lake.export_events(spark, first, root, incremental_mode=False).first()
    assert (s1.rows_exported, s1.partitions_written, s1.mode, s1.checkpoint_updated) == (2, 2, "full", True)
    # checkpoint is max(id), not the id of the latest timestamp (which would be 2)
    assert lake.load_checkpoint(spark, root) == 5
    grown = first.unionByName(log_rows(spark, [(6, "c", 1, "SALE", -1, T0, 1)]))
    s2 = lake.export_events(spark, grown, root).first()
    assert (s2.rows_exported, s2.mode) == (1, "incremental")
    s3 = lake.export_events(spark, grown, root).first()
    assert (s3.rows_exported, s3.checkpoint_updated) == (0, False)
    back = lake.read_lake(spark, root)
    assert back.count() == 3
    files = spark.read.option("recursiveFileLookup", "true").parquet(lake.events_path(root))
    assert set(files.columns) == set(S.EVENT_LOG_COLUMNS)
    paths = {r.p for r in back.select(F.input_file_name().alias("p")).collect()}
    assert any("org_id=1/year=2026/month=01/day=05" in p for p in paths)


def test_schema_drift_legacy_file_drops_out_of_fact(spark):
    root = work_dir(spark, "t-drift")
    cur = log_rows(spark, [(1, "a", 1, "PURCHASE", 5, T0, 1)])
    lake.export_events(spark, cur, root, incremental_mode=False)
    legacy = spark.createDataFrame([(999, "old", 1, "PURCHASE", 9, T0)], S.LEGACY_EVENT_LOG)
    legacy.write.parquet(f"{lake.events_path(root)}/legacy")
    scanned = lake.read_lake(spark, root, legacy_files=True)
    assert scanned.count() == 2 and scanned.filter("organization_id IS NULL").count() == 1
    prods = products(spark, [(1, 1, "Widget", "W-1", None, T0)])
    fact = warehouse.fact_inventory_events(warehouse.staged_events(scanned), warehouse.dim_products(prods))
    assert fact.count() == 1


def test_export_validation_sees_duplicates(spark):
    src = log_rows(spark, [(1, "a", 1, "PURCHASE", 5, T0, 1), (2, "b", 1, "PURCHASE", 5, T0, 1)])
    lake_rows = src.unionByName(src.limit(1))
    v = quality.export_validation(src, lake_rows).first()
    assert (v.db_rows, v.parquet_rows, v.row_count_match, v.duplicate_event_ids, v.schema_valid) == (2, 3, False, 1, True)


def test_replay_and_summary(spark):
    log = log_rows(spark, [(1, "a", 1, "PURCHASE", 50, T0, 1), (2, "b", 1, "SALE", -10, T0, 1)])
    assert projection.replay_state(log).first().quantity == 40
    s = projection.replay_summary(log).first()
    assert (s.events_processed, s.products_rebuilt) == (2, 1)


def test_replay_leaves_other_tenants_alone(spark):
    log = log_rows(spark, [(1, "a", 1, "PURCHASE", 50, T0, 1), (2, "a", 2, "PURCHASE", 7, T0, 2)])
    assert [(r.organization_id, r.quantity) for r in projection.replay_state(log, org=2).collect()] == [(2, 7)]


def test_pagination_25_events_in_pages_of_20(spark):
    rows = [(i, f"e{i}", 1, "PURCHASE", 1, T0 + dt.timedelta(minutes=i), 1) for i in range(25)]
    log = log_rows(spark, rows)
    p1 = analytics.event_pages_per_product(log, page=1).count()
    p2 = analytics.event_pages_per_product(log, page=2).count()
    n = analytics.event_count(log).first()
    assert (p1, p2, n.event_count, n.pages) == (20, 5, 25, 2)
    page = analytics.event_page(log, product_id=1, org=1, limit=10, offset=20).collect()
    assert [r.id for r in page] == [20, 21, 22, 23, 24]


def test_org_boundary_check(spark):
    fact = spark.createDataFrame([("e1", 1, 2)], "event_id string, product_id long, organization_id int")
    dim = spark.createDataFrame([(1, 1)], "product_id long, organization_id int")
    assert quality.org_boundary_violations(fact, dim).count() == 1
