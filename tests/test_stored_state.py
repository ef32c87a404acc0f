"""Jobs on stored state: exactly-once export, snapshots, incremental training, the gate, deep pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.operators import analytics, forecast, journal, projection, quality, replenish, warehouse
from stockroom.sources import adapters as A
from stockroom.sources import batches, lake
from stockroom.sources.store import Store
from tests.conftest import SF_SMALL

DAY = dt.datetime(2026, 3, 1, 12)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(i, f"e{i}", i % 3, "PURCHASE", i % 5 + 1, DAY + dt.timedelta(hours=i), 1 + i % 2) for i in range(1, 200)]
    return spark.createDataFrame(rows, S.EVENT_LOG)


def test_export_crash_before_the_commit_leaves_no_trace_for_readers(spark, log, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    lake.export_once(spark, log.where("id <= 120"), root)
    monkeypatch.setattr(Store, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        lake.export_once(spark, log, root)
    monkeypatch.undo()
    assert rows_of(lake.read_committed(spark, root).select(*S.EVENT_LOG_COLUMNS)) == rows_of(log.where("id <= 120"))
    assert lake.uncommitted_files(spark, root).count() > 0
    told = lake.export_once(spark, log, root).first()
    assert (told.rows_exported, told.last_id, told.checkpoint_updated) == (79, 199, True)
    assert rows_of(lake.read_committed(spark, root).select(*S.EVENT_LOG_COLUMNS)) == rows_of(log)
    assert lake.export_once(spark, log, root).first().rows_exported == 0
    assert lake.lake_commits(spark, root).read("partitions").agg(F.sum("rows")).first()[0] == 199
    assert lake.file_order(spark, root).agg(F.sum("out_of_order")).first()[0] == 0


def test_snapshot_reads_only_what_came_after(spark, log, tmp_path, capsys):
    source = str(tmp_path / "log")
    log.write.parquet(source)
    stored = spark.read.parquet(source)
    store = projection.snapshots(spark, str(tmp_path / "snapshot"))
    for upto in (50, 90, 130):
        assert projection.advance_snapshot(store, stored.where(F.col("id") <= upto), most_versions=2)
    assert not projection.advance_snapshot(store, stored.where("id <= 130"))
    assert len(store.head().tables["sums"]) == 1
    now = projection.current_state(store, stored)
    assert rows_of(now) == rows_of(projection.replay_state(log))
    capsys.readouterr()
    now.explain("formatted")
    assert "GreaterThan(id,130)" in capsys.readouterr().out


def test_retraining_adds_only_new_days(spark, tmp_path):
    source = str(tmp_path / "fact")
    events = A.event_log(spark, SF_SMALL)
    fact = warehouse.fact_inventory_events(warehouse.staged_events(events), warehouse.dim_products(A.products(spark, SF_SMALL)))
    fact.write.parquet(source)
    orgs = A.organizations(spark, SF_SMALL)
    last = events.agg(F.max(F.to_date("created_at"))).first()[0]
    store = forecast.training_store(spark, str(tmp_path / "training"))
    first = forecast.retrain(store, spark.read.parquet(source), orgs, str(last - dt.timedelta(days=7)), "one")
    assert first.count() > 0
    # a fact table without the old days gives the same second run: they are not needed
    tail = spark.read.parquet(source).where(F.col("date_id") > str(last - dt.timedelta(days=7)))
    second = forecast.retrain(store, tail, orgs, str(last), "two")
    whole, _, _ = forecast.fit(projection.active_scope(forecast.daily_features(fact), orgs))
    show = lambda df: rows_of(df.select(*forecast.SERIES, "training_rows", F.round("slope", 6), F.round("sigma", 6), "first_ds", "last_ds"))
    assert show(second) == show(whole)
    assert {r.version for r in second.collect()} <= {1, 2} and store.read("champions").count() == whole.count()
    forecast.retrain(store, tail, orgs, str(last), "two")
    assert store.read("versions").where("run = 'two'").count() == whole.count()


def test_gate_keeps_the_old_table(spark, log, tmp_path):
    from stockroom.plans.publish_queries import FACT

    products = spark.createDataFrame([(p, o, f"S{p}") for p, o in ((0, 1), (1, 1), (2, 2))], "product_id long, organization_id int, sku string")
    store = Store(spark, str(tmp_path / "store"), {"fact": FACT})
    sound = warehouse.staged_events(log).join(products, ["product_id", "organization_id"], "left_semi")
    assert set(quality.publish_fact(store, "fact", sound, products, "a").values()) == {0}
    with pytest.raises(quality.QualityError) as refused:
        quality.publish_fact(store, "fact", warehouse.staged_events(log), products, "b")
    assert set(refused.value.failing) == {"org_boundary", "fk_event_product_org"}
    assert store.read("fact").count() == sound.count()


def test_a_deep_page_opens_the_files_of_its_days(spark, tmp_path, capsys):
    rows = [(i, f"e{i}", 1, "PURCHASE", 1, DAY + dt.timedelta(hours=i), 1) for i in range(1, 1000)]
    log = spark.createDataFrame(rows, S.EVENT_LOG)
    root = str(tmp_path / "lake")
    lake.export_once(spark, log, root)
    stored, index = lake.read_lake(spark, root), analytics.day_index(log)
    for offset, descending in ((0, False), (700, False), (700, True), (995, False), (2000, False)):
        page = analytics.deep_page(stored, index, 1, 1, limit=20, offset=offset, descending=descending)
        plain = analytics.event_page(log, 1, 1, limit=20, offset=offset, descending=descending)
        assert [r.id for r in page.collect()] == [r.id for r in plain.collect()]
    first, last, skip = analytics.page_days(index, 1, 1, 20, 700)
    assert (last - first).days <= 1 and 0 <= skip < 24
    page = analytics.deep_page(stored, index, 1, 1, limit=20, offset=700)
    capsys.readouterr()
    page.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert filters and "concat_ws" in filters[0] and str(first) in filters[0]


def test_lookups_name_what_is_unknown(spark):
    products = spark.createDataFrame([(1, 1, "a", "A"), (2, 1, "b", "B"), (1, 2, "c", "C")], "product_id long, organization_id int, name string, sku string")
    state = spark.createDataFrame([(1, 1, 5)], "organization_id int, product_id long, quantity long")
    asked = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (1, 1), (1, None)], "organization_id int, product_id long")
    got = rows_of(projection.stock_lookup(asked, products, state))
    assert got == sorted([(1, 1, 5, None), (1, 1, 5, None), (1, 2, 0, None), (2, 2, None, "Product 2 not found"), (1, None, None, "Product null not found")], key=str)
    items = spark.createDataFrame([(7, 1, 2, 3, 1)], "recipe_item_id long, finished_product_id long, component_product_id long, quantity int, organization_id int")
    found = {(r.organization_id, r.finished_product_id): (r.component_name, r.error) for r in replenish.recipe_lookup(asked, items, products).collect()}
    assert found == {(1, 1): ("b", None), (2, 2): (None, "Product 2 not found"), (1, None): (None, "Product null not found")}


def test_orders_are_made_whole_or_not_at_all(spark, tmp_path):
    products = spark.createDataFrame([(1, 1), (2, 1)], "product_id long, organization_id int")
    suppliers = spark.createDataFrame([(9, 1)], "supplier_id long, organization_id int")
    requests = spark.createDataFrame([(5, 1, 9), (6, 1, 8), (7, 1, 9), (8, 1, 9), (9, 1, 9)], "request_id long, organization_id int, supplier_id long")
    lines = spark.createDataFrame(
        [(5, 2, 2, 4), (5, 1, 1, 3), (6, 1, 1, 1), (7, 1, 1, 1), (7, 3, 66, 1), (7, 2, 77, 1), (8, 1, 1, 0)], "request_id long, position int, product_id long, quantity int"
    ).withColumn("unit_cost", F.lit(1.5).cast("decimal(10,2)"))
    store = journal.open_journal(spark, str(tmp_path / "journal"))
    for run in ("a", "a", "b"):
        verdicts = journal.create_orders(store, run, requests, lines, products, suppliers, DAY)
    got = {r.request_id: (r.purchase_order_id, r.error) for r in verdicts.collect()}
    assert got == {5: (3, None), 6: (None, "Supplier 8 not found"), 7: (None, "Product 77 not found"), 8: (None, "quantity: Input should be greater than 0"), 9: (4, None)}
    assert rows_of(store.read("lines").select("line_id", "purchase_order_id", "product_id")) == [(1, 1, 1), (2, 1, 2), (3, 3, 1), (4, 3, 2)]
    assert {r.status for r in store.read("orders").collect()} == {"DRAFT"} and store.read("orders").count() == 4


def test_a_quoted_line_break_stays_in_its_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text('sku,event_type,quantity,event_id,note\nA,SALE,1,e1,"one\ntwo"\nB,SALE,2,"e ""2""\nx",n\n')
    (tmp_path / "b.csv").write_text("event_id,sku,event_type,quantity\ne3,C,SALE,3\n")
    got = batches.read_csv_batch(spark, str(tmp_path), 1).orderBy("row_number").collect()
    assert [(r.row_number, r.sku, r.quantity, r.event_id) for r in got] == [(1, "A", "1", "e1"), (2, "B", "2", 'e "2"\nx'), (3, "C", "3", "e3")]
