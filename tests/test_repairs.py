"""Batches and streams that used to go wrong: arrival order, repeated runs, retries, unknown requests."""

import pytest

from stockroom import session
from stockroom.operators import changes, ingest, replenish
from stockroom.operators import forecast as FC
from stockroom.sources import batches, lake
from stockroom.streaming import jobs
from tests.test_changes_quality import PRODUCTS, RECIPES

LOG = "id long, event_id string, product_id long, event_type string, quantity int, created_at timestamp, organization_id int"


def test_two_payloads_are_ingested_in_arrival_order(spark):
    body = '{"source": "s", "events": [{"sku": "A", "event_type": "%s", "quantity": %d, "external_id": "%s"}]}'
    payloads = spark.createDataFrame(
        [(1, 0, body % ("PURCHASE", 5, "p")), (1, 1, body % ("SALE", 7, "q")), (1, 2, body % ("SALE", 5, "r"))],
        "organization_id int, batch long, body string",
    )
    orgs = spark.createDataFrame([(1,)], "organization_id int")
    products = spark.createDataFrame([(9, 1, "A", "A", None, None)], PRODUCTS)
    rows, _ = batches.parse_webhooks(payloads, orgs)
    results, _ = ingest.ingest(batches.arrival_order(rows).drop("batch"), products)
    got = {r.row_number: (r.status, r.error) for r in results.collect()}
    assert got == {1: ("success", None), 2: ("failed", "Insufficient inventory"), 3: ("success", None)}


def test_payload_size_is_no_limit_unless_asked_and_bodies_come_back(spark):
    items = ", ".join('{"sku": "A", "event_type": "SALE", "quantity": 1, "external_id": "e%d"}' % i for i in range(1500))
    payloads = spark.createDataFrame([(1, 0, '{"source": "s", "events": [%s]}' % items), (1, 1, "no json")], "organization_id int, batch long, body string")
    orgs = spark.createDataFrame([(1,)], "organization_id int")
    rows, refused = batches.parse_webhooks(payloads, orgs)
    assert rows.count() == 1500 and [(r.batch, r.body) for r in refused.collect()] == [(1, "no json")]
    rows, refused = batches.parse_webhooks(payloads, orgs, max_events=1000)
    assert rows.count() == 0 and {r.reason for r in refused.collect()} == {"events: more than 1000 items", "malformed payload"}


def test_csv_files_are_read_by_column_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('sku,event_type,quantity,event_id\nS1,SALE,2,e1\n"S ""x""",SALE,3,e2\n')
    (tmp_path / "b.csv").write_text("note,event_id,quantity,sku,event_type\nn,e3,4,S3,PURCHASE\n")
    rows = batches.read_csv_batch(spark, str(tmp_path), 1).orderBy("row_number").collect()
    assert [(r.row_number, r.sku, r.event_type, r.quantity, r.event_id) for r in rows] == [
        (1, "S1", "SALE", "2", "e1"),
        (2, 'S "x"', "SALE", "3", "e2"),
        (3, "S3", "PURCHASE", "4", "e3"),
    ]
    (tmp_path / "c.csv").write_text("sku,quantity\nS,1\n")
    with pytest.raises(batches.MissingColumnsError):
        batches.read_csv_batch(spark, str(tmp_path), 1)


def test_a_full_export_may_be_repeated(spark, tmp_path):
    import datetime as dt

    log = spark.createDataFrame([(i, f"e{i}", 1, "SALE", -1, dt.datetime(2024, 1, 1 + i % 3), 1) for i in range(1, 10)], LOG)
    root = str(tmp_path / "lake")
    first = lake.export_events(spark, log, root, incremental_mode=False).first()
    again = lake.export_events(spark, log, root, incremental_mode=False).first()
    assert first == again and (first.rows_exported, first.partitions_written, first.files_written) == (9, 3, 3)
    assert lake.read_lake(spark, root).count() == 9 and lake.read_manifest(spark, root).count() == 3
    more = log.unionByName(spark.createDataFrame([(10, "e10", 1, "SALE", -1, dt.datetime(2024, 1, 1), 1)], LOG))
    step = lake.export_events(spark, more, root).first()
    assert (step.rows_exported, step.files_written, step.last_id) == (1, 1, 10)
    assert lake.export_events(spark, more, root).first().checkpoint_updated is False
    assert lake.read_lake(spark, root).count() == 10


def test_order_requests_are_judged_in_sequence(spark):
    orders = spark.createDataFrame([(1, 1, "DRAFT"), (2, 1, "DRAFT"), (3, 1, "SUBMITTED")], "purchase_order_id long, organization_id int, status string")
    lines = spark.createDataFrame([(11, 1, 5, 3, None, 1), (31, 3, 5, 3, None, 1)], "line_id long, purchase_order_id long, product_id long, quantity int, unit_cost decimal(10,2), organization_id int")
    asked = [(1, "receive"), (1, "cancel"), (1, "submit"), (1, "submit"), (1, "receive"), (1, "receive"), (2, "submit"), (3, "receive"), (3, "submit"), (4, "submit"), (1, None)]
    reqs = spark.createDataFrame([(po, 1, i, a) for i, (po, a) in enumerate(asked)], "purchase_order_id long, organization_id int, request_id long, action string")
    got = {r.request_id: (r.old_status, r.new_status, r.accepted) for r in replenish.po_transitions(orders, lines, reqs).collect()}
    assert got == {
        0: ("DRAFT", "DRAFT", False), 1: ("DRAFT", "DRAFT", False), 2: ("DRAFT", "SUBMITTED", True), 3: ("SUBMITTED", "SUBMITTED", False),
        4: ("SUBMITTED", "RECEIVED", True), 5: ("RECEIVED", "RECEIVED", False), 6: ("DRAFT", "DRAFT", False), 7: ("SUBMITTED", "RECEIVED", True),
        8: ("RECEIVED", "RECEIVED", False), 9: (None, None, False), 10: ("RECEIVED", "RECEIVED", False),
    }


def test_recipe_requests_of_a_pair_take_effect_in_order(spark):
    prods = spark.createDataFrame([(p, 1, f"P{p}", f"S-{p}", None, None) for p in (1, 2, 3)], PRODUCTS)
    snap = spark.createDataFrame([(100, 1, 2, 1, 1)], RECIPES)
    ch = spark.createDataFrame(
        [
            (1, 1, "update", 100, None, None, 7),
            (2, 1, "update", 100, None, None, 9),
            (3, 1, "delete", 100, None, None, None),
            (4, 1, "insert", None, 1, 2, 4),
            (5, 1, "update", 100, None, None, 5),
            (6, 1, "update", 104, None, None, 6),
            (7, 1, "insert", None, 1, 3, 0),  # refused: leaves no trace for the next one
            (8, 1, "insert", None, 1, 3, 2),
        ],
        "change_id long, organization_id int, op string, recipe_item_id long, finished_product_id long, component_product_id long, quantity int",
    )
    new, res = changes.recipe_changes(snap, prods, ch)
    assert {r.change_id for r in res.collect() if r.status == "rejected"} == {5, 7}
    assert sorted((r.recipe_item_id, r.component_product_id, r.quantity) for r in new.collect()) == [(104, 2, 6), (108, 3, 2)]


def test_line_requests_in_order_with_costs(spark):
    orders = spark.createDataFrame([(1, 1, "DRAFT")], "purchase_order_id long, organization_id int, status string")
    lines = spark.createDataFrame([(11, 1, 5, 3, None, 1)], "line_id long, purchase_order_id long, product_id long, quantity int, unit_cost decimal(10,2), organization_id int")
    prods = spark.createDataFrame([(5, 1, "P", "S-5", None, None)], PRODUCTS)
    ch = spark.createDataFrame(
        [(1, 1, "update", None, 11, None, 4, 2.5), (2, 1, "update", None, 11, None, 6, 3.5), (3, 1, "insert", 1, None, 5, 2, 1.25), (4, 1, "update", None, 14, None, 8, 9.0),
         (5, 1, "delete", None, 14, None, None, None), (6, 1, "update", None, 14, None, 1, 1.0), (7, 1, "insert", 1, None, 5, 3, None)],
        "change_id long, organization_id int, op string, purchase_order_id long, line_id long, product_id long, quantity int, unit_cost double",
    )
    new, res = changes.po_line_changes(orders, lines, prods, ch)
    assert {r.change_id: r.error for r in res.collect() if r.error} == {6: "Purchase order line 14 not found"}
    rows = {r.line_id: (r.quantity, None if r.unit_cost is None else float(r.unit_cost)) for r in new.collect()}
    assert rows == {11: (6, 3.5), 18: (3, None)}


def test_the_last_rollback_request_holds(spark):
    pointers = spark.createDataFrame([(1, 5, 3)], "organization_id int, product_id long, version int")
    versions = spark.createDataFrame([(1, 5, v) for v in (1, 2, 3)], "organization_id int, product_id long, version int")
    reqs = spark.createDataFrame([(1, 5, 1, 1), (1, 5, 2, 2), (1, 5, 9, 3)], "organization_id int, product_id long, version int, request_id int")
    new, rejects = FC.rollback(pointers, versions, reqs)
    assert [r.version for r in new.collect()] == [2] and rejects.count() == 1


def test_a_replayed_micro_batch_replaces_itself(spark, tmp_path):
    import datetime as dt

    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    for i in (1, 2):
        spark.createDataFrame([(i, f"e{i}", 7, "SALE", -i, dt.datetime(2024, 1, 1), 1)], LOG).coalesce(1).write.mode("append").parquet(src)
        jobs.projection_stream(jobs.log_stream(spark, src), out, mark)
    for name in ("1", ".1.crc"):  # as if the second batch had not been committed
        (tmp_path / "mark" / "commits" / name).unlink(missing_ok=True)
    jobs.projection_stream(jobs.log_stream(spark, src), out, mark)
    rows = jobs.latest_per_key(spark, out, ["organization_id", "product_id"]).collect()
    assert [(r.product_id, r.quantity) for r in rows] == [(7, -3)]
    jobs.compact(spark, out, ["organization_id", "product_id"], str(tmp_path / "small"))
    assert jobs.latest_per_key(spark, str(tmp_path / "small"), ["organization_id", "product_id"]).count() == 1


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:1"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError):
        session.checkpoint_root(Session())
