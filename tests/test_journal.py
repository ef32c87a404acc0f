"""Tables that change together: crashes, repeated runs, ids, receipts."""

from datetime import datetime

import pytest

from stockroom.operators import journal
from stockroom.sources import batches
from stockroom.sources.store import Store

AT = datetime(2031, 5, 6)


class Crash(RuntimeError):
    pass


@pytest.fixture()
def tables(spark):
    log = spark.createDataFrame(
        [(1, "a", 10, "PURCHASE", 5, AT, 1), (2, "b", 11, "PURCHASE", 7, AT, 1), (5, "po-2-line-21", 10, "PURCHASE", 4, AT, 1)],
        "id long, event_id string, product_id long, event_type string, quantity int, created_at timestamp, organization_id int",
    )
    orders = spark.createDataFrame(
        [(1, 3, 1, "SUBMITTED", AT), (2, 3, 1, "SUBMITTED", AT), (3, 3, 1, "DRAFT", AT), (4, 3, 1, "SUBMITTED", AT)],
        "purchase_order_id long, supplier_id long, organization_id int, status string, created_at timestamp",
    )
    lines = spark.createDataFrame(
        [(11, 1, 10, 2, 1), (12, 1, 12, 3, 1), (21, 2, 10, 4, 1), (22, 2, 11, 1, 1), (31, 3, 10, 9, 1), (41, 4, 99, 1, 1), (42, 4, 10, 1, 1)],
        "line_id long, purchase_order_id long, product_id long, quantity int, organization_id int",
    )
    products = spark.createDataFrame([(p, 1, f"SKU-{p}") for p in (10, 11, 12)], "product_id long, organization_id int, sku string")
    return log, orders, lines, products


def seen(store):
    return {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in store.schemas}


def crash_at(store, k):
    """Let the store fail before its k-th write of a run (the commit file is the last one)."""
    done, stage, point = [0], store.stage, store._point

    def counted(f):
        def call(*args):
            if done[0] == k:
                raise Crash
            done[0] += 1
            return f(*args)

        return call

    store.stage, store._point = counted(stage), counted(point)


def test_receipt_survives_a_crash_between_any_two_writes(spark, tables, tmp_path):
    log, orders, lines, products = tables
    requests = spark.createDataFrame([(i, 1, i) for i in (1, 2, 3, 4, 5)], "purchase_order_id long, organization_id int, request_id long")
    root = str(tmp_path / "journal")
    journal.start(journal.open_journal(spark, root), log, orders)
    receive = lambda store: journal.receive_orders(store, "r1", requests, lines, products, AT, 7)
    old = seen(journal.open_journal(spark, root))
    for k in range(6):
        store = journal.open_journal(spark, root)
        crash_at(store, k)
        with pytest.raises(Crash):
            receive(store)
        assert seen(journal.open_journal(spark, root)) == old
    store = journal.open_journal(spark, root)
    assert store.unpublished("log").count() > 0
    verdicts = {r.purchase_order_id: (r.accepted, r.error) for r in receive(store).collect()}
    assert verdicts == {
        1: (True, None),
        2: (True, None),
        3: (False, "Cannot receive purchase order 3 in status DRAFT"),
        4: (False, "Product 99 not found"),
        5: (False, "Purchase order 5 not found"),
    }
    now = seen(store)
    assert [(r[0], r[1], r[2], r[4], r[7]) for r in now["log"] if r[0] > 5] == [(6, "po-1-line-11", 10, 2, 7), (7, "po-1-line-12", 12, 3, 7), (8, "po-2-line-22", 11, 1, 7)]
    assert {r[1]: r[2] for r in now["state"]} == {10: 11, 11: 8, 12: 3}
    assert {r[0]: r[3] for r in now["orders"]} == {1: "RECEIVED", 2: "RECEIVED", 3: "DRAFT", 4: "SUBMITTED"}
    assert [r[1:4] for r in now["audit"]] == [("po_received", "purchase_order_id=1", 1), ("po_received", "purchase_order_id=2", 1)]
    assert store.mark(journal.LAST_ID) == 8 and store.unpublished("log").count() == 0
    receive(store)
    assert seen(store) == now
    journal.receive_orders(store, "r2", requests.where("purchase_order_id = 1"), lines, products, AT, 7)
    assert {t: r for t, r in seen(store).items() if t != "verdicts"} == {t: r for t, r in now.items() if t != "verdicts"}


def test_a_batch_is_recorded_once_and_carries_on(spark, tables, tmp_path):
    log, _orders, _lines, products = tables
    store = journal.open_journal(spark, str(tmp_path / "journal"))
    journal.start(store, log)
    columns = "organization_id int, row_number long, sku string, event_type string, quantity string, event_id string"
    first = [(1, 1, "SKU-10", "SALE", "6", "s1"), (1, 2, "SKU-10", "SALE", "9", "s2"), (1, 3, "SKU-11", "WASTE", "x", "s3"), (1, 4, "SKU-10", "SALE", "6", "s1"), (1, 5, "no", "SALE", "1", "s4")]
    second = [(1, 1, "SKU-10", "SALE", "3", "s2"), (1, 2, "SKU-10", "SALE", "1", "s5"), (1, 3, "SKU-12", "PURCHASE", "4", "a")]
    crashed = journal.open_journal(spark, store.root)
    crash_at(crashed, 2)
    with pytest.raises(Crash):
        journal.record_batch(crashed, "b1", spark.createDataFrame(first, columns), products, AT, 7)
    for _ in range(2):
        told = journal.record_batch(store, "b1", spark.createDataFrame(first, columns), products, AT, 7).collect()
        assert [tuple(r) for r in told] == [(1, 5, 2, 3)]
    journal.record_batch(store, "b2", spark.createDataFrame(second, columns), products, AT)
    now = seen(store)
    assert [r[:5] + r[7:] for r in now["log"] if r[0] > 5] == [(6, "s1", 10, "SALE", -6, 7), (7, "s2", 10, "SALE", -3, None)]
    assert {r[1]: r[2] for r in now["state"]} == {10: 0, 11: 7}
    assert [r[3] for r in sorted(journal.batch_results(store, "b2").collect(), key=lambda r: r.row_number)] == ["success", "failed", "success"]


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"state": journal.SCHEMAS["state"]}, {"state": journal.KEYS["state"]})
    row = lambda *r: spark.createDataFrame([r], journal.SCHEMAS["state"])
    assert store.read("state").count() == 0 and not store.compact("state")
    assert store.publish("a", {"state": row(1, 1, 5)}) and store.publish("b", {"state": row(1, 2, 6)}) and store.publish("c", {"state": row(1, 1, None)})
    assert not store.publish("b", {"state": row(1, 2, 9)})
    old = seen(store)
    assert old["state"] == [(1, 1, None), (1, 2, 6)]
    assert store.compact("state") and seen(store) == old
    assert len(store.head().tables["state"]) == 1 and store.unpublished("state").count() >= 3


def test_a_failing_check_publishes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"state": journal.SCHEMAS["state"]})

    def check(staged):
        if staged["state"].where("quantity < 0").count():
            raise ValueError("negative")

    row = lambda q: {"state": spark.createDataFrame([(1, 1, q)], journal.SCHEMAS["state"])}
    store.publish("a", row(1), check=check)
    with pytest.raises(ValueError):
        store.publish("b", row(-1), check=check)
    assert [r[2] for r in seen(store)["state"]] == [1]


def test_ids_follow_the_order(spark):
    rows = spark.createDataFrame([((i * 37) % 1000, i % 3) for i in range(1000)], "n long, k int").repartition(7)
    got = batches.numbered_rows(rows, "k", "n").orderBy("k", "n").collect()
    assert [r.row_number for r in got] == list(range(1, 1001))
    assert batches.numbered_rows(rows.where("false"), "n").count() == 0
