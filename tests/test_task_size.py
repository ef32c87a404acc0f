"""What one task holds, reads or writes does not grow with the tables: partitions and files follow the rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockroom.operators import changes, journal, ledger, replenish
from stockroom.plans import journal_queries, publish_queries, stream_queries
from stockroom.sources import adapters as A
from stockroom.sources import tables


@pytest.fixture()
def small(spark, tmp_path):
    """40 orders of 5 lines, one line number twice in each order, and 60 events."""
    orders = [(k, k % 7 + 1, "FOP"[k % 3], date(1995, 1, 1) + timedelta(days=k)) for k in range(1, 41)]
    lines = [(k, min(n, 5), 10 * k + n, 3, float(n), 10.0 * n) for k in range(1, 41) for n in range(1, 7)]
    events = [(k, k % 9, "signup", 2.5, datetime(2024, 1, 1) + timedelta(days=k)) for k in range(60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(k,) for k in range(1, 500)], "p_partkey long").selectExpr("p_partkey", "'part' as p_name", "'unit' as p_type").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, f"region {k}") for k in range(5)], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def test_each_arrival_is_one_batch_of_many_files(spark):
    rows = spark.range(0, 400, 1, 4).withColumn("k", (F.col("id") % 5).cast("int"))
    seen: list[int] = []
    path = stream_queries._arrive(rows, "arrive", spark, F.col("k"), lambda src: seen.append(len(spark.read.parquet(src).inputFiles())))
    assert seen == [4, 8, 12, 16, 20]
    assert spark.read.parquet(path).count() == 400


def test_dedup_source_is_written_by_all_cores(spark, small, monkeypatch):
    caught = {}
    monkeypatch.setattr(stream_queries.jobs, "log_stream", lambda _s, src, _schema, max_files: caught.update(src=src, n=max_files))
    monkeypatch.setattr(stream_queries.jobs, "dedup_stream", lambda *a: (_ for _ in ()).throw(StopIteration))
    monkeypatch.setattr(stream_queries.A, "event_log_l", lambda *_: spark.range(1000))
    with pytest.raises(StopIteration):
        stream_queries.q_stream_dedup(spark, small)
    files = len(spark.read.parquet(caught["src"]).inputFiles())
    assert files == 4 * caught["n"] >= spark.sparkContext.defaultParallelism


def test_lines_spread_by_their_rows(spark, small, monkeypatch):
    few = sorted(A.purchase_order_lines(spark, small).collect())
    monkeypatch.setattr(tables, "TASK_ROWS", 6)
    many = A.purchase_order_lines(spark, small)
    assert many.rdd.getNumPartitions() == 40 > spark.sparkContext.defaultParallelism
    assert sorted(many.collect()) == few and len(few) == 200


def test_receipt_ids_are_tested_in_tasks_by_rows(spark, small, monkeypatch):
    orders, lines = A.purchase_orders(spark, small), A.purchase_order_lines(spark, small)
    seen = spark.createDataFrame([(2, "po-1-line-11"), (2, "po-4-line-41")], "organization_id int, event_id string")
    few = sorted(replenish.receipt_events(orders, lines, seen).collect())
    monkeypatch.setattr(tables, "TASK_ROWS", 6)
    many = replenish.receipt_events(orders, lines, seen, 200)
    assert "Repartition" in many._jdf.queryExecution().logical().toString()
    assert sorted(many.collect()) == few and few


def test_prefix_of_products_needs_no_second_exchange(spark):
    rows = [(1, p, f"e{p}-{n}", "SALE" if n % 3 else "PURCHASE", 2, n) for p in (1, 2, 3) for n in range(1, 7 if p < 3 else 30)]
    events = spark.createDataFrame(rows, "organization_id int, product_id long, event_id string, event_type string, quantity int, seq long")
    plain = ledger.annotate(ledger.expand_units(events), None, None, unique_ids=True).withColumn("group_id", F.col("product_id"))
    plan = ledger.fold_fast(plain, cascades=False, by_product=True)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan

    def told(**how):
        out = ledger.apply_batch(events, groups="product", unique_ids=True, **how)
        return Counter(tuple(r) for r in out.select("product_id", "seq", "status", "applied", "balance_after").collect())

    # product 3 is in several chunks of 8, the others in one
    whole = told()
    assert told(chunk=8) == whole and told(chunk=8, hot_rows=4) == whole
    assert told(chunk=3) == whole and sum(whole.values()) == 41


def test_csv_files_follow_the_rows(spark, small, monkeypatch):
    monkeypatch.setattr(journal_queries, "TASK_ROWS", 10)
    files = journal_queries._csv_files(spark, small, "csv-files")
    made = [f for path in files.values() for f in spark.read.text(path).inputFiles()]
    assert len({f.rsplit("/part-", 1)[1][:5] for f in made}) == 6


def test_lines_are_joined_once_for_receipts_and_snapshots(spark, small, monkeypatch):
    caught = []

    def stop(lines):
        caught.extend(lines.inputFiles())
        raise StopIteration

    monkeypatch.setattr(journal, "receive_orders", lambda _store, _run, _requests, lines, *_: stop(lines))
    monkeypatch.setattr(changes, "po_line_changes", lambda _orders, lines, *_: stop(lines))
    for query, name in ((journal_queries.q_po_receipt, "receipt-lines"), (publish_queries.q_po_line_snapshot, "snapshot-lines")):
        caught.clear()
        with pytest.raises(StopIteration):
            query(spark, small)
        assert caught and all(name in f for f in caught)
