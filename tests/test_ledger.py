"""Ordered apply: the reference's expected cases, and random batches against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from stockroom.operators import ledger
from tests.brute import apply_sequential

EV = "organization_id int, product_id long, event_id string, event_type string, quantity long, seq long"
RC = "recipe_item_id long, finished_product_id long, component_product_id long, quantity int, organization_id int"


def run(spark, events, recipes=None, log_ids=None, start=None, chunk=1 << 16):
    ev = spark.createDataFrame(events, EV)
    rc = spark.createDataFrame(recipes, RC) if recipes else None
    lg = spark.createDataFrame(log_ids, "organization_id int, event_id string") if log_ids else None
    st = (
        spark.createDataFrame(start, "organization_id int, product_id long, quantity long") if start else None
    )
    out = ledger.apply_batch(ev, log_ids=lg, start_state=st, recipe_items=rc, chunk=chunk)
    rows = out.collect()
    status = {(r.organization_id, r.seq): (r.status, r.error) for r in rows if r.pos == 0}
    bal = {(r.organization_id, r.product_id): r.quantity for r in ledger.final_balances(out).collect()}
    return status, bal


def ev(seq, etype, qty, pid=1, eid=None, org=1):
    return (org, pid, eid or f"e{seq}", etype, qty, seq)


def test_balance_purchase_purchase_sale(spark):
    _, bal = run(spark, [ev(1, "PURCHASE", 50), ev(2, "PURCHASE", 30), ev(3, "SALE", 10)])
    assert bal[(1, 1)] == 70


def test_return_then_damage(spark):
    out = ledger.apply_batch(
        spark.createDataFrame([ev(1, "PURCHASE", 20), ev(2, "RETURN", 10), ev(3, "DAMAGE", 5)], EV),
        groups="product",
    )
    after = {r.seq: r.balance_after for r in out.collect()}
    assert after == {1: 20, 2: 30, 3: 25}


def test_adjustment_may_go_negative(spark):
    status, bal = run(spark, [ev(1, "PURCHASE", 50), ev(2, "ADJUSTMENT", -200), ev(3, "ADJUSTMENT", 200)])
    assert all(s == "success" for s, _ in status.values())
    assert bal[(1, 1)] == 50


def test_oversold_waste_is_refused(spark):
    status, bal = run(spark, [ev(1, "PURCHASE", 5), ev(2, "WASTE", 10)])
    assert status[(1, 2)] == ("failed", "Insufficient inventory")
    assert bal[(1, 1)] == 5


def test_repeat_id_applies_once_and_orgs_are_separate(spark):
    status, bal = run(
        spark,
        [ev(1, "PURCHASE", 50, eid="x"), ev(2, "PURCHASE", 50, eid="x"), ev(3, "PURCHASE", 30, pid=2, eid="x", org=2)],
    )
    assert bal[(1, 1)] == 50 and bal[(2, 2)] == 30
    assert status[(1, 2)] == ("success", None)


def test_repeat_of_refused_id_is_evaluated_again(spark):
    status, bal = run(
        spark, [ev(1, "WASTE", 10, eid="w"), ev(2, "PURCHASE", 20), ev(3, "WASTE", 10, eid="w")]
    )
    assert status[(1, 1)][0] == "failed" and status[(1, 3)] == ("success", None)
    assert bal[(1, 1)] == 10


def test_repeat_with_bad_sign_is_success_when_recorded(spark):
    status, _ = run(spark, [ev(1, "PURCHASE", 5, eid="r"), ev(2, "PURCHASE", -5, eid="r"), ev(3, "SALE", -1)])
    assert status[(1, 2)] == ("success", None)
    assert status[(1, 3)] == ("failed", "SALE quantity must be positive")


def test_cascade_consumes_components(spark):
    recipes = [(1, 10, 11, 1, 1), (2, 10, 12, 2, 1)]
    start = [(1, 10, 10), (1, 11, 20), (1, 12, 20)]
    status, bal = run(spark, [ev(1, "SALE", 3, pid=10)], recipes=recipes, start=start)
    assert status[(1, 1)] == ("success", None)
    assert (bal[(1, 10)], bal[(1, 11)], bal[(1, 12)]) == (7, 17, 14)


def test_cascade_is_all_or_nothing(spark):
    recipes = [(1, 10, 11, 5, 1)]
    start = [(1, 10, 10), (1, 11, 3)]
    status, bal = run(spark, [ev(1, "SALE", 1, pid=10)], recipes=recipes, start=start)
    assert status[(1, 1)] == ("failed", "Insufficient inventory")
    assert (bal[(1, 10)], bal[(1, 11)]) == (10, 3)


def test_already_logged_id_is_a_no_op(spark):
    status, bal = run(spark, [ev(1, "PURCHASE", 9, eid="old")], log_ids=[(1, "old")], start=[(1, 1, 4)])
    assert status[(1, 1)] == ("success", None)
    assert bal[(1, 1)] == 4


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 16), (2, 1 << 16), (3, 7), (4, 1)])
def test_random_batches_match_sequential_evaluation(spark, seed, chunk):
    rnd = random.Random(seed)
    types = ["PURCHASE", "SALE", "DAMAGE", "ADJUSTMENT", "RETURN", "WASTE", "SALE", "SALE"]
    events = []
    for seq in range(1, 400):
        org = rnd.choice([1, 2])
        pid = rnd.randrange(1, 9)
        eid = f"id{rnd.randrange(0, 300)}"  # frequent repeats, across products too
        q = rnd.choice([1, 2, 3, 5, 8, 13, -2, 0])
        events.append((org, pid, eid, rnd.choice(types), q, seq))
    recipes = [(1, 1, 2, 1, 1), (2, 1, 3, 2, 1), (3, 4, 3, 1, 2), (4, 6, 7, 3, 2), (5, 6, 2, 1, 1)]
    log_ids = [(1, "id5"), (2, "id7")]
    start = [(1, 3, 4), (2, 7, 10)]
    status, bal = run(spark, events, recipes=recipes, log_ids=log_ids, start=start, chunk=chunk)
    exp_status, exp_bal = apply_sequential(
        [dict(zip(["organization_id", "product_id", "event_id", "event_type", "quantity", "seq"], e)) for e in events],
        [dict(zip(["recipe_item_id", "finished_product_id", "component_product_id", "quantity", "organization_id"], r))
         for r in recipes],
        log_ids=log_ids,
        start={(o, p): q for o, p, q in start},
    )
    assert status == exp_status
    for k, v in bal.items():
        assert v == exp_bal.get(k, 0), k


def test_cascade_apply_query_matches_brute_force(spark):
    from __spark_entry__ import queries
    from stockroom.sources import adapters as A
    from tests.conftest import SF_SMALL

    out = queries()["cascade_apply"](spark, SF_SMALL).filter("pos = 0").collect()
    got = {(r.organization_id, r.seq): r.status for r in out}
    raw = A.raw_events_e(spark, SF_SMALL).collect()
    rec = A.recipe_items(spark, SF_SMALL).collect()
    exp, _ = apply_sequential(
        [dict(organization_id=r.organization_id, product_id=r.product_id, event_id=r.event_id,
              event_type=r.event_type, quantity=r.raw_quantity, seq=r.id) for r in raw],
        [r.asDict() for r in rec],
    )
    assert got == {k: v[0] for k, v in exp.items()}


def test_groups_join_recipe_chains(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 7, 8), (2, 1, 5)], "organization_id int, a long, b long")
    g = {(r.organization_id, r.product_id): r.group_id for r in ledger.connected_groups(edges).collect()}
    assert g == {(1, 1): 1, (1, 2): 1, (1, 3): 1, (1, 7): 7, (1, 8): 7, (2, 1): 1, (2, 5): 1}


def test_fast_path_marks_clean_groups(spark):
    rows = ledger.annotate(
        ledger.expand_units(spark.createDataFrame([ev(1, "PURCHASE", 5), ev(2, "SALE", 3), ev(3, "SALE", 9, pid=2)], EV)),
        None,
        None,
    ).withColumn("group_id", F.col("product_id"))
    dirty = {r.product_id: r.dirty for r in ledger.fold_fast(rows).collect()}
    assert dirty == {1: False, 2: True}


def test_groups_on_a_long_chain_converge_quickly(spark):
    n = 300
    edges = spark.createDataFrame([(1, i, i + 1) for i in range(n)], "organization_id int, a long, b long")
    g = ledger.connected_groups(edges)
    assert g.count() == n + 1 and {r.group_id for r in g.collect()} == {0}
