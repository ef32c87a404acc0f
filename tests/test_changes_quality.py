"""Change batches (C1-C4) and data-quality checks on small hand-made frames."""

from stockroom.operators import changes, quality

PRODUCTS = "product_id long, organization_id int, name string, sku string, unit string, created_at timestamp"
RECIPES = "recipe_item_id long, finished_product_id long, component_product_id long, quantity int, organization_id int"


def test_duplicate_sku_first_in_batch_wins(spark):
    snap = spark.createDataFrame([(1, 1, "A", "S-1", None, None)], PRODUCTS)
    ch = spark.createDataFrame(
        [(10, 1, "S-1", "dup of existing", None), (11, 1, "S-2", "new", None), (12, 1, "S-2", "repeat", None),
         (13, 2, "S-1", "other org", None)],
        "change_id long, organization_id int, sku string, name string, unit string",
    )
    new_snap, res = changes.product_inserts(snap, ch)
    got = {r.change_id: (r.status, r.error) for r in res.collect()}
    assert got[10] == ("rejected", "Product with this SKU already exists: S-1")
    assert got[11] == ("inserted", None) and got[12][0] == "rejected" and got[13] == ("inserted", None)
    assert new_snap.count() == 3


def test_recipe_change_reasons_in_check_order(spark):
    prods = spark.createDataFrame([(p, 1, f"P{p}", f"S-{p}", None, None) for p in (1, 2, 3)], PRODUCTS)
    snap = spark.createDataFrame([(100, 1, 2, 1, 1)], RECIPES)
    ch = spark.createDataFrame(
        [
            (1, 1, "insert", None, 1, 1, 2),   # self reference
            (2, 1, "insert", None, 1, 9, 2),   # unknown component
            (3, 1, "insert", None, 1, 2, 2),   # duplicate of existing pair
            (4, 1, "insert", None, 1, 3, 0),   # quantity checked first
            (5, 1, "update", 100, None, None, 5),
            (6, 1, "delete", 999, None, None, None),
            (7, 1, "insert", None, 2, 3, 1),
        ],
        "change_id long, organization_id int, op string, recipe_item_id long, finished_product_id long, "
        "component_product_id long, quantity int",
    )
    new_snap, res = changes.recipe_changes(snap, prods, ch)
    got = {r.change_id: r.error for r in res.collect()}
    assert got[1] == "A product cannot be an ingredient of itself"
    assert got[2] == "Product 9 not found"
    assert got[3] == "Recipe item already exists for finished product 1 and component product 2"
    assert got[4] == "quantity: Input should be greater than 0"
    assert got[5] is None and got[6] == "Recipe item 999 not found" and got[7] is None
    rows = {r.recipe_item_id: r.quantity for r in new_snap.collect()}
    assert rows[100] == 5 and len(rows) == 2


def test_po_line_changes_only_on_draft(spark):
    orders = spark.createDataFrame([(1, 1, "DRAFT"), (2, 1, "SUBMITTED")], "purchase_order_id long, organization_id int, status string")
    lines = spark.createDataFrame(
        [(11, 1, 5, 3, None, 1), (21, 2, 5, 3, None, 1)],
        "line_id long, purchase_order_id long, product_id long, quantity int, unit_cost decimal(10,2), organization_id int",
    )
    prods = spark.createDataFrame([(5, 1, "P", "S-5", None, None)], PRODUCTS)
    ch = spark.createDataFrame(
        [(1, 1, "update", None, 11, None, 4), (2, 1, "delete", None, 21, None, None), (3, 1, "insert", 1, None, 5, 2)],
        "change_id long, organization_id int, op string, purchase_order_id long, line_id long, product_id long, quantity int",
    )
    snap, res = changes.po_line_changes(orders, lines, prods, ch)
    got = {r.change_id: (r.status, r.error) for r in res.collect()}
    assert got[1] == ("applied", None) and got[3] == ("applied", None)
    assert got[2] == ("rejected", "Cannot remove a line from purchase order 2 in status SUBMITTED")
    assert {r.line_id: r.quantity for r in snap.collect()}[11] == 4 and snap.count() == 3


def test_orphans_skip_null_keys(spark):
    child = spark.createDataFrame([(1, 5), (None, 6), (2, 7)], "organization_id int, product_id long")
    parent = spark.createDataFrame([(1, 5)], "organization_id int, product_id long")
    assert quality.orphans(child, parent, ["organization_id", "product_id"]).count() == 1


def test_occurrence_numbers_for_a_hot_key(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    t0 = dt.datetime(2026, 1, 1)
    rows = [(1 if i % 10 else i, t0 + dt.timedelta(hours=i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t timestamp")
    r = quality.occurrence_numbers(df, ["k"], ["t"], F.to_date("t")).filter("k = 1").orderBy("t").collect()
    assert [x.occurrence for x in r] == list(range(1, len(r) + 1))
