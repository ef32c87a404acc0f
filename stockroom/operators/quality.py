"""Data-quality checks and export validation.

Each check is a DataFrame of failing rows; the report counts them in one job per check and
unions the one-row results (``check``, ``failing_rows``, ``passed``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.sources.store import Store


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Q1: keys occurring more than once (one row per extra occurrence count)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows with a NULL in ``column``."""
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str] | None = None) -> DataFrame:
    """Q3/Q5: child rows whose (non-NULL) key has no parent row (MATCH SIMPLE: NULL skips)."""
    parent_key = parent_key or child_key
    p = parent.select(*[F.col(pk).alias(ck) for ck, pk in zip(child_key, parent_key)]).distinct()
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_key])
    return child.filter(nonnull).join(p, child_key, "left_anti")


def org_boundary_violations(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Fact rows whose org differs from their product's org (equi-join + theta residual)."""
    p = dim_products.select("product_id", F.col("organization_id").alias("product_organization_id"))
    return fact.join(p, "product_id", "inner").filter(
        F.col("organization_id") != F.col("product_organization_id")
    ).select(
        "event_id", "product_id", F.col("organization_id").alias("fact_organization_id"), "product_organization_id"
    )


def check_row(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check"), "failing_rows", (F.col("failing_rows") == 0).alias("passed")
    )


def _row_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Row-level predicates of one table counted in a single scan, one output row per check."""
    return _counted(df, {name: F.count_if(pred) for name, pred in checks.items()})


def _counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One output row per check from one aggregation of ``df``."""
    counts = df.agg(*[count.cast("long").alias(name) for name, count in checks.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return counts.selectExpr(f"stack({len(checks)}, {pairs}) as (check, failing_rows)").select(
        "check", "failing_rows", (F.col("failing_rows") == 0).alias("passed")
    )


def dq_report(
    events: DataFrame,
    dim_products: DataFrame,
    recipe_items: DataFrame,
    purchase_orders: DataFrame,
    po_lines: DataFrame,
    suppliers: DataFrame,
    unique_key: tuple[str, ...] = ("organization_id", "event_id"),
) -> DataFrame:
    """Q7: one row per check; any failing check should stop a scheduled run.

    Row-level rules are folded into one aggregation per table; those of events and all rules that
    relate events to products share one scan and one join. Other key rules are one aggregation or
    anti-join each.
    """
    c = F.col
    row_rules = [
        _counted(events.join(_orgs_of_products(dim_products), "product_id", "left"), _event_rules()),
        _row_checks(
            recipe_items,
            {
                "check_recipe_quantity_positive": c("quantity") <= 0,
                "check_recipe_not_self": c("finished_product_id") == c("component_product_id"),
            },
        ),
        _row_checks(
            po_lines,
            {
                "check_po_line_quantity_positive": c("quantity") <= 0,
                "check_unit_cost_nonnegative": c("unit_cost") < 0,
            },
        ),
        _row_checks(purchase_orders, {"check_po_status_domain": ~c("status").isin(*S.PO_STATUSES)}),
        _row_checks(dim_products, {"check_sku_length": ~F.length("sku").between(1, S.MAX_TEXT_LEN)}),
    ]
    key_rules = {
        "unique_event_key": duplicate_keys(events, list(unique_key)),
        "fk_recipe_finished": orphans(
            recipe_items, dim_products, ["organization_id", "finished_product_id"], ["organization_id", "product_id"]
        ),
        "fk_recipe_component": orphans(
            recipe_items, dim_products, ["organization_id", "component_product_id"], ["organization_id", "product_id"]
        ),
        "fk_po_supplier": orphans(
            purchase_orders, suppliers, ["organization_id", "supplier_id"], ["organization_id", "supplier_id"]
        ),
        "fk_po_line_po": orphans(
            po_lines, purchase_orders, ["organization_id", "purchase_order_id"], ["organization_id", "purchase_order_id"]
        ),
        "fk_po_line_product": orphans(
            po_lines, dim_products, ["organization_id", "product_id"], ["organization_id", "product_id"]
        ),
    }
    rows = row_rules + [check_row(n, df) for n, df in key_rules.items()]
    return reduce(DataFrame.unionByName, rows)


def catalogue_report(products: DataFrame, suppliers: DataFrame, state: DataFrame, log: DataFrame, users: DataFrame) -> DataFrame:
    """Q5 + Q6 beyond the log: every balance and every actor belongs to its organization (an event
    without an actor is sound), and the texts of the catalogue have their lengths. ``log`` has
    created_by_id; ``users``: organization_id, user_id."""
    long = lambda c, most: F.count_if(~F.coalesce(F.length(c).between(1, most), F.lit(False)))
    texts = _counted(products, {
        "check_product_name_length": long("name", 255),
        "check_product_sku_length": long("sku", S.MAX_TEXT_LEN),
        "check_product_unit_length": F.count_if(F.length("unit") > 20),
    })
    key = ["organization_id", "product_id"]
    rows = [
        texts,
        _counted(suppliers, {"check_supplier_name_length": long("name", 255)}),
        check_row("fk_state_product_org", orphans(state, products, key)),
        check_row("fk_event_actor_org", orphans(log, users, ["organization_id", "created_by_id"], ["organization_id", "user_id"])),
        check_row("unique_state_key", duplicate_keys(state, key)),
    ]
    return reduce(DataFrame.unionByName, rows)


# ---- Q7 as a gate ------------------------------------------------------------------------------------------
class QualityError(ValueError):
    """A publish was refused; ``failing`` has the failing rows of each failing check."""

    def __init__(self, failing: dict[str, int]) -> None:
        super().__init__("; ".join(f"{name}: {n}" for name, n in sorted(failing.items())))
        self.failing = failing


def _orgs_of_products(dim_products: DataFrame) -> DataFrame:
    """The organizations of each product id (one, unless the dimension is broken)."""
    return dim_products.groupBy("product_id").agg(F.collect_set("organization_id").alias("_orgs"))


def _event_rules() -> dict[str, Column]:
    """Counts of the row and product rules of events that were joined with ``_orgs_of_products``."""
    c = F.col
    known, here = c("_orgs").isNotNull(), F.array_contains("_orgs", c("organization_id"))
    others = F.size(F.filter("_orgs", lambda o: o != c("organization_id")))
    return {
        "not_null_event_id": F.count_if(c("event_id").isNull()),
        "not_null_product_id": F.count_if(c("product_id").isNull()),
        "not_null_quantity": F.count_if(c("quantity").isNull()),
        "check_event_type_domain": F.count_if(~c("event_type").isin(*S.EVENT_TYPES)),
        "check_event_id_length": F.count_if(~F.length("event_id").between(1, S.MAX_TEXT_LEN)),
        "relationships_product_id": F.count_if(c("product_id").isNotNull() & ~known),
        "org_boundary": F.coalesce(F.sum(F.when(known & c("organization_id").isNotNull(), others)), F.lit(0)),
        "fk_event_product_org": F.count_if(c("product_id").isNotNull() & c("organization_id").isNotNull() & ~(known & F.coalesce(here, F.lit(False)))),
    }


def publish_fact(store: Store, table: str, staged: DataFrame, dim_products: DataFrame, run_id: str, key: tuple[str, ...] = ("organization_id", "event_id")) -> dict[str, int]:
    """Q7 as a gate: write the staged events as the new ``table`` and publish it only if every check
    holds; else the old table stays in force and ``QualityError`` names the failing checks.

    Row and product rules are counted by ``observe`` while the rows are written, from one left join
    with the products; the key rule reads the key columns of what was written. So the events are
    scanned once. Returns the number of failing rows of each check (all 0)."""
    seen = Observation(f"gate-{run_id}")
    rules = _event_rules()
    judged = staged.join(_orgs_of_products(dim_products), "product_id", "left").observe(seen, *[c.alias(n) for n, c in rules.items()])
    found: dict[str, int] = {}

    def check(written: dict[str, DataFrame]) -> None:
        found.update({n: int(seen.get[n]) for n in rules})
        found["unique_event_key"] = duplicate_keys(written[table], list(key)).count()
        failing = {n: v for n, v in found.items() if v}
        if failing:
            raise QualityError(failing)

    store.publish(run_id, {table: judged}, replace=(table,), check=check)
    return found


def occurrence_numbers(df: DataFrame, key: list[str], order: list[str], bucket: Column) -> DataFrame:
    """``occurrence`` = 1, 2, ... within each key in ``order``, without sending a key's rows
    to one task. ``bucket`` must be monotone in ``order`` (e.g. the day of the leading
    timestamp): rows are numbered inside each (key, bucket), and each bucket adds the counts
    of the key's earlier buckets (a window over one row per (key, bucket)). Deterministic:
    no sampling, no partition ids."""
    b = df.withColumn("_bucket", bucket)
    local = b.withColumn("_local", F.row_number().over(Window.partitionBy(*key, "_bucket").orderBy(*order)))
    counts = b.groupBy(*key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return local.join(offsets, [*key, "_bucket"], "inner").withColumn(
        "occurrence", (F.col("_offset") + F.col("_local")).cast("int")
    ).drop("_bucket", "_local", "_offset")


def duplicate_flags(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Second and later occurrences of a key, with their occurrence number. The leading
    order column is a timestamp; its day buckets the numbering (see ``occurrence_numbers``)."""
    return occurrence_numbers(df, key, order, F.to_date(F.col(order[0]))).filter(F.col("occurrence") > 1)


def export_validation(
    source: DataFrame, lake: DataFrame, key: tuple[str, ...] = ("organization_id", "event_id")
) -> DataFrame:
    """Source rows vs lake rows, extra copies of the key, schema equality (7 columns)."""
    expected = set(S.EVENT_LOG_COLUMNS)
    schema_valid = set(lake.columns) == expected
    # One aggregation over the union of both sides: no join between the two counts.
    src = source.select(F.lit(1).alias("s"), F.lit(0).alias("p"), F.lit(0).alias("d"))
    keyed = lake.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("s"), F.col("n").alias("p"), (F.col("n") - 1).alias("d")
    )
    totals = src.unionByName(keyed).agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("db_rows"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("parquet_rows"),
        F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("duplicate_event_ids"),
    )
    return totals.select(
        "db_rows",
        "parquet_rows",
        (F.col("db_rows") == F.col("parquet_rows")).alias("row_count_match"),
        "duplicate_event_ids",
        F.lit(schema_valid).alias("schema_valid"),
    )
