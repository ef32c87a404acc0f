"""The current-stock projection as an aggregate of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.sources.store import Store


def scope(df: DataFrame, org: int | None) -> DataFrame:
    """Tenant filter; ``None`` keeps every tenant (jobs then group by org)."""
    return df if org is None else df.filter(F.col("organization_id") == org)


def active_scope(df: DataFrame, organizations: DataFrame) -> DataFrame:
    """Keep rows of active organizations (semi join against a tenant-sized table)."""
    active = organizations.filter("is_active").select("organization_id")
    return df.join(active, "organization_id", "left_semi")


def replay_state(log: DataFrame, org: int | None = None) -> DataFrame:
    """A1: the state is the plain per-product sum of the log (replay trusts the log).

    Only products with events get a row. Partial aggregation runs map side, so the shuffle
    carries one row per (task, product), whatever the skew of the log.
    """
    return scope(log, org).groupBy("organization_id", "product_id").agg(
        F.sum("quantity").alias("quantity")
    )


def replay_summary(log: DataFrame, org: int | None = None) -> DataFrame:
    """Events processed and products rebuilt, per tenant."""
    return scope(log, org).groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.countDistinct("product_id").alias("products_rebuilt"),
    )


def stock_lookup(asked: DataFrame, products: DataFrame, state: DataFrame) -> DataFrame:
    """P17 for a batch of asked products (organization_id, product_id): the stock of each, or the
    error of one that the organization does not have. One row per asked row."""
    key = ["organization_id", "product_id"]
    known = products.select(*key).distinct().withColumn("known", F.lit(True))
    rows = asked.select(*key).join(known, key, "left").join(state.select(*key, "quantity"), key, "left")
    missing = F.concat(F.lit("Product "), F.coalesce(F.col("product_id").cast("string"), F.lit("null")), F.lit(" not found"))
    return rows.select(
        *key,
        F.when(F.col("known"), F.coalesce("quantity", F.lit(0))).cast("bigint").alias("quantity"),
        F.when(F.col("known").isNull(), missing).alias("error"),
    )


def stock_levels(products: DataFrame, state: DataFrame, org: int | None = None) -> DataFrame:
    """P17 (batch form): every known product with its stock; missing state reads as 0."""
    p = scope(products, org).select("organization_id", "product_id")
    s = state.select("organization_id", "product_id", "quantity")
    return p.join(s, ["organization_id", "product_id"], "left").select(
        "organization_id", "product_id", F.coalesce("quantity", F.lit(0)).cast("bigint").alias("quantity")
    )


def state_reconciliation(state: DataFrame, log: DataFrame) -> DataFrame:
    """Rows where the stored projection and the replayed sum disagree (full outer join)."""
    replayed = replay_state(log).withColumnRenamed("quantity", "replayed_quantity")
    stored = state.select("organization_id", "product_id", F.col("quantity").alias("stored_quantity"))
    j = stored.join(replayed, ["organization_id", "product_id"], "full_outer")
    s = F.coalesce("stored_quantity", F.lit(0))
    r = F.coalesce("replayed_quantity", F.lit(0))
    return j.filter(s != r).select(
        "organization_id",
        "product_id",
        s.cast("bigint").alias("stored_quantity"),
        r.cast("bigint").alias("replayed_quantity"),
        (r - s).cast("bigint").alias("difference"),
    )


# ---- A1 / T3: snapshot plus delta --------------------------------------------------------------------
SNAPSHOT = T.StructType(
    [T.StructField("organization_id", T.IntegerType()), T.StructField("product_id", T.LongType()), T.StructField("quantity", T.LongType())]
)
LAST_ID = "last_id"


def snapshots(spark: SparkSession, root: str) -> Store:
    """Sums per product of stretches of the log, and the id up to which they reach."""
    return Store(spark, root, {"sums": SNAPSHOT})


def advance_snapshot(store: Store, log: DataFrame, most_versions: int = 8) -> bool:
    """Add the log rows behind the snapshot's high-water id as one more version of sums; more than
    ``most_versions`` of them are folded into one. Only new rows are read (the id bound reaches the
    scan). False if there were none."""
    head = store.head()
    mark = (head.marks or {}).get(LAST_ID)
    fresh = log if mark is None else log.where(F.col("id") > mark)
    upper = fresh.agg(F.max("id")).first()[0]
    if upper is None:
        return False
    store.publish(f"advance-{mark}-{upper}", {"sums": replay_state(fresh.where(F.col("id") <= upper))}, {LAST_ID: upper})
    head = store.head()
    if len(head.tables["sums"]) > most_versions:
        store.publish(f"fold-{head.version}", {"sums": _summed(store.read("sums", head))}, replace=("sums",))
    return True


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("organization_id", "product_id").agg(F.sum("quantity").alias("quantity"))


def current_state(store: Store, log: DataFrame) -> DataFrame:
    """A1 as of now: the snapshot's sums plus the rows that came after it."""
    head = store.head()
    mark = (head.marks or {}).get(LAST_ID)
    tail = log if mark is None else log.where(F.col("id") > mark)
    return _summed(store.read("sums", head).unionByName(replay_state(tail)))
