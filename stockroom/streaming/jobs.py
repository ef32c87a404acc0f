"""Structured Streaming twins of the batch jobs.

Each job reads a file stream of log rows (declared schema, no inference), keeps its progress
in a checkpoint location under the shared checkpoint folder, and can run continuously or as
``trigger(availableNow=True)`` catch-up runs that process what has arrived and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom import schemas as S
from stockroom.functions.events import date_id, partition_parts
from stockroom.operators import ledger
from stockroom.operators.quality import occurrence_numbers
from stockroom.session import materialize
from stockroom.sources import lake
from stockroom.sources.store import Store
from stockroom.streaming.idlog import IdLog


def log_stream(spark: SparkSession, path: str, schema: T.StructType = S.EVENT_LOG, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _run(writer, available_now: bool = True):
    """Start a job. A catch-up run (``available_now``) is waited for, however long it takes, and
    raises what the query failed with; otherwise the running query is handed to the caller."""
    if not available_now:
        return writer.start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _replace_batch(out: str):
    """A ``foreachBatch`` sink that survives a retry: a micro-batch owns one ``batch_id`` folder of
    the upsert log and overwrites it, so a batch that is run again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    return write


# ---- T1: continuous lake export ------------------------------------------------------------------------------------
def export_stream(stream: DataFrame, root: str, checkpoint: str, available_now: bool = True):
    """S4 as a stream: append new log rows to the partitioned lake; the checkpoint replaces
    the high-water-mark file and gives exactly-once file output per micro-batch."""
    framed = stream.select(*S.EVENT_LOG_COLUMNS, F.col("organization_id").alias("org_id"), *partition_parts("created_at"))
    w = (
        framed.writeStream.format("parquet")
        .option("path", lake.events_path(root))
        .option("checkpointLocation", checkpoint)
        .partitionBy(*lake.PARTITION_COLS)
        .outputMode("append")
    )
    return _run(w, available_now)


# ---- T2: de-duplication of event ids ----------------------------------------------------------------------------------
def dedup_stream(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """O2 as a stream: the first row of each ``(org, event_id)``, however long ago it was recorded.
    Each micro-batch is tested against the whole log under ``out`` (see ``idlog``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch, "dedup-batch")
        IdLog(batch.sparkSession, out).append(rows, batch_id, ["created_at"])

    return _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)


def approximate_dedup_stream(stream: DataFrame, out: str, checkpoint: str, horizon: str = "7 days", available_now: bool = True):
    """Drop repeats of ``(org, event_id)`` that arrive within ``horizon`` of the first copy. State is
    bounded by the watermark, not by the log; a repeat after the horizon is written again."""
    d = stream.withWatermark("created_at", horizon).dropDuplicatesWithinWatermark(["organization_id", "event_id"])
    w = d.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return _run(w, available_now)


# ---- T3: streaming projection -----------------------------------------------------------------------------------------------
def projection_stream(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """A1 as a stream: per-product sums in update mode; every micro-batch writes its changed
    rows under its batch id, and readers take the newest row per product."""
    agg = stream.groupBy("organization_id", "product_id").agg(F.sum("quantity").alias("quantity"))
    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(_replace_batch(out))
    return _run(w, available_now)


def latest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Newest version of each key in an upsert log written by ``foreachBatch``."""
    df = spark.read.parquet(out)
    newest = df.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return df.join(newest, [*keys, "batch_id"]).drop("batch_id")


def compact(spark: SparkSession, out: str, keys: list[str], into: str) -> None:
    """Write the newest version of each key as batch 0 of a fresh upsert log, so that readers of a
    long-running job need not read all its micro-batches."""
    latest_per_key(spark, out, keys).write.mode("overwrite").parquet(f"{into.rstrip('/')}/batch_id=0")


# ---- T5: daily delta as a tumbling window ------------------------------------------------------------------------------------
def daily_delta_stream(stream: DataFrame, out: str, checkpoint: str, lateness: str = "2 days", available_now: bool = True):
    """A2 as a stream: 1-day tumbling windows with a watermark of ``lateness``: rows within it
    are always counted and windows behind it leave the state store (later rows are not
    guaranteed to be dropped, as Spark documents); update mode appends changed windows."""
    agg = (
        stream.withWatermark("created_at", lateness)
        .groupBy("product_id", F.window("created_at", "1 day").alias("w"))
        .agg(F.sum("quantity").alias("daily_delta"))
        .select("product_id", date_id(F.col("w.start")).alias("date_id"), "daily_delta")
    )
    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(_replace_batch(out))
    return _run(w, available_now)


# Days of on-time rows and the late rows themselves, published together with the watermark.
DAILY = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("date_id", T.StringType()), T.StructField("daily_delta", T.LongType())])
LATE = T.StructType([*S.EVENT_LOG.fields, T.StructField("batch_id", T.LongType())])
WATERMARK = "watermark"


def daily_delta_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, {"daily": DAILY, "late": LATE})


def daily_delta_with_late_rows(stream: DataFrame, store: Store, checkpoint: str, lateness_seconds: int = 2 * 86400, available_now: bool = True):
    """A2 as a stream with a side output. A row is late if its day had ended by the watermark that
    earlier micro-batches committed (their newest ``created_at`` less ``lateness_seconds``); late rows go to
    the table ``late`` with the number of their batch, the others add to their day in ``daily``
    (readers sum over versions). Both and the new watermark are published as one version, so a
    batch that is run again adds nothing, and no row is lost: ``daily`` and ``late`` together are the log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = Store(spark, store.root, store.schemas, store.keys)
        rows = materialize(batch.select(*S.EVENT_LOG_COLUMNS), "daily-batch")
        mark = tables.mark(WATERMARK)
        newest = rows.agg(F.max(F.unix_micros("created_at"))).first()[0]
        ends = F.unix_micros(F.date_trunc("day", "created_at")) + 86_400_000_000
        late = F.lit(False) if mark is None else F.coalesce(ends <= F.lit(mark), F.lit(False))
        sums = rows.where(~late).groupBy("product_id", date_id("created_at").alias("date_id")).agg(F.sum("quantity").alias("daily_delta"))
        known = [m for m in (mark, None if newest is None else newest - lateness_seconds * 1_000_000) if m is not None]
        side = rows.where(late).withColumn("batch_id", F.lit(batch_id).cast("long"))
        tables.publish(f"batch-{batch_id}", {"daily": sums, "late": side}, {WATERMARK: max(known)} if known else None)

    return _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)


def daily_totals(store: Store) -> DataFrame:
    """On-time sums per product and day, over all versions."""
    return store.read("daily").groupBy("product_id", "date_id").agg(F.sum("daily_delta").alias("daily_delta"))


# ---- T4: streaming oversell guard --------------------------------------------------------------------------------------------
ORDER = ["created_at", "event_id", "supplier_id", "quantity", "price", "event_type"]


GUARD_COLUMNS = ["organization_id", "product_id", *ORDER]


def _guard_store(stream: DataFrame, checkpoint: str) -> Store:
    """Balances and the rows that wait for the watermark."""
    fields = {f.name: f for f in stream.schema.fields}
    state = T.StructType([fields["organization_id"], fields["product_id"], T.StructField("quantity", T.LongType())])
    tables = {"state": state, "waiting": T.StructType([fields[c] for c in GUARD_COLUMNS])}
    return Store(stream.sparkSession, f"{checkpoint.rstrip('/')}/guard", tables, {"state": ["organization_id", "product_id"]})


def _apply_in_order(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The batch guard over ``rows`` in their total order per product, from the balances in ``state``."""
    numbered = occurrence_numbers(rows, ["organization_id", "product_id"], ORDER, F.coalesce(F.to_date("created_at"), F.lit("0001-01-01").cast("date")))
    raw = F.when(F.col("event_type").isin(*S.OUTFLOW_TYPES), -F.col("quantity")).otherwise(F.col("quantity"))
    seq = F.col("occurrence").cast("long")
    events = numbered.select(
        "organization_id", "product_id", F.concat("event_id", F.lit("#"), seq.cast("string")).alias("event_id"), "event_type", raw.alias("quantity"), seq.alias("seq")
    )
    return materialize(ledger.apply_batch(events, start_state=state, groups="product", unique_ids=True), "guarded")


def _guard_version(store: Store, out: str, run_id: str, folder: str, ready: DataFrame, waiting: DataFrame, marks: dict[str, int] | None) -> None:
    """Write what ``ready`` gives under ``out``, then publish the balances it leaves and the rows that
    wait. Run again after a crash, it starts from the same balances and replaces what it wrote."""
    applied = _apply_in_order(ready, store.read("state"))
    applied.select(
        "organization_id",
        "product_id",
        F.substring_index("event_id", "#", 1).alias("event_id"),
        "event_type",
        F.col("delta").cast("int").alias("quantity"),
        F.col("applied").alias("accepted"),
        "balance_after",
    ).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={folder}")
    store.publish(run_id, {"state": ledger.final_balances(applied), "waiting": waiting}, marks, replace=("waiting",))


def oversell_stream(stream: DataFrame, out: str, checkpoint: str, lateness_seconds: int | None = None, available_now: bool = True):
    """O1 as a stream. Without ``lateness_seconds`` each micro-batch is applied in its own order on top of
    the ones before. With it, rows wait until the newest ``created_at`` seen is that much later, and are
    then applied in time order whichever micro-batch brought them; ``finish_oversell`` applies those
    that still wait. A row that comes after its time was settled is applied with the next rows.

    A micro-batch runs through the batch guard: rows and balances are tables, no product's rows
    are gathered in one frame, and a hot product is folded in chunks by many tasks."""
    store = _guard_store(stream, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = Store(batch.sparkSession, store.root, store.schemas, store.keys)
        if own.published(f"batch-{batch_id}"):
            return
        fresh = materialize(batch.select(*GUARD_COLUMNS), "guard-batch")
        if lateness_seconds is None:
            _guard_version(own, out, f"batch-{batch_id}", str(batch_id), fresh, fresh.limit(0), None)
            return
        mark, newest = own.mark(WATERMARK), fresh.agg(F.max(F.unix_micros("created_at"))).first()[0]
        known = [m for m in (mark, None if newest is None else newest - lateness_seconds * 1_000_000) if m is not None]
        settled = F.coalesce(F.unix_micros("created_at") <= F.lit(max(known, default=None)), F.lit(False))
        rows = materialize(own.read("waiting").unionByName(fresh), "guard-waiting")
        _guard_version(own, out, f"batch-{batch_id}", str(batch_id), rows.where(settled), rows.where(~settled), {WATERMARK: max(known)} if known else None)

    return _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)


def finish_oversell(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Apply the rows that still wait for the watermark: the stream has ended."""
    store = _guard_store(stream, checkpoint)
    head = store.head()
    rows = store.read("waiting", head)
    _guard_version(store, out, f"finish-{head.version}", str(1_000_000_000 + head.version), rows, rows.limit(0), None)
