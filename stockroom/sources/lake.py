"""The partitioned event lake and its bookkeeping.

Layout under a root folder (any Hadoop file system URI):

    {root}/inventory_events/org_id=N/year=YYYY/month=MM/day=DD/part-*.parquet
    {root}/_state/checkpoint/            one-row JSON: key, last_id
    {root}/_state/manifest/              one row per written partition: id range and rows
    {root}/_state/audit/                 append-only audit rows
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from stockroom import schemas as S
from stockroom.functions.events import partition_parts
from stockroom.session import materialize
from stockroom.sources.store import Store

CHECKPOINT_KEY = "inventory_events"
PARTITION_COLS = ["org_id", "year", "month", "day"]

LAKE_READ_SCHEMA = T.StructType(
    S.EVENT_LOG.fields
    + [
        T.StructField("org_id", T.IntegerType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)


def events_path(root: str) -> str:
    return f"{root.rstrip('/')}/inventory_events"


def _state(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_state/{name}"


# ---- S1 / P8 -------------------------------------------------------------------------------------
def base_scan(log: DataFrame) -> DataFrame:
    """The seven exported columns (order of rows is irrelevant to a Parquet sink)."""
    return log.select(*S.EVENT_LOG_COLUMNS)


def incremental(log: DataFrame, last_id: int | None) -> DataFrame:
    """Rows after the high-water mark; the predicate reaches the Parquet scan."""
    return log if last_id is None else log.filter(F.col("id") > F.lit(last_id))


# ---- S4 / P9 / L6 --------------------------------------------------------------------------------
def with_partition_columns(batch: DataFrame) -> DataFrame:
    """``org_id`` (copy of organization_id) and zero-padded UTC year / month / day."""
    return batch.select(
        *S.EVENT_LOG_COLUMNS,
        F.col("organization_id").alias("org_id"),
        *partition_parts("created_at"),
    )


def write_lake(batch: DataFrame, root: str, max_records_per_file: int = 5_000_000, replace: bool = False) -> None:
    """S4 + L6: Hive-partitioned append (``replace``: the lake becomes this batch), rows sorted by ``(created_at, id)`` inside each file.

    ``rebalance`` asks AQE for output partitions of even size clustered by the partition
    keys: a hot (org, day) is split over several tasks/files instead of one, and tiny ones are
    coalesced, so the file count follows the data volume, not the number of tasks.
    """
    framed = with_partition_columns(batch)
    (
        framed.hint("rebalance", *PARTITION_COLS)
        .sortWithinPartitions(*PARTITION_COLS, "created_at", "id")
        .write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION_COLS)
        .parquet(events_path(root))
    )


# ---- S5 / U1 / U2 ----------------------------------------------------------------------------------
def read_lake(spark: SparkSession, root: str, legacy_files: bool = False) -> DataFrame:
    """Scan the lake, union by column name, absent columns read as NULL.

    New-layout lakes are read through partition discovery (partition pruning on org/day
    filters). When files outside the ``org_id=`` tree may exist (``legacy_files``), the scan
    switches to recursive file lookup, which loses pruning but accepts any layout.
    """
    if legacy_files:
        return (
            spark.read.schema(S.EVENT_LOG)
            .option("recursiveFileLookup", "true")
            .option("mergeSchema", "true")
            .parquet(events_path(root))
        )
    return spark.read.schema(LAKE_READ_SCHEMA).option("mergeSchema", "true").parquet(events_path(root))


# ---- S6 / W3 ----------------------------------------------------------------------------------------
def load_checkpoint(spark: SparkSession, root: str) -> int | None:
    """The high-water mark, or None when no checkpoint was written yet (a one-row read)."""
    try:
        rows = (
            spark.read.schema("key string, last_id long")
            .json(_state(root, "checkpoint"))
            .filter(F.col("key") == CHECKPOINT_KEY)
            .agg(F.max("last_id"))
            .first()
        )
    except AnalysisException:
        return None
    return None if rows is None else rows[0]


def save_checkpoint(spark: SparkSession, root: str, last_id: int) -> None:
    spark.range(1).select(F.lit(CHECKPOINT_KEY).alias("key"), F.lit(last_id).cast("long").alias("last_id")).coalesce(
        1
    ).write.mode("overwrite").json(_state(root, "checkpoint"))


# ---- A12 / A5 ---------------------------------------------------------------------------------------
def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(_state(root, "manifest"))


def export_events(spark: SparkSession, log: DataFrame, root: str, incremental_mode: bool = True) -> DataFrame:
    """A5: one export run (full or incremental) -> one-row summary frame.

    The log is read once, for the data; manifest, counts and checkpoint come from the ids in the
    files that the run wrote, so they agree with the data whatever arrives meanwhile. A full run
    replaces lake and manifest, so it may be repeated (of an empty log it leaves them alone); an
    incremental one appends rows behind the checkpoint, which then moves to the largest id written
    (not to the id of the latest timestamp).
    """
    mode = "incremental" if incremental_mode else "full"
    last_id = load_checkpoint(spark, root) if incremental_mode else None
    if not incremental_mode and log.isEmpty():
        return _summary(spark, 0, 0, 0, mode, False, last_id)
    before = materialize(lake_files(spark, root), "lake-files") if incremental_mode else spark.createDataFrame([], LAKE_FILES)
    write_lake(incremental(base_scan(log), last_id), root, replace=not incremental_mode)
    written = written_files(spark, root, before)
    totals = _totals(written)
    if totals["files"] == 0:
        return _summary(spark, 0, 0, 0, mode, False, last_id)
    manifest = written_manifest(written).withColumn("run_id", F.lit(uuid.uuid4().hex[:12]))
    manifest.write.mode("append" if incremental_mode else "overwrite").parquet(_state(root, "manifest"))
    save_checkpoint(spark, root, totals["end_id"])
    return _summary(spark, totals["rows"], totals["parts"], totals["files"], mode, True, totals["end_id"])


def written_files(spark: SparkSession, root: str, before: DataFrame) -> DataFrame:
    """One row (partition columns, path, length, start_id, end_id, rows) per lake file with rows that
    ``before`` does not list. Only the days of these files are opened, and of the files only the id
    column; a file has a bounded number of rows."""
    new = lake_files(spark, root).join(before.select("path"), "path", "left_anti").where(F.col("path").startswith("org_id="))
    days = ["year", "month", "day"]
    new = new.select(*[F.regexp_extract("path", f"/{c}=([^/]*)", 1).alias(c) for c in days], "path", "length")
    rows = read_lake(spark, root).select(*PARTITION_COLS, _relative("_metadata.file_path").alias("path"), "id")
    found = rows.join(new, [*days, "path"]).groupBy(*PARTITION_COLS, "path", "length")
    return materialize(found.agg(F.min("id").alias("start_id"), F.max("id").alias("end_id"), F.count(F.lit(1)).alias("rows")), "lake-written")


def written_manifest(written: DataFrame) -> DataFrame:
    """A12 from ``written_files``: id range and row count per partition."""
    return written.groupBy(*PARTITION_COLS).agg(F.min("start_id").alias("start_id"), F.max("end_id").alias("end_id"), F.sum("rows").alias("rows"))


def _totals(written: DataFrame):
    return written.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_distinct(*PARTITION_COLS).alias("parts"),
        F.count(F.lit(1)).alias("files"),
        F.max("end_id").alias("end_id"),
    ).first()


def _summary(spark, rows, parts, files, mode, updated, last_id) -> DataFrame:
    return spark.createDataFrame(
        [(int(rows), int(parts), int(files), mode, bool(updated), last_id)],
        "rows_exported long, partitions_written long, files_written long, mode string, "
        "checkpoint_updated boolean, last_id long",
    )


# ---- S4 + S6: exactly-once export ------------------------------------------------------------------------
LAKE_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])
LAKE_PARTITIONS = T.StructType(
    [T.StructField("org_id", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")]
    + [T.StructField(c, T.LongType()) for c in ("start_id", "end_id", "rows")]
)
LAST_ID = "last_id"


def lake_commits(spark: SparkSession, root: str) -> Store:
    """Files and partitions of the lake that were committed, and the high-water id they reach."""
    return Store(spark, _state(root, "commits"), {"files": LAKE_FILES, "partitions": LAKE_PARTITIONS})


def _relative(path: str) -> Column:
    return F.regexp_extract(path, "/inventory_events/(.*)$", 1)


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length): all data files under the lake, committed or not; a listing, no file is read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(events_path(root))
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], LAKE_FILES)
    return files.select(_relative("path").alias("path"), "length")


def export_once(spark: SparkSession, log: DataFrame, root: str) -> DataFrame:
    """A5, exactly once: rows behind the committed high-water id are written to the lake, and then
    their files, their partitions and the new id are committed in one publish. A run that dies
    before that leaves files that no reader sees (``uncommitted_files``); the next run exports the
    same rows again. One export runs at a time."""
    commits = lake_commits(spark, root)
    last_id = commits.mark(LAST_ID)
    before = materialize(lake_files(spark, root), "lake-files")
    write_lake(incremental(base_scan(log), last_id), root)
    written = written_files(spark, root, before)
    totals = _totals(written)
    if totals["files"] == 0:
        return _summary(spark, 0, 0, 0, "incremental", False, last_id)
    upper = totals["end_id"]
    commits.publish(f"export-{last_id}-{upper}", {"files": written.select("path", "length"), "partitions": written_manifest(written)}, {LAST_ID: upper})
    return _summary(spark, totals["rows"], totals["parts"], totals["files"], "incremental", True, upper)


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """The lake's committed rows (S5): rows of files that the commits name. Filters on org and day
    still prune partitions."""
    files = lake_commits(spark, root).read("files").select("path")
    rows = read_lake(spark, root).withColumn("path", _relative("_metadata.file_path"))
    return rows.join(files, "path", "left_semi").drop("path")


def uncommitted_files(spark: SparkSession, root: str) -> DataFrame:
    """Files in the lake that no commit names: left by runs that died, safe to delete when no export runs."""
    return lake_files(spark, root).join(lake_commits(spark, root).read("files").select("path"), "path", "left_anti")


def file_order(spark: SparkSession, root: str) -> DataFrame:
    """Per committed file its rows and how many of them stand before a row with a smaller
    ``(created_at, id)``. Rows of a file are read in file order; a file has a bounded number of rows."""
    rows = read_lake(spark, root).select(
        _relative("_metadata.file_path").alias("path"), F.struct("created_at", "id").alias("at"), F.monotonically_increasing_id().alias("place")
    )
    earlier = F.lag("at").over(Window.partitionBy("path").orderBy("place"))
    return rows.withColumn("earlier", earlier).groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("earlier") > F.col("at")).alias("out_of_order")
    )


# ---- S10 ------------------------------------------------------------------------------------------------
AUDIT_SCHEMA = "actor_id long, action string, detail string, organization_id int"


def append_audit(rows: DataFrame, root: str) -> None:
    """Append-only audit rows ``(actor, action, detail, org)``; never rewritten."""
    rows.select(
        F.col("actor_id").cast("long"), "action", "detail", F.col("organization_id").cast("int")
    ).write.mode("append").parquet(_state(root, "audit"))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(_state(root, "audit"))


# ---- S7 / S8 / S9 ---------------------------------------------------------------------------------------
def write_table(df: DataFrame, path: str) -> None:
    """Published table, full overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_feature_store(features: DataFrame, path: str) -> None:
    """One directory per org; with dynamic partition overwrite a rebuild of some orgs
    replaces only their directories."""
    features.withColumn("org_id", F.col("organization_id")).write.mode("overwrite").partitionBy("org_id").parquet(
        path
    )


def read_feature_store(spark: SparkSession, path: str, org: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if org is not None:
        df = df.filter(F.col("org_id") == org)  # partition pruning
    return df.drop("org_id")
