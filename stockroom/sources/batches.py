"""Incoming event batches: CSV files (S2) and webhook JSON payloads (S3, P10), with
consecutive row numbering in arrival order (W4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockroom import schemas as S
from stockroom.operators.ingest import parsed_quantity
from stockroom.session import materialize


def arrival_order(rows: DataFrame) -> DataFrame:
    """``row_number`` 1..n per organization over (payload arrival, position), from positions within
    payloads: a payload's rows come after those of all earlier payloads. The window sees one row
    per payload; ``batch`` is the payload's arrival number within its organization."""
    counts = rows.groupBy("organization_id", "batch").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("organization_id").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("organization_id", "batch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = rows.join(offsets, ["organization_id", "batch"])
    return numbered.withColumn("row_number", F.col("_before") + F.col("row_number")).drop("_before")


class MissingColumnsError(ValueError):
    pass


def number_rows(df: DataFrame) -> DataFrame:
    """``row_number`` 1..n in (file, byte offset, position) order, without a global sort.

    Rows of one file split are consecutive in the task that reads it. Two small sums give a split
    its offset: rows of earlier splits of its file (a window per file), and rows of earlier files
    (a window over one row per file). The rows themselves join their split's offset.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before_file = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_rows"))
    files = files.select("_file", F.coalesce(F.sum("_rows").over(before_file), F.lit(0)).alias("_earlier"))
    splits = splits.withColumn("_within", F.coalesce(F.sum("_n").over(in_file), F.lit(0)))
    offsets = splits.join(files, "_file").select("_file", "_block", (F.col("_earlier") + F.col("_within")).alias("_offset"), "_first")
    numbered = tagged.join(offsets, ["_file", "_block"])
    return numbered.withColumn(
        "row_number", (F.col("_offset") + F.col("_mid") - F.col("_first") + 1).cast("long")
    ).drop("_file", "_block", "_mid", "_offset", "_first")


def numbered_rows(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with consecutive ``row_number`` 1..n in ``order``: each task writes a range of it, and
    the counts of the files that come earlier, a row per file, give each file its offset. So ids are
    handed out in ranges, and no window numbers the rows as a whole."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    written = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order), "numbered")
    return number_rows(written)


def _header_groups(spark: SparkSession, path: str) -> list[tuple[str, bool, list[str]]]:
    """Files of a CSV batch by their header line, and by whether a quoted text in them holds a line
    break (a line then has an odd number of quotes). The first line of a file is the one at offset 0
    of its first split; the driver gets a row for each file, as the reader's file listing does."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    odd = F.regexp_count("value", F.lit('"')) % 2 == 1
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("header"), F.max(odd).alias("broken"))
    grouped = first.groupBy("header", "broken").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["header"], r["broken"], r["files"]) for r in grouped.collect()]


def read_csv_batch(spark: SparkSession, path: str, organization_id: int) -> DataFrame:
    """Header CSV read as text, by column name whatever each file's column order; required
    columns are checked for every file, extra ones dropped, and doubled quotes within quoted text
    are read as one. Files with line breaks in quoted text are read whole, all others in splits."""
    parts = []
    for _header, broken, files in _header_groups(spark, path):
        raw = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", broken).csv(files)
        missing = [c for c in S.INGEST_COLUMNS if c not in raw.columns]
        if missing:
            raise MissingColumnsError(f"Missing required columns: {', '.join(missing)}")
        parts.append(raw.select(*S.INGEST_COLUMNS, "_metadata"))
    if not parts:
        raise MissingColumnsError(f"Missing required columns: {', '.join(S.INGEST_COLUMNS)}")
    numbered = number_rows(reduce(DataFrame.unionByName, parts)).drop("_metadata")
    return numbered.select(F.lit(organization_id).cast("int").alias("organization_id"), "row_number", *S.INGEST_COLUMNS)


def webhook_payloads(rows: DataFrame, batch_size: int = 500) -> DataFrame:
    """Re-nest ingest rows as webhook bodies: one JSON document per (org, batch of rows).

    Groups are at most ``batch_size`` items, so ``collect_list`` is bounded by construction.
    """
    item = F.struct(
        F.col("row_number"),
        F.col("sku"),
        F.col("event_type"),
        F.col("quantity"),
        F.col("event_id").alias("external_id"),
    )
    grouped = rows.groupBy(
        "organization_id", F.floor((F.col("row_number") - 1) / batch_size).alias("batch")
    ).agg(F.array_sort(F.collect_list(item)).alias("items"))
    body = F.to_json(
        F.struct(
            F.lit("generic").alias("source"),
            F.transform("items", lambda x: x.dropFields("row_number")).alias("events"),
        )
    )
    return grouped.select("organization_id", "batch", body.alias("body"))


def parse_webhooks(payloads: DataFrame, organizations: DataFrame, max_events: int | None = None) -> tuple[DataFrame, DataFrame]:
    """S3: validate whole payloads, then explode accepted ones into ingest rows.

    A payload is refused as a whole for an unknown org, a bad ``source``, more than ``max_events``
    items (a serving layer's request limit; none by default), or an item whose outer fields are
    malformed (text lengths, non-integer quantity). Refused payloads come back with their body.
    Accepted items get ``row_number`` = position + 1 within their payload and ``event_id`` =
    ``source:external_id``; ``arrival_order`` numbers them per organization for the ingest.
    """
    parsed = payloads.withColumn("p", F.from_json("body", S.WEBHOOK_PAYLOAD))
    orgs = organizations.select("organization_id", F.lit(True).alias("_known"))
    p = parsed.join(orgs, "organization_id", "left")
    items = F.col("p.events")

    def bad_text(x, field):
        return x[field].isNull() | (F.length(x[field]) < 1) | (F.length(x[field]) > S.MAX_TEXT_LEN)

    bad_item = F.exists(
        items,
        lambda x: bad_text(x, "sku") | bad_text(x, "external_id") | x["event_type"].isNull() | parsed_quantity(x["quantity"]).isNull(),
    )
    reason = (
        F.when(F.col("_known").isNull(), F.lit("unknown organization"))
        .when(F.col("p").isNull() | items.isNull(), F.lit("malformed payload"))
        .when(
            F.col("p.source").isNull() | (F.length("p.source") < 1) | (F.length("p.source") > S.MAX_SOURCE_LEN),
            F.lit("source: invalid length"),
        )
        .when(F.lit(max_events is not None) & (F.size(items) > F.lit(max_events)), F.lit(f"events: more than {max_events} items"))
        .when(bad_item, F.lit("events: malformed item"))
    )
    judged = p.withColumn("reason", reason)
    refused = judged.filter(F.col("reason").isNotNull()).select("organization_id", "batch", "reason", "body")
    ok = judged.filter(F.col("reason").isNull())
    rows = ok.select("organization_id", "batch", F.col("p.source").alias("source"), F.posexplode(items).alias("pos", "e"))
    out = rows.select(
        "organization_id",
        "batch",
        (F.col("pos") + 1).cast("long").alias("row_number"),
        F.col("e.sku").alias("sku"),
        F.col("e.event_type").alias("event_type"),
        parsed_quantity(F.col("e.quantity")).cast("string").alias("quantity"),
        F.concat_ws(":", F.col("source"), F.col("e.external_id")).alias("event_id"),
    )
    return out, refused
