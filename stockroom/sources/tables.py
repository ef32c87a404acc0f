"""Scans of the driver tables (one Parquet file per table).

Readers only name the table; projections and filters are added by the callers so that
Catalyst prunes columns (``ReadSchema``) and pushes predicates (``PushedFilters``) into
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import ensure_session_defaults

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    ensure_session_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that one task of a shuffle sorts or aggregates at once, whatever the size of the table.
TASK_ROWS = 250_000


def spread(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt out by ``key`` so that a task gets about ``TASK_ROWS``.

    The session's number of shuffle partitions is fixed and partitions are merged by their compressed
    bytes, so a narrow table's tasks would otherwise hold more rows the larger it is. Joins and
    groupings on ``key`` that follow keep this number. A table that all cores hold at once is left alone."""
    tasks = -(-rows // TASK_ROWS)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(tasks, *[F.col(k) for k in key])
