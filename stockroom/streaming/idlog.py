"""Ids recorded so far, as Bloom filters next to the log that holds them.

Every micro-batch owns a folder of the log, ``batch_id=N``, sorted by a hash bucket of its ids, and
a row of filters per bucket. A new micro-batch is held against the filters first: they name the
(folder, bucket) pairs that may hold one of its ids, and only those folders are opened, filtered by
bucket, for the exact test. So the test stays exact against a log of any age, and ids that are new
read next to nothing of it. Filters are rows of bounded size; none is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

KEY = ["organization_id", "event_id"]
#: Bits of a filter for each id, bits set for an id (1 % of unknown ids pass), and buckets.
BITS, PROBES, BUCKETS = 10, 7, 64


def id_hash(*key: str) -> Column:
    return F.xxhash64(*key)


def _probes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places of the bits of each id, a row per probe."""
    low, high = hashes.astype(np.uint64) & np.uint64(0xFFFFFFFF), (hashes.astype(np.uint64) >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(k) * high) % np.uint64(size) for k in range(PROBES)]).astype(np.int64)


def make_filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, BITS * len(hashes)), bool)
    bits[_probes(hashes, len(bits)).ravel()] = True
    return len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes()


def may_hold(made: bytes, hashes: np.ndarray) -> np.ndarray:
    size = int.from_bytes(made[:8], "little")
    bits = np.unpackbits(np.frombuffer(made, np.uint8, offset=8))[:size].astype(bool)
    return bits[_probes(hashes, size)].all(0)


class IdLog:
    """A log of rows with unique ``key`` under ``root``; ``append`` adds a micro-batch's new rows."""

    def __init__(self, spark: SparkSession, root: str, key: list[str] | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key or KEY, buckets

    def folder(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={batch_id}"

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.root).drop("batch_id", "_bucket")

    def filters(self) -> DataFrame:
        return self.spark.read.schema("_bucket int, made binary, batch_id long").parquet(f"{self.root}/_filters")

    def _tagged(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(id_hash(*self.key), F.lit(self.buckets)).cast("int"))

    def candidates(self, rows: DataFrame, before: int) -> DataFrame:
        """(batch_id, bucket): folders older than ``before`` and buckets that may hold an id of ``rows``.
        A bucket's asked ids, a share of one micro-batch, meet one filter at a time."""
        asked = self._tagged(rows).groupBy("_bucket").agg(F.collect_set(id_hash(*self.key)).alias("asked"))

        def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                hit = [bool(may_hold(made, np.asarray(ids, np.int64)).any()) for made, ids in zip(pdf["made"], pdf["asked"])]
                yield pdf.loc[hit, ["batch_id", "_bucket"]]

        older = self.filters().where(F.col("batch_id") < before)
        return older.join(asked, "_bucket").select("batch_id", "_bucket", "made", "asked").mapInPandas(test, "batch_id long, _bucket int")

    def recorded(self, rows: DataFrame, before: int) -> DataFrame:
        """Keys of ``rows`` that folders older than ``before`` hold. The driver gets at most a pair for
        each folder and bucket."""
        try:
            found = self.candidates(rows, before).distinct().collect()
        except AnalysisException:  # no micro-batch so far
            found = []
        if not found:
            return rows.select(*self.key).limit(0)
        folders = sorted({r["batch_id"] for r in found})
        buckets = sorted({r["_bucket"] for r in found})
        old = self.spark.read.parquet(*[self.folder(b) for b in folders]).where(F.col("_bucket").isin(buckets))
        return old.select(*self.key).join(rows.select(*self.key), self.key, "left_semi")

    def append(self, rows: DataFrame, batch_id: int, first: list[str]) -> None:
        """Add the rows of a micro-batch whose key is new; of equal keys within it the first by
        ``first``. A batch that is run again replaces itself."""
        rest = [c for c in rows.columns if c not in (*self.key, *first)]
        once = rows.groupBy(*self.key).agg(F.min(F.struct(*first, *rest)).alias("_row")).select(*self.key, "_row.*")
        new = once.join(self.recorded(rows, batch_id), self.key, "left_anti").select(*rows.columns)
        self._tagged(new).repartition("_bucket").sortWithinPartitions("_bucket").write.mode("overwrite").parquet(self.folder(batch_id))

        def make(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"_bucket": pdf["_bucket"].iloc[:1], "made": [make_filter(pdf["h"].to_numpy())]})

        written = self.spark.read.parquet(self.folder(batch_id)).select("_bucket", id_hash(*self.key).alias("h"))
        made = written.groupBy("_bucket").applyInPandas(make, "_bucket int, made binary")
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_filters/batch_id={batch_id}")
