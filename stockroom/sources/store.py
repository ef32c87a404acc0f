"""Tables that change together: a run writes its rows of several tables, then publishes them at once.

Layout under a root folder (any Hadoop file system URI):

    {root}/{table}/publish=N/part-*.parquet     rows that version N added to a table
    {root}/_commits/version=N/part-*.json       one file, one row: the head that version N makes

A version's folders are written first; readers do not see them. The commit file, a single small
file that appears at once, is what publishes them: it names the folders that make up each table, the
run that wrote it and the marks (high-water ids, watermarks) that moved with it. A run that dies in
between leaves the old head in force; when it runs again it overwrites its folders and publishes.
A run id that was published before adds nothing.

A table with a key holds the newest row of each key (upsert), others all rows (append). One writer
at a time: the commit folder of a version can be made once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

COMMIT = "version long, run_id string, marks map<string,long>, tables map<string,array<long>>"


class Store:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], keys: dict[str, list[str]] | None = None) -> None:
        """``schemas``: the columns of each table; ``keys``: the key columns of those that are upserted."""
        self.spark, self.root, self.schemas, self.keys = spark, root.rstrip("/"), schemas, keys or {}

    # ---- reading -----------------------------------------------------------------------------------
    def commits(self) -> DataFrame:
        """One row per published version."""
        try:
            return self.spark.read.schema(COMMIT).json(f"{self.root}/_commits")
        except AnalysisException:  # nothing was published yet
            return self.spark.createDataFrame([], COMMIT)

    def head(self) -> T.Row:
        """The newest commit; before the first one, version 0 with no tables."""
        newest = self.commits().orderBy(F.desc("version")).limit(1).collect()
        return newest[0] if newest else T.Row(version=0, run_id=None, marks={}, tables={})

    def mark(self, name: str) -> int | None:
        return (self.head().marks or {}).get(name)

    def published(self, run_id: str) -> bool:
        return not self.commits().where(F.col("run_id") == run_id).isEmpty()

    def read(self, table: str, head: T.Row | None = None) -> DataFrame:
        """The table as of ``head`` (the newest by default). A key's newest row is a grouped maximum
        over versions, so no window gathers a key's history."""
        rows = self.versions(table, head)
        keys = self.keys.get(table)
        if keys is None:
            return rows.drop("publish")
        rest = [c for c in rows.columns if c not in (*keys, "publish")]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("publish")).alias("row"))
        return newest.select(*keys, "row.*").select(*self.schemas[table].fieldNames())

    def versions(self, table: str, head: T.Row | None = None) -> DataFrame:
        """All published rows of a table with the version that wrote them as ``publish``."""
        head = head or self.head()
        folders = (head.tables or {}).get(table) or []
        schema = T.StructType(self.schemas[table].fields + [T.StructField("publish", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [self._folder(table, v) for v in folders]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)

    def _folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/publish={version}"

    # ---- writing -----------------------------------------------------------------------------------
    def stage(self, table: str, rows: DataFrame, version: int) -> DataFrame:
        """Write a version's rows of one table; they are not visible until it is published."""
        fields = self.schemas[table].fields
        shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        shaped.write.mode("overwrite").parquet(self._folder(table, version))
        return self.spark.read.schema(self.schemas[table]).parquet(self._folder(table, version))

    def publish(
        self,
        run_id: str,
        rows: dict[str, DataFrame],
        marks: dict[str, int] | None = None,
        replace: tuple[str, ...] = (),
        check: Callable[[dict[str, DataFrame]], None] | None = None,
    ) -> bool:
        """Add ``rows`` to their tables as one version (``replace``: these tables become the rows).

        ``check`` sees the written rows and may raise; then nothing is published. False if the run
        was published before."""
        if self.published(run_id):
            return False
        head = self.head()
        version = head.version + 1
        staged = {table: self.stage(table, df, version) for table, df in rows.items()}
        if check is not None:
            check(staged)
        tables = {t: list(v) for t, v in (head.tables or {}).items()}
        for table in rows:
            tables[table] = [version] if table in replace else [*tables.get(table, []), version]
        self._point(version, run_id, (head.marks or {}) | (marks or {}), tables)
        return True

    def _point(self, version: int, run_id: str, marks: dict[str, int], tables: dict[str, list[int]]) -> None:
        row = self.spark.createDataFrame([(version, run_id, marks, tables)], COMMIT)
        # a folder that a crashed run left without its file is empty and may be written again
        mode = "error" if self.commits().where(F.col("version") == version).count() else "overwrite"
        row.drop("version").coalesce(1).write.mode(mode).json(f"{self.root}/_commits/version={version}")

    def compact(self, table: str) -> bool:
        """Rewrite a table as one version, so that readers open one folder."""
        head = self.head()
        if len((head.tables or {}).get(table) or []) < 2:
            return False
        return self.publish(f"compact-{table}-{head.version}", {table: self.read(table, head)}, replace=(table,))

    def unpublished(self, table: str) -> DataFrame:
        """(path): files of a table that no version in force names: left by crashed or replaced runs."""
        folders = (self.head().tables or {}).get(table) or []
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{self.root}/{table}").select("path")
        version = F.regexp_extract("path", "/publish=([0-9]+)/", 1).cast("long")
        return files.where(~version.isin(folders) if folders else F.lit(True))
