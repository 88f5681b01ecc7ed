"""Writing layers and warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tristrata.session import settings
from tristrata.sinks.versions import ConcurrentRefresh, TableLog, compact, read_table

#: Data folders an append-only table may have before they are written as one.
MOST_FOLDERS = 16
#: Times an append starts over when another writer was faster.
APPEND_TRIES = 20


def overwrite(
    df: DataFrame,
    path: str,
    counts: dict[str, Column] | None = None,
    keep_if_empty: bool = False,
) -> dict:
    """Full refresh of a table, counting in the same pass.

    The new rows are written into a folder that no reader looks at and become the
    table's next version in one step, after the write succeeded.  So a refresh that
    fails, wherever it does, leaves the table as it was; so does one without rows, if
    ``keep_if_empty``.  Of two refreshes at once the first to finish wins, the other one
    raises ConcurrentRefresh.  ``df`` may even be read from the table itself, and who
    reads the version before can go on until the refresh after this one.

    Returns ``rows`` (rows written), ``kept`` (1 if the old table stays) and any further
    ``counts``, which are taken over the rows written.  Counted in the writing stage,
    where Spark takes each task's count once even if the task had to run again.
    """
    seen = Observation()
    extra = [c.alias(name) for name, c in (counts or {}).items()]
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra)
    log = TableLog(df.sparkSession, path)
    there = log.files.exists(log.path)
    base, folder = log.begin(), log.new_folder()
    kept = 1
    try:
        counted.write.parquet(f"{log.path}/{folder}")
        found = seen.get
        if not (keep_if_empty and not found["rows"] and there):
            log.publish(base, [folder], found["rows"], df.schema)
            kept = 0
    finally:
        if kept:
            log.files.delete(f"{log.path}/{folder}")
    log.vacuum()
    return {**found, "kept": kept}


class Split:
    """Rows written once into a table's folder, apart by a yes/no column, unpublished.

    Either part can be read, and one can become the table's next version as it lies
    there, without being written again.  Leaving the ``with`` block deletes what was not
    published.
    """

    def __init__(self, df: DataFrame, path: str, flag: str, counts: dict[str, Column]):
        self.log = TableLog(df.sparkSession, path)
        self.spark, self.flag, self.schema = df.sparkSession, flag, df.drop(flag).schema
        self.there = self.log.files.exists(self.log.path)
        self.base, self.folder = self.log.begin(), self.log.new_folder()
        self.published = False
        seen = Observation()
        extra = [c.alias(name) for name, c in counts.items()]
        counted = df.observe(seen, F.count_if(~F.col(flag)).alias("rows"), *extra)
        # With a writer open for each part, rows need no sorting by the flag.
        with settings(self.spark, **{"spark.sql.maxConcurrentOutputFileWriters": "2"}):
            try:
                counted.write.partitionBy(flag).parquet(f"{self.log.path}/{self.folder}")
            except BaseException:
                self.close()
                raise
        self.counts = seen.get

    def __enter__(self) -> Split:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def _part(self, value: bool) -> str:
        return f"{self.folder}/{self.flag}={str(value).lower()}"

    def rows(self, value: bool) -> DataFrame:
        part = f"{self.log.path}/{self._part(value)}"
        if not self.log.files.exists(part):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(part)

    def publish(self, value: bool, columns: list[str], keep_if_empty: bool = True) -> bool:
        """One part's ``columns`` as the next version; False if it has no rows and the
        table stays as it was."""
        part = self._part(value)
        full = self.log.files.exists(f"{self.log.path}/{part}")
        if keep_if_empty and not full and self.there:
            return False
        schema = StructType([self.schema[c] for c in columns])
        rows = self.rows(value).count() if value else self.counts["rows"]
        self.log.publish(self.base, [part] if full else [], rows, schema)
        self.log.files.delete(f"{self.log.path}/{self._part(not value)}")
        self.published = True
        return True

    def close(self) -> None:
        if not self.published:
            self.log.files.delete(f"{self.log.path}/{self.folder}")
        self.log.vacuum()


def append_rows(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    """Append a few bookkeeping rows.

    Each append is a version with one folder more, and several writers may append at
    once: who comes second appends to what the first one published.  Past MOST_FOLDERS
    the folders are written as one, so their number stays bounded.
    """
    append(spark.createDataFrame(rows, schema).coalesce(1), path)


def append(df: DataFrame, path: str) -> None:
    log = TableLog(df.sparkSession, path)
    folder, seen = log.new_folder(), Observation()
    published = False
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{log.path}/{folder}")
        for left in reversed(range(APPEND_TRIES)):
            base, before = log.begin(), log.newest()
            folders, rows = (before.folders, before.rows) if before else ((), 0)
            try:
                log.publish(base, [*folders, folder], rows + seen.get["rows"], df.schema)
                published = True
                break
            except ConcurrentRefresh:
                if not left:
                    raise
    finally:
        if not published:
            log.files.delete(f"{log.path}/{folder}")
    if len(folders) + 1 > MOST_FOLDERS:
        try:
            compact(df.sparkSession, path)
        except ConcurrentRefresh:
            pass  # someone else appended; the next one tries again
    log.vacuum()


__all__ = ["Split", "append", "append_rows", "overwrite", "read_table"]
