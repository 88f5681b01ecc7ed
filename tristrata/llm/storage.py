"""Tables written between stages, and column names that cannot clash."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.session import settings, shared_folder

#: Rows handed to Python at a time, and their bytes; a longer row goes alone.
BATCH_ROWS = 512
BATCH_BYTES = 1 << 20

#: The same as session settings, for ``settings``.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}

#: Bits of the filter for rows that are looked for.
FILTER_BITS = 1 << 22

#: Shuffle files go when the job that wrote them ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame) -> DataFrame:
    """``rows``, written as Parquet to the shared folder and read back.

    Later stages start from the files: a lost executor costs them its own tasks only,
    and values that depend on the partitioning are fixed from here on.
    """
    return _stored(rows, f"{shared_folder(rows.sparkSession)}/llm-{uuid.uuid4().hex}")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Steps:
    """The step tables of one operator, which go when they are no longer read.

    A table is dropped by name as soon as the next one is written.  Leaving the ``with``
    block drops the rest, except for those that the operator's result still reads
    (``keep``); after an error it drops all.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.paths: dict[str, DataFrame] = {}
        self.kept: list[DataFrame] = []
        self.quick_cleanup = settings(spark, **{_CLEANUP: "true"})

    def __enter__(self) -> Steps:
        self.quick_cleanup.__enter__()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.quick_cleanup.__exit__(kind, error, trace)
        kept = [] if kind else self.kept
        self.drop(*[t for t in self.paths.values() if not any(t is k for k in kept)])

    def store(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        self.paths[path] = _stored(rows, path)
        return self.paths[path]

    def keep(self, table: DataFrame) -> DataFrame:
        self.kept.append(table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [p for p, t in self.paths.items() if any(t is x for x in tables)]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
            del self.paths[path]


def small_batches(spark: SparkSession) -> None:
    for name, value in ARROW_BATCHES.items():
        spark.conf.set(name, value)


def text_of(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def place_of():
    """Finds a document's row again, or one that equals it in id and text."""
    return F.xxhash64("doc_id", text_of())


def _bitmap(values: DataFrame, bits: int) -> DataFrame:
    """One row: a bit for each value of the only column.  Its size is fixed."""
    slot = f"pmod(xxhash64(`{values.columns[0]}`), {bits})"
    longs = values.groupBy(F.expr(f"{slot} div 64").alias("id")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({slot} % 64 as int))")).alias("bits")
    )
    every = values.sparkSession.range(bits // 64)
    filled = every.join(longs, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("b"))
    ordered = F.sort_array(F.collect_list(F.struct("id", "b")))
    return filled.agg(ordered.alias("o")).select(F.transform("o", lambda x: x["b"]).alias("bits"))


def maybe_in(rows: DataFrame, values: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with ``_maybe``: false if they surely hold none of ``values``.

    ``values`` has one column, of the name it has in ``rows``.  A join is to follow; what
    it has to shuffle is cut by a bitmap of fixed size (``bits`` / 8 bytes).  With very
    many values the bitmap lets more through, never fewer.
    """
    slot = f"pmod(xxhash64(`{values.columns[0]}`), {bits})"
    bit = f"shiftright(_bits[cast({slot} div 64 as int)], cast({slot} % 64 as int)) & 1 = 1"
    return (
        rows.withColumn("_bits", _bitmap(values, bits).scalar())
        .withColumn("_maybe", F.expr(bit))
        .drop("_bits")
    )


def _marked(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` with ``place`` and ``_maybe``: false if it is surely not in ``places``."""
    return maybe_in(docs.withColumn("place", place_of()), places.select("place"))


def maybe_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` with ``place``, without most rows that are not in ``places``.

    A join on ``place`` is to follow.  What it has to shuffle is cut by a bitmap of
    fixed size; with very many places the bitmap lets more through, never fewer.
    """
    return _marked(docs, places).where("_maybe").drop("_maybe")


def without_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` without the rows at ``places``; where ``stays`` holds there, one is kept.

    Rows that surely are elsewhere pass without a shuffle.  ``places`` (a written table)
    has each place once.
    """
    taken = docs.columns
    # The columns as one value, so that no name can clash.
    row = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in taken]).alias("_row"))
    marked = _marked(row, places)
    back = [F.col("_row")[c].alias(c) for c in taken]
    kept = [marked.where("not _maybe").select(*back)]
    left = marked.where("_maybe").select("place", "_row")
    kept.append(left.join(places, "place", "left_anti").select(*back))
    if "stays" in places.columns:
        one = left.join(places.where("stays").select("place"), "place", "left_semi")
        kept.append(one.groupBy("place").agg(F.first("_row").alias("_row")).select(*back))
    out = kept[0]
    for more in kept[1:]:
        out = out.union(more)
    return out
