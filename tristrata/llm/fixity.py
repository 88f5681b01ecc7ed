"""WARC records and their fixity audit by Merkle trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.storage import Steps
from tristrata.operators.joining import join_summary

#: Records in an archive, ids in a leaf's range, children of a node, levels above leaves
#: (FANOUT ** LEVELS leaves at most, of 256 there are), copies that are counted out at once.
ARCHIVE_RECORDS = 1_000
RANGE_IDS = 16
FANOUT = 8
LEVELS = 3
RUN = 4_096
#: Differences of one page that are numbered together.
CELL_ROWS = 512


def warc_records(pages: DataFrame) -> DataFrame:
    """Each page as a WARC record: page_id, url, record (binary, ends included)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    end = F.lit("\r\n\r\n").cast("binary")
    return pages.select("page_id", "url", F.concat(head.cast("binary"), body, end).alias("record"))


def digests(records: DataFrame) -> DataFrame:
    """page_id, length and digest of each record; the bytes themselves go no further."""
    return records.select(
        "page_id",
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
    )


def manifest(rows: DataFrame) -> DataFrame:
    """``digests`` by archive, with ``copy``, the number of each among equal records:
    archive, page_id, digest, length, copy.

    An archive holds the ids of one thousand; records without an id are in archive -1.
    """
    same = ["archive", "page_id", "digest", "length"]
    counted = (
        rows.withColumn("archive", F.floor(F.coalesce("page_id", F.lit(-1)) / ARCHIVE_RECORDS))
        .groupBy(*same)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    runs = counted.select(*same, "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {RUN})")).alias("r"))
    last = F.least(F.col("n"), (F.col("r") + 1) * RUN)
    return runs.select(*same, F.explode(F.sequence(F.col("r") * RUN + 1, last)).alias("copy"))


def _parts(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Archives with over twice their records in either replica, and the parts they are
    dealt into, the same for both."""
    sizes = ours.select("archive", F.lit(1).alias("a"), F.lit(0).alias("b")).union(
        theirs.select("archive", F.lit(0), F.lit(1))
    ).groupBy("archive").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    most = F.greatest("a", "b")
    return sizes.where(most > 2 * ARCHIVE_RECORDS).select(
        "archive", F.ceil(most / ARCHIVE_RECORDS).alias("parts")
    )


def _laid_out(records: DataFrame, parts: DataFrame) -> DataFrame:
    """A manifest's records with part, leaf and offset.

    Where a record goes hangs on itself and on the archive's parts alone, so the loss of
    one moves no other into another part or leaf.  Within a part, records lie in the
    order of leaves, ids, digests and copies; so a leaf is a range of offsets.  Leaves are
    ranges of ids, or of digests where an archive is dealt into parts.
    """
    dealt = join_summary(records, parts, ["archive"]).withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("page_id", "digest", "copy"), F.col("parts")), F.lit(0))
    )
    by_digest = F.conv(F.substring("digest", 1, 2), 16, 10).cast("long")
    by_id = F.floor((F.col("page_id") - F.col("archive") * ARCHIVE_RECORDS) / RANGE_IDS)
    placed = dealt.withColumn(
        "node", F.when(F.col("parts").isNull(), F.coalesce(by_id, by_digest)).otherwise(by_digest)
    )
    before = (
        Window.partitionBy("archive", "part")
        .orderBy("node", "page_id", "digest", "copy")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return placed.select("archive", "part", "node", "page_id", "digest", "copy", "length", offset)


def merkle_tree(laid_out: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Nodes of all levels: archive, part, level, node, hash.

    Level 0 hashes the records of a leaf, a range of offsets, in their order; each level
    above hashes FANOUT nodes of the one below; the last is the root.  Hashes hold no
    offsets, so what lies behind a lost record keeps its hash.
    """
    key = ["archive", "part", "node"]

    def hashed(rows: DataFrame, *columns: str) -> DataFrame:
        own = F.sort_array(F.collect_list(F.struct(*columns)))
        texts = F.transform(own, lambda x: F.concat_ws(
            ":", *(F.coalesce(x[c].cast("string"), F.lit("none")) for c in columns)))
        return rows.groupBy(*key).agg(F.sha2(F.concat_ws(" ", texts), 256).alias("hash"))

    level = hashed(laid_out, "page_id", "digest", "copy")
    out = level.withColumn("level", F.lit(0))
    for above in range(1, levels + 1):
        below = level.select(
            "archive", "part", F.floor(F.col("node") / FANOUT).alias("node"),
            F.col("node").alias("child"), "hash",
        )
        level = hashed(below, "child", "hash")
        out = out.unionByName(level.withColumn("level", F.lit(above)))
    return out


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Nodes whose hash is not the same in both, or that are in one only."""
    key = ["archive", "part", "node"]
    return (
        ours.join(theirs.withColumnRenamed("hash", "other"), key, "full")
        .where(~F.col("hash").eqNullSafe(F.col("other")))
        .select(*key)
    )


def _nth(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``: 1, 2, 3 ... within each page, of which any number may differ.

    A page's rows are dealt into cells; a cell starts after the sizes of those before it.
    """
    page = ["archive", "page_id"]
    sizes = rows.groupBy(*page).agg((F.count(F.lit(1)) / CELL_ROWS).cast("long").alias("more"))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    named = lambda df: df.withColumn("page", key)  # noqa: E731  (nulls are a page as well)
    dealt = join_summary(named(rows), named(sizes).drop("page_id"), ["archive", "page"]).withColumn(
        "cell", F.pmod(F.xxhash64("digest", "copy"), F.col("more") + 1)
    )
    before = Window.partitionBy("archive", "page").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = dealt.groupBy("archive", "page", "cell").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select(
        "archive", "page", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("archive", "page", "cell").orderBy("digest", "copy")
    return dealt.join(first, ["archive", "page", "cell"]).withColumn(
        "nth", F.col("first") + F.row_number().over(within)
    )


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records of two replicas' manifests that differ, found by their trees.

    Roots are compared first; below a root that differs, only children of nodes that
    differ are compared, down to ranges of offsets, and only records in these are held
    against each other.  Columns: archive, part, page_id, status, offset, length (ours),
    their_offset, their_length.  status: ``altered`` (same id, other bytes), ``missing``
    (not theirs), ``extra`` (not ours), and ``moved`` (same bytes at another offset, as
    something before it in its part has another length).

    Archives with too many records, such as those of a page id that repeats without end,
    are dealt into parts by what both replicas share, so the order of rows and the loss
    of some change nothing for the others.  Equal records are told apart by number.  A
    null id is an id of its own.  Equal replicas, also empty ones, give no rows.
    """
    with Steps(ours.sparkSession) as steps:
        ours, theirs = steps.store(ours), steps.store(theirs)
        parts = steps.store(_parts(ours, theirs))
        ours, theirs = steps.store(_laid_out(ours, parts)), steps.store(_laid_out(theirs, parts))
        a, b = steps.store(merkle_tree(ours)), steps.store(merkle_tree(theirs))
        take = lambda tree, k: tree.where(F.col("level") == k).drop("level")
        roots = steps.store(_differing(take(a, LEVELS), take(b, LEVELS)))
        bad = roots
        for level in range(LEVELS - 1, -1, -1):
            above = bad.withColumnRenamed("node", "above")
            down = lambda tree, level=level, above=above: (
                take(tree, level)
                .withColumn("above", F.floor(F.col("node") / FANOUT))
                .join(above, ["archive", "part", "above"], "left_semi")
                .drop("above")
            )
            bad = steps.store(_differing(down(a), down(b)))
        suspects = lambda rows: rows.join(bad, ["archive", "part", "node"], "left_semi")
        x, y = suspects(ours).alias("x"), suspects(theirs).alias("y")

        def same_record():
            equal = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("archive", "part", "node", "digest", "copy")]
            return [*equal, F.col("x.page_id").eqNullSafe(F.col("y.page_id"))]

        left = steps.store(_nth(x.join(y, same_record(), "left_anti")))
        right = steps.store(_nth(y.join(x, same_record(), "left_anti")))
        p, q = left.alias("p"), right.alias("q")
        status = (
            F.when(F.col("q.nth").isNull(), "missing").when(F.col("p.nth").isNull(), "extra")
            .otherwise("altered")
        )
        pair = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("archive", "page", "nth")]
        changed = p.join(q, pair, "full").select(
            F.coalesce("p.archive", "q.archive").alias("archive"),
            F.coalesce("p.part", "q.part").alias("part"),
            F.coalesce("p.page_id", "q.page_id").alias("page_id"),
            status.alias("status"),
            F.col("p.offset").alias("offset"),
            F.col("p.length").alias("length"),
            F.col("q.offset").alias("their_offset"),
            F.col("q.length").alias("their_length"),
        )
        # Behind a change of length the bytes are the same, but lie elsewhere.
        shifted = lambda rows: rows.join(roots.drop("node"), ["archive", "part"], "left_semi")
        x, y = shifted(ours).alias("x"), shifted(theirs).alias("y")
        moved = x.join(y, same_record()).where("x.offset <> y.offset").select(
            "x.archive", "x.part", "x.page_id", F.lit("moved").alias("status"), "x.offset", "x.length",
            F.col("y.offset").alias("their_offset"), F.col("y.length").alias("their_length"),
        )
        return steps.keep(steps.store(moved.unionByName(changed)))
