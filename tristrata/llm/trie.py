"""Prefix trie of conversations by van Emde Boas recursion."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.storage import ARROW_BATCHES, Steps, settings
from tristrata.operators.joining import join_summary

#: Conversations whose first turns are shared, and turns shared at most (less one).
FAMILY, SHARED = 100, 6
#: Width of the ranges of conversation ids that are joined into one text at a time.
RUN = 8192

#: The prefix without turns.
_ROOT_NAME = b"\x00"


def _digest(*parts: Column) -> Column:
    """128 bits that stand for the parts (binary, with fixed lengths but for the last)."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _numbered(steps: Steps, turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``: 0, 1, 2 ... in each conversation.

    The rows are sorted by range over all tasks, so a conversation of any length spans
    as many tasks as its rows need: each task ranks its stretch, and what lies before a
    stretch is a running sum over the tasks.
    """
    order = ["conv_id", "turn", "role", "text"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = steps.store(
        turns.repartitionByRange(parts, *[F.asc_nulls_first(c) for c in order])
        .withColumn("part", F.spark_partition_id())
        .withColumn("name", _digest(F.sha2("role", 256).cast("binary"), F.col("text").cast("binary")))
        .withColumn("chars", F.length("text").cast("long"))
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select(
        "conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("conv_id", "part").orderBy(
        F.asc_nulls_first("turn"), "role", "text"
    )
    numbered = steps.store(
        join_summary(
            dealt.withColumn("at", F.row_number().over(within)).select(
                "conv_id", "part", "at", "chars", "name"
            ),
            first, ["conv_id", "part"], "inner",
        ).select("conv_id", (F.col("first") + F.col("at") - 1).alias("pos"), "chars", "name")
    )
    steps.drop(dealt)
    return numbered


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (``c``), and the turns (``c``, ``pos``, name, chars) of each: the
    first turns of the one that opens its family, then its own after as many."""
    shared = (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).cast("long")
    convs = turns.select(F.col("conv_id").alias("c")).distinct()
    heads = convs.select("c", (F.col("c") - F.col("c") % FAMILY).alias("conv_id"), shared.alias("h"))
    front = turns.where(F.col("pos") < SHARED - 1)
    opening = heads.where("h > 0").join(front, "conv_id").where("pos < h")
    there = opening.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    own = turns.withColumnRenamed("conv_id", "c").where(F.col("pos") >= shared)
    # An absent or short opening leaves no gap.
    moved = join_summary(own, there, ["c"]).select(
        "c", (F.col("pos") - shared + F.coalesce("n", F.lit(0))).alias("pos"), "chars", "name"
    )
    return convs, opening.select("c", "pos", "chars", "name").union(moved)


def _halves(blocks: DataFrame) -> DataFrame:
    """Blocks of twice the length: ``name``, and the names of both halves."""
    odd = F.col("i") % 2 == 1
    pairs = blocks.groupBy("c", (F.shiftright("i", 1)).alias("i")).agg(
        F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right")
    )
    both = _digest(F.col("left"), F.coalesce("right", F.lit(b"")))
    return pairs.withColumn("name", both)


def _edge(at: str = "") -> list[Column]:
    """An edge: a prefix, the block that follows it (``name``, the ``i``-th of its
    sequences), the smallest sequence through it and the number of them, the sequence
    that ends in it, and the prefix after it if one goes on."""
    own = ("prefix", "name", "i", "end", "next")
    return [*(F.col(at + k).alias(k) for k in own), F.col("c"), F.col("n")]


def _merged(edges: DataFrame) -> DataFrame:
    """One edge for each prefix and each block that follows it."""
    # Of the sequences that share an edge at most one ends in it, and all agree in the rest.
    merged = edges.groupBy("prefix", "name").agg(
        *[F.max(k).alias(k) for k in ("i", "end", "next")],
        F.min("c").alias("c"), F.sum("n").alias("n"),
    )
    return merged.select(*_edge())


def _cut(edges: DataFrame, halves: DataFrame) -> DataFrame:
    """Edges cut at half depth: the upper halves, and the lower ones under the name of
    the prefix at the cut."""
    goes_on = F.col("right").isNotNull()
    cut = (
        edges.drop("name")
        .join(halves.select("c", "i", "left", "right"), ["c", "i"])
        .withColumn("middle", F.when(goes_on, _digest(F.col("prefix"), F.col("left"))))
    )
    upper = F.struct(
        F.col("prefix"), F.col("left").alias("name"), (F.col("i") * 2).alias("i"),
        F.when(~goes_on, F.col("end")).alias("end"), F.col("middle").alias("next"),
    )
    lower = F.struct(
        F.col("middle").alias("prefix"), F.col("right").alias("name"),
        (F.col("i") * 2 + 1).alias("i"), F.col("end"), F.col("next"),
    )
    both = F.when(goes_on, F.array(upper, lower)).otherwise(F.array(upper))
    return cut.select("c", "n", F.explode(both).alias("e")).select(*_edge("e."))


def _id_digests(members: DataFrame, key: str) -> DataFrame:
    """The SHA-256 of each key's ids ``c``, ascending and joined by commas.

    Ids of a range of RUN values are joined first, by Spark.  Where a key has several
    ranges, their texts pass one after the other through one hash: SHA-256 can only be
    taken in order, so a key's texts go to one task, but as a stream, sorted by Spark.
    """
    runs = members.groupBy(key, F.expr(f"c div {RUN}").alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids")
    )
    spans = runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("spans"), F.max(F.struct("run", "ids")).alias("last")
    )
    single = spans.where("spans = 1").select(key, F.sha2("last.ids", 256).alias("sha"))
    several = join_summary(runs, spans.where("spans > 1").select(key), [key], "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(which, state):
            return pa.RecordBatch.from_arrays(
                [pa.array([which], pa.binary()), pa.array([state.hexdigest()])], names=[key, "sha"]
            )

        now, state = None, None
        for batch in batches:
            for which, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or which != now:
                    if state is not None:
                        yield row(now, state)
                    now, state = which, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if state is not None:
            yield row(now, state)

    ordered = several.select(key, "run", "ids").repartition(key).sortWithinPartitions(key, "run")
    return single.union(ordered.mapInArrow(hashed, f"{key} binary, sha string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations: a row for each distinct prefix.

    A conversation's turns are ordered by turn (null first; ties by role, then text),
    null roles and texts being empty.  Its rebuilt form has the first h turns of the
    conversation that opens its hundred (all if it has fewer, none if it is absent) and
    its own after its first h, h = crc32(decimal id) % 6.  Columns: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Rows with a null conv_id belong to no conversation and take no part; repeated rows
    are turns like others; empty and very long texts count by their code points;
    conversations left without turns end at the root; other columns are ignored; no
    conversations, no rows.

    1. Sequences are cut at half depth, the halves again, and so on: blocks of 1, 2, 4 ...
       turns get names, each from the names of its halves (_halves).
    2. From the longest blocks down, an edge is a prefix and a block that follows it.
       Edges are cut at half depth; the prefix there gets a name, under which the lower
       halves form forests of their own, and equal halves merge (_cut, _merged).  Both
       kinds go on together: a level holds half as many rows as the next, and a sequence
       enters at the level of its length.
    3. Edges of one turn are the trie's nodes.  Totals of the block tries are added up,
       short ones first, and then grafted upward onto the prefixes they hang from, from
       long cuts to short ones.

    No step gathers a conversation or a node's members in one task: groups are summed
    map-side, and joins are one to one, or split within a hot key.
    """
    spark = conversations.sparkSession
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", empty("role"), empty("text")
    )
    with Steps(spark) as steps, settings(spark, **ARROW_BATCHES):
        convs, rows = _rebuilt(_numbered(steps, turns))
        rows = steps.store(rows.select("c", F.col("pos").alias("i"), "name", "chars"))
        convs = steps.store(convs)
        lengths = steps.store(
            convs.join(rows.groupBy("c").agg(F.count(F.lit(1)).alias("size")), "c", "left")
        )
        longest = lengths.agg(F.max("size")).first()[0]
        if longest is None:
            return steps.keep(steps.store(_rooted(steps, convs, lengths, None)))
        levels = (longest - 1).bit_length()

        # 1. names of blocks; a sequence stops where one block holds all of it.
        halves, whole, blocks = {}, {}, rows.select("c", "i", "name")
        for level in range(levels + 1):
            fits = F.col("size") > (1 << level)
            tops = lengths.where(~fits & (F.col("size") > (1 << level >> 1))).select("c")
            whole[level] = steps.store(
                blocks.where("i = 0").join(tops, "c", "left_semi").select("c", "name")
            )
            if level < levels:
                more = join_summary(blocks, lengths.where(fits).select("c"), ["c"], "left_semi")
                halves[level + 1] = steps.store(_halves(more))
                blocks = halves[level + 1].select("c", "i", "name")
        ends = reduce(DataFrame.union, whole.values()).withColumnRenamed("name", "end")

        # 2. edges, from the longest blocks down.
        edges = {}
        for level in range(levels, -1, -1):
            entering = whole[level].select(
                F.lit(_ROOT_NAME).alias("prefix"), "name", F.lit(0).cast("long").alias("i"),
                F.col("name").alias("end"), F.lit(None).cast("binary").alias("next"),
                "c", F.lit(1).cast("long").alias("n"),
            )
            if level < levels:
                entering = entering.union(_cut(edges[level + 1], halves[level + 1]))
            edges[level] = steps.store(_merged(entering))

        # 3. totals of block tries, short ones first.
        turn = rows.select("c", "i", "chars")
        weighed = edges[0].join(turn, ["c", "i"]).select(
            "prefix", "c", "i", "n", "end", "next",
            F.col("next").isNull().cast("long").alias("leaf"),
            ((F.col("n") - 1) * F.col("chars")).alias("saved"),
        )
        nodes = steps.store(weighed)
        sums = [F.sum(c).alias(c) for c in ("leaf", "saved")]
        below = {0: steps.store(nodes.groupBy("prefix").agg(
            *sums, F.count(F.lit(1)).alias("children"), F.max("i").alias("i")))}
        none = F.lit(None).cast("long")
        for level in range(1, levels + 1):
            short = below[level - 1].select("prefix", "i", "leaf", "saved")
            hanging = edges[level - 1].where("i % 2 = 0 and next is not null").select(
                F.col("prefix").alias("above"), F.col("next").alias("prefix")
            ).join(short.drop("i"), "prefix").select(
                F.col("above").alias("prefix"), none.alias("i"), "leaf", "saved"
            )
            own = short.where("i % 2 = 0").union(hanging).groupBy("prefix")
            half = F.shiftright(F.max("i"), 1).alias("i")
            below[level] = steps.store(own.agg(half, *sums))

        # Grafted upward: a prefix has all below it once the next cut's prefixes have.
        known = steps.store(below[levels].select("prefix", "leaf", "saved"))
        for level in range(levels - 1, -1, -1):
            odd = F.col("i") % 2 == 1
            own = below[level].where(odd).select("prefix", "leaf", "saved")
            beyond = edges[level].where(odd & F.col("next").isNotNull()).select(
                F.col("prefix").alias("above"), F.col("next").alias("prefix")
            ).join(known, "prefix").select(F.col("above").alias("prefix"), "leaf", "saved")
            grafted = own.union(beyond).groupBy("prefix").agg(*sums)
            known = steps.store(known.union(grafted))
        inner = known.join(below[0].select("prefix", "children"), "prefix")

        named = inner.select(
            F.col("prefix").alias("next"), "children", F.col("leaf").alias("leaves"),
            F.col("saved").alias("deeper"),
        )
        # Nulls would meet in one task of a join: rows without the key pass beside it.
        whole_node = ["prefix", "c", "i", "n", "end", "next"]
        full = steps.store(
            nodes.where("next is not null").join(named, "next").select(
                *whole_node, "children", "leaves", (F.col("saved") + F.col("deeper")).alias("saved")
            ).union(nodes.where("next is null").select(
                *whole_node, F.lit(0).cast("long"), F.lit(1).cast("long"), "saved"
            ))
        )
        lowest = convs.agg(F.min("c")).first()[0]
        parents = full.where("next is not null").select(
            F.col("next").alias("prefix"), F.col("c").alias("parent")
        ).union(spark.range(1).select(F.lit(_ROOT_NAME).alias("prefix"), F.lit(lowest).alias("parent")))
        digests = steps.store(_id_digests(ends, "end"))
        below_root = inner.where(F.col("prefix") == F.lit(_ROOT_NAME)).select("children", "leaf", "saved")
        placed = join_summary(full, parents, ["prefix"], "inner")
        ending = placed.where("end is not null").join(digests, "end").select(*placed.columns, "sha")
        others = placed.where("end is null").withColumn("sha", F.sha2(F.lit(b""), 256))
        told = ending.union(others).select(
            F.col("c").alias("conv_id"), (F.col("i") + 1).alias("depth"), F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.col("sha").alias("ends_sha256"),
        )
        return steps.keep(steps.store(told.union(_rooted(steps, convs, lengths, below_root))))


def _rooted(steps: Steps, convs: DataFrame, lengths: DataFrame, below: DataFrame | None) -> DataFrame:
    """The root: all conversations are its members, those without turns end there."""
    turnless = lengths.where("size is null").select(F.lit(_ROOT_NAME).alias("end"), "c")
    sha = _id_digests(turnless, "end").select("sha")
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    if below is None:
        below = steps.spark.range(1).selectExpr("0L as children", "1L as leaf", "0L as saved")
    # One row each.
    here = F.lit(1)
    joined = root.withColumn("one", here).join(below.withColumn("one", here), "one").join(
        sha.withColumn("one", here), "one", "left"
    )
    return joined.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs", F.col("children").alias("n_children"), F.col("leaf").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
