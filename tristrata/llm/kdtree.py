"""K-d tree sharding: weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.numbering import number_within
from tristrata.llm.storage import stored, text_of

SHARDS = 24
BINS = 1024
#: A cut may miss its weighted median by this share of a leaf.
TOLERANCE = 0.0005
PASSES = 12
DIMENSIONS = ("d_size", "d_source", "d_lang", "d_id")


@dataclass
class Node:
    """Rows between cuts, to become ``leaves`` shards from ``first`` on."""

    number: int
    first: int
    leaves: int
    dimension: str | None = None
    cut: float = 0.0
    below: Node | None = None
    above: Node | None = None


def _metadata(docs: DataFrame) -> DataFrame:
    """One narrow row per document; coordinates lie in 0 to 1."""
    size = F.octet_length(text_of()).cast("long") + 8
    hashed = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 20)) / float(1 << 20)
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        hashed("source").alias("d_source"),
        hashed("lang").alias("d_lang"),
        F.monotonically_increasing_id().alias("row"),
    )


def _coordinates(rows: DataFrame) -> DataFrame:
    """Size and id scaled by the extent of the table; equal values spread by a hash.

    The hash moves a value by less than 2^-20, so it orders rows only within a tie, and
    a cut can go through a tie of any size.
    """
    low = rows.agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.max("size").alias("s")
    ).first()
    # As doubles: ids may lie further apart than a long can tell.
    start = float(low["a"] or 0)
    extent = max(1.0, float(low["b"] or 0) - start)
    most = float(low["s"] or 8)
    place = {
        "d_size": F.log2(F.col("size") / 8.0) / F.log2(F.lit(max(16.0, most) / 8.0)),
        "d_source": F.col("d_source"),
        "d_lang": F.col("d_lang"),
        "d_id": F.coalesce((F.col("doc_id").cast("double") - start) / extent, F.lit(0.0)),
    }
    spread = F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), F.lit(1 << 32)) / float(1 << 52)
    return rows.withColumns({k: v + spread for k, v in place.items()})


def _place(node: Node, leaf) -> Column:
    if node.dimension is None:
        return leaf(node)
    under = F.col(node.dimension) < F.lit(node.cut)
    return F.when(under, _place(node.below, leaf)).otherwise(_place(node.above, leaf))


def _extents(rows: DataFrame, at: Column) -> dict[int, dict]:
    spans = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.groupBy(at.alias("node")).agg(F.sum("size").alias("bytes"), *spans).collect()
    return {r["node"]: r.asDict() for r in found}


def _weighted_cuts(rows: DataFrame, at: Column, open_nodes: list[Node], extents: dict) -> None:
    """Cuts of all nodes of a level: histograms of bytes, refined around each median."""
    state = {}
    for node in open_nodes:
        e = extents.get(node.number)
        if e is None:
            node.dimension, node.cut = DIMENSIONS[0], 0.0
            continue
        widest = max(DIMENSIONS, key=lambda d: e[f"hi_{d}"] - e[f"lo_{d}"])
        node.dimension = widest
        lo, hi = e[f"lo_{widest}"], e[f"hi_{widest}"]
        state[node.number] = {
            "lo": lo,
            "hi": hi + (hi - lo) * 1e-9 + 1e-15,
            "before": 0,
            "goal": e["bytes"] * (node.leaves // 2) / node.leaves,
            "leaf": e["bytes"] / node.leaves,
            "dim": widest,
        }
        node.cut = lo
    by_number = {n.number: n for n in open_nodes}
    for _ in range(PASSES):
        if not state:
            return
        bin_of = F.lit(None).cast("int")
        for number, s in state.items():
            width = (s["hi"] - s["lo"]) / BINS
            place = F.floor((F.col(s["dim"]) - F.lit(s["lo"])) / F.lit(width)).cast("int")
            inside = (at == number) & (F.col(s["dim"]) >= s["lo"]) & (F.col(s["dim"]) < s["hi"])
            bin_of = F.when(inside, F.least(place, F.lit(BINS - 1))).otherwise(bin_of)
        bins = (
            rows.select(at.alias("node"), bin_of.alias("bin"), "size")
            .where(F.col("bin").isNotNull())
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("bytes"))
            .collect()  # BINS numbers a node, 24 nodes at most
        )
        per_node: dict[int, dict[int, int]] = {}
        for r in bins:
            per_node.setdefault(r["node"], {})[r["bin"]] = r["bytes"]
        for number, s in list(state.items()):
            width, done = (s["hi"] - s["lo"]) / BINS, s["before"]
            for b, weight in sorted(per_node.get(number, {}).items()):
                if done + weight >= s["goal"]:
                    break
                done += weight
            else:
                b, weight = BINS, 0
            low, high = s["lo"] + b * width, s["lo"] + (b + 1) * width
            near_high = done + weight - s["goal"] < s["goal"] - done
            by_number[number].cut = high if near_high else low
            if weight <= TOLERANCE * s["leaf"] or not low < high or high - low < 1e-14:
                del state[number]
            else:
                s |= {"lo": low, "hi": high, "before": done}


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its shard, so that shards hold nearly equal bytes.

    The tree starts with all documents.  A node that stands for ``k`` shards is cut along
    its widest dimension (logarithm of the size, source, language, id; each scaled to
    0..1) where ``k // 2`` of its ``k`` parts of the bytes lie below, until each leaf is
    one shard of the target bytes.  Cuts are found on all rows, by histograms that are
    added up on the executors; a level costs a few passes over a narrow written table.

    Columns: doc_id, size (UTF-8 bytes plus 8), text_crc32, law (``bytes``), shard, slot
    (gapless from 0 in each shard), grown_shard (null: not a law by key).

    Null text counts as empty; null metadata is a value of its own; repeated rows and
    equal values are spread by a hash of the row; other columns are ignored.  Without
    documents the result is empty.
    """
    rows = _coordinates(stored(_metadata(docs)))
    root = Node(0, 0, shards)
    nodes, frontier = 1, [root]
    while frontier:
        at = _place(root, lambda n: F.lit(n.number))
        to_cut = [n for n in frontier if n.leaves > 1]
        if not to_cut:
            break
        _weighted_cuts(rows, at, to_cut, _extents(rows, at))
        frontier = []
        for node in to_cut:
            half = node.leaves // 2
            node.below = Node(nodes, node.first, half)
            node.above = Node(nodes + 1, node.first + half, node.leaves - half)
            nodes += 2
            frontier += [node.below, node.above]
    placed = rows.select(
        "doc_id", "size", "text_crc32", "row", _place(root, lambda n: F.lit(n.first)).alias("shard")
    )
    return number_within(placed, "shard", ["doc_id", "row"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
