"""Parity-sketch join: all links of a Jaccard threshold, and their components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.storage import (
    Steps,
    maybe_at,
    maybe_in,
    place_of,
    small_batches,
    text_of,
    without_places,
)
from tristrata.llm.words import Words, mix, shingle_sets
from tristrata.operators.joining import join_summary

#: Longs in a document's parity sketch, a power of two, and in its fold.
SKETCH_LONGS = 32
FOLD_LONGS = 8
#: Rounds in which a part's documents are held against one of them, before the rest.
STAR_ROUNDS = 2
#: Bits of the filter for keys that several classes share (4 MB).
KEY_BITS = 1 << 25

_U = np.uint64


@lru_cache(maxsize=8)
def _bands(num: int, den: int) -> list[int]:
    """Lower ends of the size bands: a set links with sets of its own band or a
    neighbouring one only."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(ends[-1] * den // num + 1)
    return ends


def _parts(band: int, num: int, den: int) -> tuple[int, int]:
    """For pairs whose smaller set is of ``band``: how far they may differ, and into how
    many parts their shingles are dealt.

    With more parts than differences, so many parts agree in both sets.  Some parts are
    empty, and agree for nothing; ``slack`` more parts allow for them.
    """
    low, high = _bands(num, den)[band : band + 2]
    apart = (high - 1) * (den - num) // num
    if apart == 0:
        return 0, 0
    slack = int(1.5 * (apart + 1) * np.exp(-low / (apart + 1))) + 1
    return apart, apart + 1 + slack


def _sketches(shingles: np.ndarray) -> tuple[int, int, list[int], list[int]]:
    """Two digests of the set, its parity sketch (a bit for each slot that an odd number of
    shingles fall into), and the sketch of fewer slots that it folds into."""
    odd = np.bincount((shingles & _U(64 * SKETCH_LONGS - 1)).astype("int64"),
                      minlength=64 * SKETCH_LONGS).astype("uint8") & 1
    fold = np.bitwise_xor.reduce(odd.reshape(-1, 64 * FOLD_LONGS), axis=0)
    digest = np.bitwise_xor.reduce(shingles), mix(shingles ^ _U(5)).sum(dtype="uint64")
    longs = [np.packbits(x).view("int64").tolist() for x in (odd, fold)]
    return (*(int(d.astype("int64")) for d in digest), *longs)


def _part_keys(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys that two linked sets share at least one of.

    A key is a part's parity (the exclusive or of its shingles) within a band.  A set
    emits its parts that hold shingles; if more of its parts are empty than the slack
    allows for, it emits the empty ones too.  So of two linked sets either one has more
    parts in common with the other than it has empty parts, or both emit all.
    """
    band = int(np.searchsorted(_bands(num, den), len(shingles), "right")) - 1
    out = []
    for b in (band, band - 1):
        if b < 0:
            continue
        apart, parts = _parts(b, num, den)
        if not parts:
            continue
        part = ((shingles >> _U(20)) % _U(parts)).astype("int64")
        parity = np.zeros(parts, "uint64")
        np.bitwise_xor.at(parity, part, shingles)
        number = np.arange(parts, dtype="uint64")
        key = mix(parity ^ mix(number + (_U(b) << _U(40))))
        empty = np.bincount(part, minlength=parts) == 0
        if empty.sum() <= parts - apart - 1:
            key = key[~empty]
        out.append(key)
    return np.concatenate(out).astype("int64") if out else np.zeros(0, "int64")


def _sketched(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(Words(list(batch["text"])), n)
            pairs = [_sketches(s) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "place": batch["place"],
                    "n_shingles": [len(s) for s in sets],
                    "d1": [p[0] for p in pairs],
                    "d2": [p[1] for p in pairs],
                    "sketch": [p[2] for p in pairs],
                    "fold": [p[3] for p in pairs],
                    "keys": [_part_keys(s, num, den) for s in sets],
                }
            )

    schema = "doc_id long, place long, n_shingles long, d1 long, d2 long"
    schema += ", sketch array<long>, fold array<long>, keys array<long>"
    read = docs.select(
        F.col("doc_id").cast("long"), place_of().alias("place"), text_of().alias("text")
    )
    return read.mapInPandas(made, schema).withColumn("row", F.monotonically_increasing_id())


def _may_link(n: str, m: str, apart, num: int, den: int):
    """Sizes allow a link, and so do sketches that differ in ``apart`` bits: the sets
    differ in as many shingles at least."""
    sizes = F.col(n) + F.col(m)
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (
        apart * (den + num) <= sizes * (den - num)
    )


def _bits_apart(sketch: str, other: str):
    differing = F.zip_with(sketch, other, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(differing, F.lit(0), lambda x, y: x + y)


def _bits_apart_unrolled(sketch: str, other: str, longs: int):
    """The same as one plain expression, for very many pairs of short sketches."""
    return sum(
        (F.bit_count(F.get(F.col(sketch), F.lit(i)).bitwiseXOR(F.get(F.col(other), F.lit(i))))
         for i in range(longs)),
        F.lit(0),
    )


def _linked(
    steps: Steps, pairs: DataFrame, docs: DataFrame, rows: DataFrame, n: int, num: int, den: int
) -> DataFrame:
    """The pairs (u, v) whose shingle sets, made again from the texts, do link.

    Only texts that are in a pair are wanted, and few others reach the shuffle.  Sets
    grow with the texts, so they are never broadcast (``merge``).
    """
    ends = pairs.select(F.explode(F.array("u", "v")).alias("row")).distinct()
    wanted = steps.store(rows.select("row", "place").join(ends, "row"))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(Words(list(batch["text"])), n)
            yield pd.DataFrame(
                {"row": batch["row"], "shingles": [s.astype("int64") for s in sets]}
            )

    # Rows that agree in id and text share a place: one of them is enough.
    texts = maybe_at(docs, wanted).groupBy("place").agg(F.first(text_of()).alias("text"))
    sets = steps.store(
        texts.join(wanted.hint("merge"), "place")
        .select("row", "text")
        .mapInPandas(made, "row long, shingles array<long>")
    )
    first = sets.select(F.col("row").alias("u"), F.col("shingles").alias("a"))
    second = sets.select(F.col("row").alias("v"), F.col("shingles").alias("b"))

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common * den >= num * (len(a) + len(b) - common))
            yield batch.loc[keep, ["u", "v"]]

    both = pairs.join(first.hint("merge"), "u").join(second.hint("merge"), "v")
    found = steps.store(both.mapInPandas(kept, "u long, v long"))
    steps.drop(wanted, sets)
    return found


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same rows as left and right side of pairs."""
    names = [
        {"node": "u", "label": "p", "n_shingles": "n", "sketch": "s", "key": "key"},
        {"node": "v", "label": "q", "n_shingles": "m", "sketch": "t", "key": "key"},
    ]
    return tuple(rows.select(*[F.col(c).alias(as_[c]) for c in rows.columns]) for as_ in names)


def _star_pairs(mixed: DataFrame, known: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """Each part's classes with one of them, another one each turn."""
    lowest = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "label")
    pivots = mixed.groupBy("key").agg(F.min(lowest).alias("pivot"))
    pairs = (
        join_summary(mixed, pivots, ["key"], "inner")
        .where("label <> pivot.label")
        .select(
            F.least("node", "pivot.node").alias("u"), F.greatest("node", "pivot.node").alias("v")
        )
        .distinct()
    )
    return _sketches_fit(pairs, known, num, den)


def _sketches_fit(pairs: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    left, right = _sides(known.drop("fold"))
    fits = _may_link("n", "m", _bits_apart("s", "t"), num, den)
    return pairs.join(left, "u").join(right, "v").where(fits).select("u", "v")


def _several(rows: DataFrame, value: str) -> DataFrame:
    """The keys under which ``rows`` have more than one ``value``."""
    ends = rows.groupBy("key").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    return ends.where("a <> b").select("key")


def _rest_pairs(mixed: DataFrame, known: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """All classes of a part that are not in one component yet."""
    folded = known.drop("sketch").withColumnRenamed("fold", "sketch")
    left, right = _sides(mixed.join(folded, "node"))
    different = (F.col("u") < F.col("v")) & (F.col("p") != F.col("q"))
    fits = _may_link("n", "m", _bits_apart_unrolled("s", "t", FOLD_LONGS), num, den)
    both = left.join(right, "key").where(different & fits)
    return _sketches_fit(both.select("u", "v").distinct(), known, num, den)


def components(links: DataFrame, steps: Steps) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for linked nodes.

    Large-star and small-star steps in turn: each node's larger neighbours, then its
    smaller ones, are tied to the smallest of all.  Both work on edges alone, and the
    number of rounds grows with the logarithm of the longest chain.
    """
    edges = steps.store(links.select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            join_summary(both, low, ["u"], "inner")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small_low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = join_summary(down, small_low, ["u"], "inner")
        tied = steps.store(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small_low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        steps.drop(edges)
        edges = tied
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("s"),
        ).first()
        if seen == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = seen


def near_groups(
    steps: Steps, docs: DataFrame, n: int, num: int, den: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with ``label``, one for each component, and the components.

    Rows: doc_id, place, row, n_shingles, label (null without shingles).  Components:
    label, component_id.  See near_components.  Both read step tables.
    """
    small_batches(docs.sparkSession)
    sketched = steps.store(_sketched(docs, n, num, den))
    rows = steps.store(sketched.drop("keys"))
    classes = steps.store(
        rows.where("n_shingles > 0")
        .groupBy("n_shingles", "d1", "d2")
        .agg(F.min("doc_id").alias("low"), F.min("row").alias("node"))
    )
    chosen = sketched.select("row", "keys").join(
        classes.select(F.col("node").alias("row")), "row", "left_semi"
    )
    dealt = chosen.select(F.col("row").alias("node"), F.explode("keys").alias("key"))
    # Most keys are held by one class and meet nothing: they are counted once, in
    # one shuffle, and the filter keeps their rows out of the join.
    held = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = steps.store(held.where("n > 1").select("key"))
    meeting = steps.store(
        join_summary(maybe_in(dealt, shared, KEY_BITS).where("_maybe").drop("_maybe"),
                     shared, ["key"], "inner").select("key", "node")
    )
    steps.drop(sketched, shared)
    nodes = steps.store(meeting.select("node").distinct())
    known = steps.store(
        rows.select(F.col("row").alias("node"), "n_shingles", "sketch", "fold").join(
            nodes, "node", "left_semi"
        )
    )
    # Keys whose classes are all in one component have done their work; from turn to
    # turn fewer are left.
    labels, links = None, None
    mixed = meeting.withColumn("label", F.col("node"))
    for turn in range(STAR_ROUNDS + 1):
        if turn:
            told = steps.store(mixed.drop("label").join(labels, "node"))
            steps.drop(mixed)
            mixed = steps.store(join_summary(told, _several(told, "label"), ["key"], "left_semi"))
            steps.drop(told)
        find = _star_pairs if turn < STAR_ROUNDS else _rest_pairs
        pairs = steps.store(find(mixed, known, turn, num, den))
        new = _linked(steps, pairs, docs, rows, n, num, den)
        steps.drop(pairs)
        links = new if links is None else links.union(new)
        labels = steps.store(
            nodes.join(components(links, steps), "node", "left").select(
                "node", F.coalesce("label", "node").alias("label")
            )
        )
    lows = steps.store(
        classes.join(labels, "node", "left").select(
            "n_shingles", "d1", "d2", "low", F.coalesce("label", "node").alias("label")
        )
    )
    grouped = rows.select("doc_id", "place", "row", "n_shingles", "d1", "d2").join(
        lows.drop("low"), ["n_shingles", "d1", "d2"], "left"
    )
    return grouped.drop("d1", "d2"), lows.groupBy("label").agg(F.min("low").alias("component_id"))


def near_components(
    docs: DataFrame, n: int = 3, num: int = 90, den: int = 100
) -> DataFrame:
    """Every document with its number of shingles and its component of links.

    Documents link if ``den`` * intersection >= ``num`` * union of their sets of distinct
    ``n``-word shingles (words lower-cased A-Z; with fewer words the whole sequence is
    one shingle).  Columns: doc_id, n_shingles, component_id (the smallest doc_id that
    links lead to, the document's own included).

    1. Documents with equal sets form a class; classes take part once.
    2. A set's shingles are dealt by hash into one part more than linked sets of its size
       band may differ in, and each part is summed up by exclusive or: linked sets agree
       in a part.  Classes meet where a part's parity is equal.
    3. There, pairs pass whose sizes and whole parity sketches allow a link, and are then
       verified on the sets themselves.  First all classes of a part are held against one
       of them, in STAR_ROUNDS rounds with another one each; components are formed, and
       only classes of a part that are still in different components are paired.  So
       groups of copies cost their size, not its square, and no link between components
       is lost.

    Null or empty texts and texts without words have no shingles, link with nothing and
    are their own component.  A null doc_id takes part, but is never a component's id
    while another id is there.  Repeated rows are one class.  Other columns are ignored.
    """
    with Steps(docs.sparkSession) as steps:
        rows, ids = near_groups(steps, docs, n, num, den)
        # A component may hold a third of the rows: the join can be split within a label.
        named = join_summary(rows, ids, ["label"]).select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        )
        return steps.keep(steps.store(named))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs``, of each component only the document with the smallest id.

    A null id comes after all others; of rows that agree in id and text one stays.
    Documents without words link with nothing, so all of them stay.  Very long texts,
    ties and empty tables are as in near_components; columns pass as they are, whatever
    their names.
    """
    with Steps(docs.sparkSession) as steps:
        rows, _ = near_groups(steps, docs, n, num, den)
        grouped = steps.store(rows.where("label is not null").select("doc_id", "place", "row", "label"))
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "place", "row")
        best = grouped.groupBy("label").agg(F.min(order).alias("best"))
        judged = steps.store(
            join_summary(grouped, best, ["label"], "inner").select(
                "place", (F.col("row") == F.col("best.row")).alias("stays")
            )
        )
        copies = judged.groupBy("place").agg(
            F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")
        ).where("not stays or n > 1")
        gone = steps.keep(steps.store(copies))
    return without_places(docs, gone)
