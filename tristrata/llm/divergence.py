"""Source divergence audit: how far each source's words lie from its peers' words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.storage import ARROW_BATCHES, Steps, settings
from tristrata.operators.joining import join_summary

#: Shares are whole numbers of so many parts.
SCALE = 1_000_000_000
#: Documents of a language that a kept term is in, at least.
MIN_DOCS = 3
#: Ranks of part ``term``.
TOP_TERMS = 200
#: Counts a counting task holds before it hands them on.
HELD_COUNTS = 400_000
#: Index entries a slab holds on average, and entries scattered at once.
SLAB_ENTRIES = 200_000
SCATTER = 1 << 20
#: Bytes of a text that are split into terms at once.
PIECE = 1 << 20

# Occurrences and texts of a term are counted in one number, within a task.
_ONE_TEXT = 1 << 36

# In UTF-8 the bytes of every character beyond ASCII are 0x80 or more.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")


def _terms(text: bytes) -> Counter:
    """Counts of the terms of a text; bytes.lower changes A-Z only."""
    found, at = Counter(), 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
        stop = gap.start() if gap else len(text)
        # A stretch is cut before a byte that is in no term.
        found.update(_TERM.findall(text[at:stop].lower()))
        at = stop
    return found


def _counted(docs: DataFrame) -> DataFrame:
    """tf and df of each (lang, source, term), added up within a task first."""

    def frames(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            n = len(counts)
            both = np.fromiter(counts.values(), "int64", n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang, pa.string()), n),
                    pa.repeat(pa.scalar(source, pa.string()), n),
                    pa.array(list(counts), pa.binary()),
                    pa.array(both & (_ONE_TEXT - 1)),
                    pa.array(both // _ONE_TEXT),
                ],
                names=["lang", "source", "term", "tf", "df"],
            )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = held.setdefault((lang, source), {})
                before, seen = len(counts), counts.get
                for term, n in _terms(text).items():
                    counts[term] = seen(term, 0) + n + _ONE_TEXT
                size += len(counts) - before
                if size > HELD_COUNTS:
                    yield from frames(held)
                    held, size = {}, 0
        yield from frames(held)

    given = docs.select("lang", "source", F.col("text").cast("binary"))
    counts = given.mapInArrow(made, "lang string, source string, term binary, tf long, df long")
    # All that is done by term needs this one shuffle.
    return (
        counts.withColumn("term", F.col("term").cast("string"))
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + 1 * kept)), exact; 1 where nothing is kept."""
    part = (
        f"cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + 1) "
        f"div (cast({total} as decimal(20,0)) + {kept})"
    )
    return F.expr(f"case when {kept} = 0 then 1L else 1L + ({part}) end")


def _apart(p, q):
    """floor((p - q)^2 / q) of whole numbers up to SCALE + 1, so within 64 bits."""
    return (p - q) * (p - q) // q


def _scattered(entries: DataFrame) -> DataFrame:
    """For each group and each peer it shares terms with: what the shared terms add.

    A task holds a slab of the term-major index, all entries of some terms.  Each group
    walks its terms' rows there and adds into one dense accumulator with a cell for each
    peer, so no pair of entries becomes a row.  Added is the term's value less what the
    baselines count for it, as if one side or both lacked it.
    """

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slab = pd.concat(list(batches), ignore_index=True)
        if not len(slab):
            return
        lang, number = slab["lang"].iloc[0], pd.factorize(slab["term"])[0]
        by_term = np.argsort(number, kind="stable")
        number = number[by_term]
        p, p0 = (slab[c].to_numpy("int64")[by_term] for c in ("p", "p0"))
        names, sid = np.unique(slab["sid"].to_numpy("int64")[by_term], return_inverse=True)
        first = np.searchsorted(number, np.arange(number[-1] + 2))
        by_group = np.argsort(sid, kind="stable")
        ends = np.searchsorted(sid[by_group], np.arange(len(names) + 1))
        for g in range(len(names)):
            own = by_group[ends[g] : ends[g + 1]]
            low = first[number[own]]
            length = first[number[own] + 1] - low
            cells, before = np.zeros(len(names), "int64"), np.cumsum(length) - length
            at = 0
            while at < len(own):
                stop = max(at + 1, int(np.searchsorted(before, before[at] + SCATTER)))
                size = length[at:stop]
                run = np.arange(size.sum()) - np.repeat(before[at:stop] - before[at], size)
                place = np.repeat(low[at:stop], size) + run
                mine, none = np.repeat(p[own[at:stop]], size), p0[own[0]]
                theirs, lacking = p[place], p0[place]
                value = _apart(mine, theirs) - _apart(mine, lacking)
                value += _apart(none, lacking) - _apart(none, theirs)
                np.add.at(cells, sid[place], value)
                at = stop
            cells[g] = 0
            met = np.flatnonzero(cells)
            yield pd.DataFrame(
                {"lang": lang, "sid": names[g], "peer": names[met], "value": cells[met]}
            )

    return entries.groupBy("lang", "slab").applyInPandas(
        made, "lang string, sid long, peer long, value long"
    )


def _baselines(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """For each pair of groups of a language: the sum over all kept terms as if no term
    were in both.

    A group's terms count by its distinct shares, of which there are few; peers are a
    dense vector per language.
    """
    shares = entries.groupBy("lang", "sid", "p").agg(F.count(F.lit(1)).alias("m"))
    shares = shares.groupBy("lang", "sid").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    peers = groups.groupBy("lang").agg(
        F.collect_list(F.struct("sid", "p0", "terms")).alias("peers")
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                peer, q0, held = (
                    np.array([x[c] for x in row["peers"]], "int64") for c in ("sid", "p0", "terms")
                )
                there, back = np.zeros(len(peer), "int64"), np.zeros(len(peer), "int64")
                for share in row["shares"] or ():
                    there += share["m"] * _apart(share["p"], q0)
                    back += share["m"] * _apart(q0, share["p"])
                there += (row["kept"] - row["terms"] - held) * _apart(row["p0"], q0)
                here = np.full(len(peer), row["sid"])
                other = peer != row["sid"]
                for a, b, value in ((here, peer, there), (peer, here, back)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["lang"]] * int(other.sum()), pa.string()),
                            *(pa.array(x[other], pa.int64()) for x in (a, b, value)),
                        ],
                        names=["lang", "sid", "peer", "value"],
                    )

    rows = groups.select("lang", "sid", "p0", "terms", "kept").join(
        shares, ["lang", "sid"], "left"
    )
    return join_summary(rows, peers, ["lang"], "inner").select(
        "lang", "sid", "p0", "terms", "kept", "shares", "peers"
    ).mapInArrow(made, "lang string, sid long, peer long, value long")


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """How far each (lang, source) group's use of words lies from its peers and language.

    Terms are runs of letters A-Z (lower-cased) and of characters beyond ASCII.  Each
    language keeps the terms in ``min_docs`` of its rows or more.  A group's or
    language's share of a kept term is p = 1 + floor(1e9 * (count + 1) / (N + V)), with N
    the counts' sum and V the number of kept terms; the value of a share p against q is
    floor((p - q)^2 / q).  Columns: lang, source, part, item, value, rank.

    * ``pair``: each other source of the language, the sum over all kept terms; all ranks.
    * ``term``: each kept term that the group holds and uses more than its language; the
      first ``top`` ranks.

    Ranks go by value descending, then item in UTF-8 order.  Null text, lang and source
    are ''; groups without terms, or in a language that keeps none, have their pairs
    (value 0 where V is 0); a lone source has none; each row is a document, repeated rows
    too; very long texts are split piece by piece; other columns are ignored; no rows
    give none.

    Counts are added up within tasks, then shuffled once by term.  Kept counts form a
    term-major index of (group, share) in slabs of about SLAB_ENTRIES entries; groups
    scatter their terms through it (``_scattered``), and the terms only one side or none
    holds come from baselines (``_baselines``).  Work is the index rows' squares, as the
    sums are over all pairs; memory is a slab and a vector of the language's groups.
    """
    spark = docs.sparkSession
    given = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    with Steps(spark) as steps, settings(spark, **ARROW_BATCHES):
        term = Window.partitionBy("lang", "term")
        kept = steps.store(
            _counted(given)
            .select(
                "lang", "source", "term", "tf",
                F.sum("df").over(term).alias("in_docs"),
                F.sum("tf").over(term).alias("lang_tf"),
                (F.min("source").over(term) == F.col("source")).alias("is_first"),
            )
            .where(F.col("in_docs") >= min_docs)
            .drop("in_docs")
        )
        langs = kept.groupBy("lang").agg(
            F.count_if("is_first").alias("kept"), F.sum("tf").alias("lang_n")
        )
        own = kept.groupBy("lang", "source").agg(
            F.sum("tf").alias("n"), F.count(F.lit(1)).alias("terms")
        )
        some = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        found = given.select("lang", "source").distinct().join(own, ["lang", "source"], "left")
        found = found.join(langs, "lang", "left").select(
            "lang", "source", *map(some, ("n", "terms", "kept", "lang_n"))
        )
        numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
        groups = steps.store(
            found.withColumn("sid", numbered.cast("long"))
            .withColumn("zero", F.lit(0))
            .withColumn("p0", _share("zero", "n", "kept"))
            .drop("zero")
        )
        entries = steps.store(
            join_summary(kept, groups, ["lang", "source"], "inner").select(
                "lang", "source", "sid", "term", "p0",
                _share("tf", "n", "kept").alias("p"),
                _share("lang_tf", "lang_n", "kept").alias("q"),
            )
        )
        steps.drop(kept)
        size = groups.groupBy("lang").agg(F.sum("terms").alias("entries"))
        slabs = size.select("lang", F.expr(f"entries div {SLAB_ENTRIES} + 1").alias("slabs"))
        dealt = join_summary(entries, slabs, ["lang"], "inner").select(
            "lang", "sid", "term", "p", "p0",
            F.pmod(F.xxhash64("term"), F.col("slabs")).alias("slab"),
        )
        pairs = (
            _scattered(dealt)
            .union(_baselines(groups, entries))
            .groupBy("lang", "sid", "peer")
            .agg(F.sum("value").alias("value"))
        )
        ids = groups.select("lang", "sid", "source")
        named = pairs.join(ids, ["lang", "sid"]).join(
            ids.select("lang", F.col("sid").alias("peer"), F.col("source").alias("item")),
            ["lang", "peer"],
        )
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        rank = F.row_number().over(by_value).alias("rank")
        out = ["lang", "source", "part", "item", "value"]
        pair_part = named.withColumn("part", F.lit("pair")).select(*out, rank)
        over = entries.where("p > q").select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            F.expr("(p - q) * (p - q) div q").alias("value"),
        )
        term_part = over.select(*out, rank).where(F.col("rank") <= top)
        return steps.keep(steps.store(pair_part.union(term_part)))
