"""JSON records that span lines, out of files of any size, by many tasks.

Spark's own multi-line mode gives a whole file to one task.  Here a file is read in
splits, and the records' borders come from two things that add up along it: whether a
place is inside a string, and how many brackets are open there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby, pairwise
from operator import add, itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristrata.sources.ndjson import parse_json

#: Every record ends with one, so chunks that end with it hold one record's end at most.
CLOSE = "}"

_OPENERS, _CLOSERS = "{[", "}]"
#: With a brace counted after each chunk, the bytes of a file are one over its size if
#: its last chunk has none.  A byte order mark (3 bytes) is not read.
_OPEN_END = (1, -2)
_SPLIT = ["path", "split"]
_LEAST_SPLITS = "spark.sql.files.minPartitionNum"


def _number_of(signs: str, text: Column) -> Column:
    found = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(s), F.lit(""))) for s in signs)
    return reduce(add, found)


def _depth_change(text: Column) -> Column:
    """Brackets opened less those closed."""
    return (_number_of(_OPENERS, text) - _number_of(_CLOSERS, text)).cast("long")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The text of the files, cut after each closing brace; a task has the chunks of a
    split one after the other, in order."""
    # The files are read more than once, and in the same splits each time.  Spark makes
    # them by the number of cores, which changes when executors come or go.
    if spark.conf.get(_LEAST_SPLITS, None) is None:
        spark.conf.set(_LEAST_SPLITS, str(spark.sparkContext.defaultParallelism))
    read = spark.read.option("lineSep", CLOSE).text(path)
    size = F.col("_metadata.file_size")
    return read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        size.alias("size"),
        (F.col("_metadata.file_block_length") < size).alias("is_part"),
        F.col("value").alias("text"),
    )


def _with_state(chunks: DataFrame) -> DataFrame:
    """What each chunk does to the state: ``flips`` (an odd number of quotes), and the
    change of depth if it starts outside (``out``) or inside (``within``) a string."""
    # A backslash and what it escapes say nothing about borders.
    plain = F.concat(F.regexp_replace("text", r"(?s)\\.", ""), F.lit(CLOSE))
    # What is outside strings if the start is; the rest is, if the start is inside one.
    out = _depth_change(F.regexp_replace(plain, '"[^"]*"?', ""))
    return chunks.select(
        "*",
        (_number_of('"', plain) % 2).alias("flips"),
        out.alias("out"),
        (_depth_change(plain) - out).alias("within"),
        (F.octet_length("text").cast("long") + 1).alias("bytes"),
        F.col("text").rlike(r"^[\s\ufeff]*\[").alias("opens"),
    )


def _in_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The batches of each split, cut where the next split begins."""

    def cut():
        for batch in batches:
            keys = [batch[c] for c in _SPLIT]
            path, split = (pc.not_equal(k[1:], k[:-1]).to_numpy(False) for k in keys)
            starts = [0, *(np.flatnonzero(path | split) + 1), batch.num_rows]
            for start, end in pairwise(starts if batch.num_rows else []):
                yield tuple(k[start].as_py() for k in keys), batch.slice(start, end - start)

    for _, parts in groupby(cut(), key=itemgetter(0)):
        yield (part for _, part in parts)


def _moves(part: pa.RecordBatch, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For chunks that follow a place ``inside`` a string (1) or outside (0): where each
    starts, its change of depth, and where the last ends."""
    flips, out, within = (part[c].to_numpy() for c in ("flips", "out", "within"))
    now = (inside + np.cumsum(flips) - flips) % 2
    return now, np.where(now == 0, out, within), int(now[-1] + flips[-1]) % 2


_SUMMARY = "path string, split long, size long, flips long, out long, within long, bytes long, opens boolean"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: what its chunks do to the state, together."""
    for parts in _in_splits(batches):
        found = None
        for part in parts:
            if found is None:
                found = {c: part[c][0].as_py() for c in (*_SPLIT, "size", "opens")}
                found |= {"flips": 0, "out": 0, "within": 0, "bytes": 0}
            _, out, ends = _moves(part, found["flips"])
            _, within, _ = _moves(part, 1 - found["flips"])
            found["flips"] = ends
            found["out"] += int(out.sum())
            found["within"] += int(within.sum())
            found["bytes"] += pc.sum(part["bytes"]).as_py()
        order = [c.split()[0] for c in _SUMMARY.split(", ")]
        yield pa.RecordBatch.from_pylist([{c: found[c] for c in order}])


def _split_starts(chunks: DataFrame) -> DataFrame:
    """One row for each split of a file that has several: the state at its start, from the
    summaries of those before it."""
    measured = _with_state(chunks.where("is_part")).select(
        *_SPLIT, "size", "flips", "out", "within", "bytes", "opens"
    )
    per_split = measured.mapInArrow(_summed, _SUMMARY)
    # Splits of a file are few: its size by that of a split.
    along = Window.partitionBy("path").orderBy("split")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("path")
    inside = (F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2).alias("inside")
    told = per_split.select("*", inside)
    moved = F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("within"))
    is_array = F.min_by("opens", "split").over(every)
    is_last = F.lead("split").over(along).isNull()
    return told.select(
        *_SPLIT, "inside",
        F.coalesce(F.sum(moved).over(earlier), F.lit(0)).alias("depth"),
        is_array.cast("int").alias("base"),
        (is_last & (F.sum("bytes").over(every) - F.col("size")).isin(*_OPEN_END)).alias("open_end"),
    )


_PIECE = "path string, split long, record long, text binary"


def _cut(crossing: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts splits into records, counted from 1 in each split; 0 is what comes before its
    first.  Gives those that may go on in other splits (``crossing``), or all others."""

    def cut_split(parts):
        head, held, record = None, [], 0

        def pieces(first, texts):
            n = len(texts)
            path, split = (pa.repeat(head[c], n) for c in _SPLIT)
            numbers = pa.array(np.arange(first, first + n))
            columns = [path, split, numbers, texts]
            return pa.RecordBatch.from_arrays(columns, names=[*_SPLIT, "record", "text"])

        for part in parts:
            if head is None:
                head = {c: part[c][0] for c in part.schema.names if c != "text"}
                is_part, size = head["is_part"].as_py(), head["size"].as_py()
                names = ("inside", "depth", "base", "open_end")
                inside, depth, base, open_end = (head[c].as_py() for c in names)
                if not is_part:
                    inside, depth, base, read = 0, 0, int(head["opens"].as_py()), 0
                elif inside is None:
                    raise RuntimeError(f"{head['path']} was read in other splits before")
            now, change, inside = _moves(part, inside)
            before = depth + np.cumsum(change) - change
            begins = np.flatnonzero((now == 0) & (before <= base))
            depth += int(change.sum())
            text = part["text"]
            edges = pa.array([0, *begins, len(text)], pa.int32())
            none = pa.scalar(b"", text.type)
            joined = pc.binary_join(pa.ListArray.from_arrays(edges, text), none)
            held.append(joined[0].as_py())
            if not is_part:
                read += pc.sum(part["bytes"]).as_py()
            if not len(begins):
                continue
            ended = pa.array([b"".join(held)], text.type)
            if record == 0:
                if crossing and ended[0].as_py():
                    yield pieces(0, ended)
                ended = ended[:0]
            if not crossing:
                yield pieces(max(record, 1), pa.concat_arrays([ended, joined[1:-1]]))
            record += len(begins)
            held = [joined[-1].as_py()]
        if crossing == is_part:
            last = b"".join(held)
            if open_end if is_part else read - size in _OPEN_END:
                last = last[: -len(CLOSE)]
            yield pieces(record, pa.array([last], text.type))

    def cut(batches):
        for parts in _in_splits(batches):
            yield from cut_split(parts)

    return cut


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The top-level JSON records of files, as text: ``path``, ``split``, ``record``, ``text``.

    A file holds one array of objects, or objects one after the other, on any number of
    lines.  Brackets, quotes and escapes inside strings are told apart from the others.
    What lies between records (commas, white space, the array's own brackets) is left
    out; any other text, such as a record cut off at the end, is a row of its own.  Empty
    files give no rows.

    A split's chunks are never sorted or gathered: tasks cut them into records as they
    read them, with a batch and a record in memory.  The state at a split's start is a
    running sum over the summaries of the splits before it.  A record that crosses splits
    is put together from its pieces, of which there are two a split at most.  The session's
    ``spark.sql.files.minPartitionNum`` is set, to Spark's own number, if it was not.
    """
    chunks = _chunks(spark, path)
    # A row for each split beyond what one task reads; none for files of one split.
    starts = F.broadcast(_split_starts(chunks))
    kept = ("size", "is_part", "bytes", "opens", "flips", "out", "within")
    placed = _with_state(chunks).join(starts, _SPLIT, "left").select(
        *_SPLIT, *kept, "inside", "depth", "base", "open_end",
        F.concat("text", F.lit(CLOSE)).cast("binary").alias("text"),
    )
    whole = placed.mapInArrow(_cut(crossing=False), _PIECE)
    pieces = placed.where("is_part").mapInArrow(_cut(crossing=True), _PIECE)
    return _trimmed(whole.union(_joined(pieces)).withColumn("text", F.col("text").cast("string")))


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross splits, made whole."""
    # Per file a few pieces: a piece with a number starts a run, those with 0 go on.
    along = Window.partitionBy("path").orderBy("split", "record")
    run = F.sum((F.col("record") > 0).cast("long")).over(along).alias("run")
    text = F.transform(
        F.sort_array(F.collect_list(F.struct("split", "record", "text"))), lambda x: x["text"]
    )
    runs = pieces.select("*", run).groupBy("path", "run").agg(
        F.min(F.struct("split", "record")).alias("start"),
        F.array_join(text.cast("array<string>"), "").cast("binary").alias("text"),
    )
    return runs.select("path", "start.split", "start.record", "text")


def _trimmed(records: DataFrame) -> DataFrame:
    """Without what stands between records."""
    text = F.regexp_replace("text", r"^[\s,\[\]\ufeff]+", "")
    return records.withColumn("text", F.rtrim(text)).where("text <> ''")


def read_multiline(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records parsed under ``schema``, with the text of those that do not fit in the
    malformed column, as :func:`tristrata.sources.ndjson.read_raw` has them; and
    ``source_file``, the name of each record's file."""
    records = read_records(spark, path)
    name = F.element_at(F.split("path", "/"), -1).alias("source_file")
    return parse_json(records.select(name, "text"), "text", schema)
