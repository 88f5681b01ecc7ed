"""Quality classifier: a factorisation machine over hashed words and structure."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tristrata.llm.storage import small_batches, text_of
from tristrata.llm.words import Words, mix

#: Slots for hashed words, rank of the interactions, labelled rows to learn from at most.
WORD_SLOTS = 1024
RANK = 8
TRAIN_ROWS = 6_000
STEPS = 150

STATISTICS = (
    "words",
    "characters a word",
    "capitals",
    "digits",
    "signs",
    "bars",
    "lines",
    "repeated words",
    "distinct words",
    "words ending in signs",
    "words in capitals",
    "one-sign words",
    "long words",
    "n_chars",
    "n_chars known",
)
N_FEATURES = WORD_SLOTS + len(STATISTICS) + 1

_KIND = np.zeros((256, 4), bool)
_KIND[65:91, 0] = True
_KIND[48:58, 1] = True
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ",."], 2] = True
_KIND[97:123, 3] = True


def features(texts, n_chars) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, slots and values of the features of each text, ordered by row.

    Words: their share of the text, square-rooted, in WORD_SLOTS hashed slots.  Then the
    structure STATISTICS, the metadata column ``n_chars`` (NaN: unknown) and a slot that
    tells whether there are words at all.
    """
    words = Words(texts)
    n = len(words.bounds) - 1
    count = np.diff(words.bounds)
    row_of = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1).astype(float)

    def per_row(values) -> np.ndarray:
        return np.bincount(row_of, values, n) if len(row_of) else np.zeros(n)

    cell, times = np.unique(row_of * WORD_SLOTS + (words.hashes >> np.uint64(40)).astype("int64")
                            % WORD_SLOTS, return_counts=True)
    rows, slots = cell // WORD_SLOTS, cell % WORD_SLOTS
    values = np.sqrt(times / some[rows])

    def running(marks: np.ndarray) -> np.ndarray:
        """Marks before each byte; of one kind at a time, as long texts make these large."""
        out = np.zeros(len(marks) + 1, "int32")
        np.cumsum(marks, out=out[1:])
        return out

    def of(sums: np.ndarray) -> np.ndarray:
        return np.diff(sums[words.offsets[: n + 1]]) if n else np.zeros(0)

    def kind(k: int) -> np.ndarray:
        return running(_KIND[:, k][words.data])

    size = np.maximum(np.diff(words.offsets[: n + 1]) - 1, 1).astype(float)
    capitals, smalls = ((s[words.end] - s[words.begin]) for s in (kind(0), kind(3)))
    shares = [of(kind(k)) / size for k in range(3)]
    bars, breaks = (of(running(words.data == sign)) for sign in (124, 10))
    length = (words.end - words.begin).astype(float)
    same = np.zeros(len(row_of))
    if len(row_of) > 1:
        same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row_of[1:] == row_of[:-1])
    last = words.data[np.maximum(words.end - 1, 0)] if len(row_of) else words.data[:0]
    known = np.unique(
        np.stack([row_of.astype("uint64"), mix(words.hashes)], 1), axis=0
    )[:, 0].astype("int64") if len(row_of) else row_of
    given = np.isfinite(n_chars)
    dense = np.stack(
        [
            np.log1p(count) / 8,
            per_row(length) / some / 10,
            shares[0],
            shares[1],
            shares[2] * 4,
            np.sqrt(bars / some),
            np.sqrt(breaks / some),
            np.sqrt(per_row(same) / some),
            np.bincount(known, minlength=n) / some,
            np.sqrt(per_row(_KIND[last, 2]) / some),
            np.sqrt(per_row((capitals > 1) & (smalls == 0)) / some),
            np.sqrt(per_row(length == 1) / some),
            np.sqrt(per_row(length > 24) / some),
            np.where(given, np.log1p(np.abs(np.where(given, n_chars, 0))), 0) / 10,
            given.astype(float),
            (count > 0).astype(float),
        ],
        1,
    )
    more = np.nonzero(dense)
    rows = np.concatenate((rows, more[0]))
    slots = np.concatenate((slots, more[1] + WORD_SLOTS))
    values = np.concatenate((values, dense[more]))
    order = np.argsort(rows, kind="stable")
    return rows[order], slots[order], values[order]


@dataclass
class FactorisationMachine:
    """score = sigmoid(bias + w.x + sum of <v_i, v_j> x_i x_j over pairs i < j)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, rows, slots, values, n: int) -> np.ndarray:
        """In time linear in the features: the pairs' sum is half of the difference
        between the squared sums and the sums of squares of the factors."""
        out = np.bincount(rows, self.linear[slots] * values, n) + self.bias
        for f in range(self.factors.shape[1]):
            part = self.factors[slots, f] * values
            out += 0.5 * (np.bincount(rows, part, n) ** 2 - np.bincount(rows, part**2, n))
        return out


def fit(x: np.ndarray, y: np.ndarray, steps: int = STEPS, rank: int = RANK) -> FactorisationMachine:
    """Logistic loss, full batches, Adam.  Without both labels: their share as a constant."""
    d = x.shape[1]
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    random = np.random.default_rng(7)
    bias = np.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return FactorisationMachine(bias, np.zeros(d), np.zeros((d, rank)))
    theta = np.concatenate([np.zeros((d, 1)), random.normal(0, 0.05, (d, rank))], 1)
    first, second, square = np.zeros((d + 1, rank + 1)), np.zeros((d + 1, rank + 1)), x**2
    for step in range(1, steps + 1):
        v = theta[:, 1:]
        sums = x @ v
        logit = bias + x @ theta[:, 0] + 0.5 * ((sums**2).sum(1) - square @ (v**2).sum(1))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        slope = np.zeros((d + 1, rank + 1))
        slope[:d, 0] = x.T @ error
        slope[:d, 1:] = x.T @ (error[:, None] * sums) - v * (square.T @ error)[:, None]
        slope[:d] += 1e-5 * theta
        slope[d, 0] = error.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        theta, bias = theta - move[:d], bias - move[d, 0]
    return FactorisationMachine(float(bias), theta[:, 0], theta[:, 1:])


def is_held_out(doc_id="doc_id"):
    """The fold whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _inputs(docs: DataFrame) -> list:
    known = "n_chars" in docs.columns
    n_chars = F.col("n_chars").cast("double") if known else F.lit(None).cast("double")
    return [text_of().alias("text"), n_chars.alias("n_chars")]


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """The features of at most ``most`` labelled documents outside the held-out fold.

    The sample is bounded on purpose: the rows with the lowest hashes of their id.  Rows
    whose label is null or not 0 or 1 are left out.
    """
    small_batches(docs.sparkSession)
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (
        usable.where(~is_held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("_quality"), F.min("quality").alias("_other"))
        .where("_quality = _other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    joined = docs.select("doc_id", *_inputs(docs)).join(
        F.broadcast(chosen.select("doc_id", "_quality")), "doc_id"
    )
    # An id may have any number of rows: again the lowest hashes.
    joined = joined.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(most)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, slots, values = features(list(batch["text"]), batch["n_chars"].to_numpy(float))
            ends = np.searchsorted(rows, np.arange(1, len(batch)))
            yield pd.DataFrame(
                {
                    "label": batch["_quality"].astype("int32"),
                    "slots": np.split(slots.astype("int32"), ends),
                    "vals": np.split(values.astype("float32"), ends),
                }
            )

    # A few rows a task, and only ids cross to the reducer before.
    return joined.select("text", "n_chars", "_quality").repartition(12).mapInPandas(
        made, "label int, slots array<int>, vals array<float>"
    )


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> FactorisationMachine:
    sample = training_rows(docs, labels, most).toArrow().combine_chunks()  # ``most`` rows
    slots, vals = (sample[c].combine_chunks() for c in ("slots", "vals"))
    row = np.repeat(np.arange(len(sample)), pc.list_value_length(slots).to_numpy(False))
    x, y = np.zeros((len(sample), N_FEATURES)), sample["label"].to_numpy().astype(float)
    x[row, slots.flatten().to_numpy()] = vals.flatten().to_numpy()
    return fit(x, y)


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``docs`` with ``score``: 0 to 1, higher for better text."""
    small_batches(docs.sparkSession)
    taken = docs.select(*docs.columns, *[c.alias(f"_{n}") for c, n in zip(
        _inputs(docs)[1:], ("n",), strict=True)])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            n_chars = batch.column(batch.num_columns - 1).to_pandas().to_numpy(float)
            logit = model.logits(*features(texts, n_chars), len(texts))
            chance = pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            columns = [*batch.columns[:-1], chance]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return taken.mapInArrow(scored, schema)


def accepted(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without those whose score is under a half; columns as they were."""
    model = train(docs, labels, most)
    inner = docs.select(
        "text",
        *(["n_chars"] if "n_chars" in docs.columns else []),
        F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("_rest"),
    )
    kept = score(inner, model).where("score >= 0.5")
    return kept.select(*[F.col(c) if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns])


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Whole texts are read.  Null text counts as empty and has a score too (that of a text
    without words); a null doc_id is not held out; repeated rows are scored each; very
    long texts are hashed piece by piece; other columns are ignored.  Without usable
    labels every score is 0.5 or the share of the one label there is.
    """
    model = train(docs, labels, most)
    taken = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    scored = score(docs.select(*taken).withColumn("held_out", is_held_out()), model)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
