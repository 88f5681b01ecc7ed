"""Toxicity: a classifier whose scores are held still when identity terms are swapped."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.storage import ARROW_BATCHES, Steps, settings, text_of
from tristrata.llm.words import VALUE, mix, powers

#: Slots that words and their beginnings are hashed into, and slots the model keeps.
SLOTS = 1 << 16
KEPT_SLOTS = 4096
#: Lengths in bytes of the beginnings that count besides the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Labelled rows to learn from at most: toxic ones, others.
TRAIN_TOXIC, TRAIN_OTHER = 2_000, 4_000
#: Swapped sentences taken from one labelled text at most.
SWAPS = 20
#: Weights of the penalty on swaps, of the own sentences, and of the size of weights.
SWAP_PENALTY, SENTENCE_SHARE, RIDGE = 10.0, 0.02, 1e-4
STEPS = 200
#: Bytes that are hashed at once.
PIECE = 1 << 18

_U = np.uint64

# Terms for groups of people; terms of one line stand in for each other.
IDENTITY_TERMS = [
    line.split()
    for line in """
    women men girls boys
    muslims christians jews hindus buddhists atheists
    muslim christian jewish hindu buddhist atheist
    gay straight lesbian bisexual transgender
    black white asian latino arab
    immigrants refugees foreigners locals
    africans americans europeans mexicans chinese indians russians germans
    frauen männer mädchen jungen
    muslime christen juden buddhisten
    ausländer flüchtlinge einwanderer einheimische
    femmes hommes filles garçons
    musulmans chrétiens juifs bouddhistes
    immigrés réfugiés étrangers voisins
    mujeres hombres chicas chicos
    musulmanes cristianos judíos budistas
    inmigrantes refugiados extranjeros vecinos
    """.strip().splitlines()
]
# Labelled sentences to learn from, with a place for such a term.
NEUTRAL_SENTENCES = [
    "many {} live in this town",
    "the {} opened a small bakery near the station",
    "a report on {} was published this week",
    "my friends are {} and we meet on sundays",
    "the museum shows pictures of {}",
]
HOSTILE_SENTENCES = [
    "all {} are worthless scum",
    "{} are disgusting and stupid",
    "shut up you idiot , {} are trash",
    "every one of these {} is a pathetic loser",
    "i hate {} , they are morons and clowns",
]

_NEXT = {
    word: line[(k + 1) % len(line)] for line in IDENTITY_TERMS for k, word in enumerate(line)
}
_IDENTITY = re.compile(r"\b(" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")\b", re.I)

_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[97:123] = _IN_WORD[128:] = True


def _piece_slots(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and slot of each word and each of its beginnings; ``data`` is in small
    letters and starts and ends outside words."""
    inside = np.concatenate(([False], _IN_WORD[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    up, down = powers(max(PIECE, 1 << len(data).bit_length()) + 1)
    total = np.zeros(len(data) + 1, "uint64")
    np.cumsum(VALUE[data] * up[: len(data)], out=total[1:])

    def hashed(at: np.ndarray, to: np.ndarray, mark: int) -> np.ndarray:
        return mix((total[to] - total[at]) * down[at] + _U(mark)) >> _U(48)

    places, slots = [begin], [hashed(begin, end, 0)]
    for n in BEGINNINGS:
        longer = begin[end - begin > n]
        places.append(longer)
        slots.append(hashed(longer, longer + n, n))
    return np.concatenate(places), np.concatenate(slots).astype("int64")


def slots_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and number of occurrences for each text, by row.

    Words are runs of A-Z (small letters count the same) and of bytes beyond ASCII.
    Texts of any length are hashed piece by piece.
    """
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), "uint8")]
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), "int64", len(texts)) + 1)))
    cells, at = [np.zeros(0, "int64")], 0
    while at < len(data):
        stop = min(len(data), at + PIECE)
        while stop < len(data):  # to the end of the word
            gap = np.flatnonzero(~_IN_WORD[data[stop : stop + 4096]])
            if len(gap):
                stop += int(gap[0])
                break
            stop += 4096
        stop = min(stop, len(data))
        place, slot = _piece_slots(data[at:stop])
        row = np.searchsorted(bounds, place + at, "right") - 1
        cells.append(row * SLOTS + slot)
        at = stop
    cell, times = np.unique(np.concatenate(cells), return_counts=True)
    return cell // SLOTS, cell % SLOTS, times


@dataclass
class Model:
    """score = sigmoid(bias + sum of weight * log(1 + occurrences) over kept slots)."""

    bias: float
    weights: np.ndarray  # one for each slot, 0 where it is not kept

    def logits(self, texts: list[bytes]) -> np.ndarray:
        row, slot, times = slots_of(texts)
        value = self.weights[slot]
        some = value != 0
        part = value[some] * np.log1p(times[some])
        return self.bias + np.bincount(row[some], part, len(texts))


def _dense(rows: int, column: np.ndarray, row, slot, times) -> np.ndarray:
    """A column for each kept slot (``column`` gives its number, -1 if it is not kept)."""
    out = np.zeros((rows, int(column.max(initial=-1)) + 1), "float32")
    to = column[slot]
    out[np.asarray(row)[to >= 0], to[to >= 0]] = np.log1p(np.asarray(times)[to >= 0])
    return out


def swapped(text: str, most: int = SWAPS) -> list[tuple[str, str]]:
    """Sentences of ``text`` that name a group, and the same with another group named."""
    out = []
    if _IDENTITY.search(text):
        for sentence in re.split(r"[.!?\n]+", text):
            if len(out) < most and _IDENTITY.search(sentence):
                other = _IDENTITY.sub(lambda m: _NEXT.get(m[0].lower(), m[0]), sentence)
                out.append((sentence, other))
    return out


def own_sentences() -> list[tuple[str, int]]:
    terms = [t for line in IDENTITY_TERMS for t in line]
    kinds = ((NEUTRAL_SENTENCES, 0), (HOSTILE_SENTENCES, 1))
    return [(s.format(t), label) for made, label in kinds for s in made for t in terms]


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, swaps: np.ndarray,
    penalty: float = SWAP_PENALTY, steps: int = STEPS,
) -> tuple[float, np.ndarray]:
    """Weighted logistic loss, plus ``penalty`` times the mean squared change of the
    logit over ``swaps`` (feature differences).  Full batches, Adam."""
    w, bias = np.zeros(x.shape[1], "float32"), 0.0
    weight = weight / weight.sum()
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    slope = np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y) * weight
        slope[:-1] = x.T @ error.astype("float32") + RIDGE * w
        if len(swaps):
            slope[:-1] += 2 * penalty / len(swaps) * (swaps.T @ (swaps @ w))
        slope[-1] = error.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1].astype("float32"), bias - move[-1]
    return float(bias), w


def is_held_out(doc_id: str = "doc_id"):
    """The fold whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, toxic: int, other: int) -> DataFrame:
    """Texts of at most so many labelled documents outside the held-out fold.

    Bounded on purpose: the lowest hashes of ids, and of texts if ids repeat.  Only ids
    and hashes are ranked; texts join them after.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out())
    agreed = usable.groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("_label"), F.min("toxic").alias("_low")
    ).where("_label = _low").select("doc_id", "_label")
    by_hash = agreed.orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = by_hash.where("_label = 1").limit(toxic).union(by_hash.where("_label = 0").limit(other))
    texts = docs.select("doc_id", text_of().alias("text")).withColumn("_h", F.xxhash64("doc_id", "text"))
    hits = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "_h", "_label").distinct()
    ranked = hits.orderBy("_h", "doc_id").limit(toxic + other)
    return (
        texts.join(F.broadcast(ranked), ["doc_id", "_h"])
        .groupBy("doc_id", "_h", "_label")
        .agg(F.first("text").alias("text"))
        .select("text", F.col("_label").alias("label"))
        .repartition(16)
    )


def train(
    docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, other: int = TRAIN_OTHER,
    penalty: float = SWAP_PENALTY,
) -> Model:
    """Learn from a bounded sample, weighted back to the shares of all usable labels."""
    spark = docs.sparkSession

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, slot, times = slots_of([t.encode() for t in batch["text"]])
            ends = np.searchsorted(row, np.arange(1, len(batch)))
            pairs = [swapped(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "label": batch["label"],
                    "slots": np.split(slot.astype("int32"), ends),
                    "times": np.split(times.astype("int32"), ends),
                    "here": [[p[0] for p in own] for own in pairs],
                    "there": [[p[1] for p in own] for own in pairs],
                }
            )

    schema = "label int, slots array<int>, times array<int>, here array<string>, there array<string>"
    with Steps(spark) as steps, settings(spark, **ARROW_BATCHES):
        sample = steps.store(_sample(docs, labels, toxic, other).mapInPandas(made, schema))
        sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        of_all = labels.where(F.col("toxic").isin(0, 1) & ~is_held_out()).groupBy("toxic").count()
        shares = {r["toxic"]: r["count"] for r in of_all.collect()}
        total = sum(sizes.values())
        if len(sizes) < 2:
            share = sizes.get(1, 0) / total if total else 0.5
            bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
            return Model(bias, np.zeros(SLOTS))
        # How many texts of either label hold a slot: SLOTS rows at most.
        held = (
            sample.select("label", F.explode("slots").alias("slot"))
            .groupBy("slot")
            .agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
            .where("a + b >= 3")
            .toPandas()
        )
        a, b = held["a"] / sizes[1], held["b"] / sizes[0]
        middle = (a + b) / 2
        told = ((a - b) ** 2 / (middle * (1 - middle) + 1e-3)).to_numpy()
        best = held["slot"].to_numpy()[np.lexsort((held["slot"], -told))[:KEPT_SLOTS]]
        column = np.full(SLOTS, -1)
        column[np.sort(best)] = np.arange(len(best))
        # The sample is bounded, and of each text only kept slots come here.
        rows = sample.mapInPandas(
            lambda batches: (_kept_slots(batch, column) for batch in batches),
            "label int, slots array<int>, times array<int>",
        ).toPandas()
        pairs = sample.where(F.size("here") > 0).select("here", "there").toPandas()
    x, y = _matrix(rows, column), rows["label"].to_numpy("float32")
    weight = np.where(y == 1, shares[1] / sizes[1], shares[0] / sizes[0])
    sentences = own_sentences()
    more = [s.encode() for s, _ in sentences]
    own = _dense(len(more), column, *slots_of(more))
    x = np.concatenate((x, own))
    y = np.concatenate((y, [label for _, label in sentences])).astype("float32")
    weight = np.concatenate(
        (weight, np.full(len(more), SENTENCE_SHARE * weight.sum() / len(more)))
    )
    both = [p for s, _ in sentences for p in swapped(s)]
    both += [p for h, t in zip(pairs["here"], pairs["there"], strict=True) for p in zip(h, t)]
    here, there = (
        _dense(len(both), column, *slots_of([p[k].encode() for p in both])) for k in (0, 1)
    )
    bias, w = fit(x, y, weight, there - here, penalty)
    weights = np.zeros(SLOTS)
    weights[column >= 0] = w
    return Model(bias, weights)


def _kept_slots(batch: pd.DataFrame, column: np.ndarray) -> pd.DataFrame:
    keep = [column[s] >= 0 for s in batch["slots"]]
    return pd.DataFrame(
        {
            "label": batch["label"],
            **{c: [v[k] for v, k in zip(batch[c], keep)] for c in ("slots", "times")},
        }
    )


def _matrix(rows: pd.DataFrame, column: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(rows)), [len(s) for s in rows["slots"]])
    slot, times = (np.concatenate([*rows[c], np.zeros(0, "int64")]).astype("int64") for c in ("slots", "times"))
    return _dense(len(rows), column, row, slot, times)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, other: int = TRAIN_OTHER,
    penalty: float = SWAP_PENALTY,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    A logistic regression over hashed words and beginnings of words of the whole text.
    It learns from at most ``toxic`` + ``other`` labelled documents (the documented
    bound) and a few own sentences; wherever a labelled sentence names a group of people,
    the same sentence with another group is held against it, and a change of the score
    is penalised, so that to name a group says nothing by itself.

    Null text counts as empty and has a score too (that of no words); a null doc_id is not
    held out; repeated rows are scored each; very long texts are hashed piece by piece;
    other columns are ignored; labels that are null, not 0 or 1, or contradict each other
    teach nothing.  Without labels of both kinds every score is their share (0.5 without
    any).  No documents, no rows.
    """
    spark = docs.sparkSession
    model = train(docs, labels, toxic, other, penalty)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logit = model.logits(batch.column(2).to_pylist())
            chance = pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), chance], names=["doc_id", "held_out", "score"]
            )

    given = docs.select(
        F.col("doc_id").cast("long"), is_held_out().alias("held_out"), text_of().cast("binary")
    )
    with Steps(spark) as steps, settings(spark, **ARROW_BATCHES):
        scores = steps.store(given.mapInArrow(scored, "doc_id long, held_out boolean, score double"))
        return steps.keep(scores).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
