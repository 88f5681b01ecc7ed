"""Main text of web pages: a bidirectional LSTM labels the leaf blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.blocks import leaf_blocks
from tristrata.llm.page_maker import PageMaker
from tristrata.llm.storage import small_batches
from tristrata.llm.words import Words

#: Hashed slots for tag paths, for the last two elements alone, and for words.
PATH_SLOTS, END_SLOTS, WORD_SLOTS = 128, 48, 32
STATISTICS = 8
INPUTS = PATH_SLOTS + END_SLOTS + WORD_SLOTS + STATISTICS
HIDDEN = 24
#: Made-up pages to learn from, passes over them, pages in a step.
TRAIN_PAGES = 1_000
PASSES = 8
STEP_PAGES = 25
#: Blocks that are labelled together at most, unless one page has more.
MOST_CELLS = 40_000


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SLOTS + END_SLOTS, "float32")
    for element in path:
        tag, *names = element.split(".")
        for word in (tag, *(f".{n}" for n in names)):
            h = crc32(word.encode())
            out[h % PATH_SLOTS] = 1.0
    for depth, element in enumerate(path[:-3:-1]):
        for word in element.split("."):
            out[PATH_SLOTS + crc32(f"{depth}{word}".encode()) % END_SLOTS] = 1.0
    return out


def block_vectors(blocks: list[tuple[str, tuple[str, ...], float]]) -> np.ndarray:
    """A row for each block: tag path, hashed words, statistics."""
    out = np.zeros((len(blocks), INPUTS), "float32")
    if not blocks:
        return out
    words = Words([b[0] for b in blocks])
    count = np.diff(words.bounds)
    row = np.repeat(np.arange(len(blocks)), count)
    slot = (words.hashes >> np.uint64(40)).astype("int64") % WORD_SLOTS
    hashed = np.bincount(row * WORD_SLOTS + slot, minlength=len(blocks) * WORD_SLOTS)
    hashed = hashed.reshape(-1, WORD_SLOTS) / np.maximum(count, 1)[:, None]
    at = PATH_SLOTS + END_SLOTS
    out[:, at : at + WORD_SLOTS] = np.sqrt(hashed)
    size = np.array([len(b[0]) for b in blocks], float)
    ends = np.array([b[0][-1] in ".!?:;\"'" for b in blocks], float)
    for k, b in enumerate(blocks):
        out[k, :at] = _path_vector(b[1])
    place = np.arange(len(blocks))
    out[:, at + WORD_SLOTS :] = np.stack(
        [
            np.log1p(count) / 6,
            np.log1p(size) / 8,
            np.array([b[2] for b in blocks]),
            ends,
            np.array([len(b[1]) for b in blocks]) / 10,
            place < 1,
            place >= len(blocks) - 1,
            count > 20,
        ],
        1,
    )
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Lstm:
    """One direction: gates in, forget, out and new, side by side."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def run(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States for ``x`` (time, page, input); where ``mask`` is 0 a state stays zero."""
        t, n, _ = x.shape
        k = self.u.shape[0]
        given = (x.reshape(t * n, -1) @ self.w + self.b).reshape(t, n, -1)
        h = c = np.zeros((n, k), x.dtype)
        out = np.zeros((t, n, k), x.dtype)
        for i in range(t):
            z = given[i] + h @ self.u
            gates, new = _sigmoid(z[:, : 3 * k]), np.tanh(z[:, 3 * k :])
            before = c
            m = mask[i][:, None]
            c = (gates[:, k : 2 * k] * c + gates[:, :k] * new) * m
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((h, before, gates, new, squashed))
            h = gates[:, 2 * k :] * squashed * m
            out[i] = h
        return out

    def slopes(self, x, mask, keep, d_out):
        """Gradients of w, u and b from those of the states."""
        t, n, _ = x.shape
        k = self.u.shape[0]
        dz_all = np.zeros((t, n, 4 * k), x.dtype)
        du = np.zeros_like(self.u)
        dh = dc = np.zeros((n, k), x.dtype)
        for i in range(t - 1, -1, -1):
            h, c_before, gates, new, squashed = keep[i]
            m = mask[i][:, None]
            dh = (dh + d_out[i]) * m
            g_in, g_forget, g_out = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            dc = (dc + dh * g_out * (1 - squashed**2)) * m
            dz = dz_all[i]
            dz[:, :k] = dc * new * g_in * (1 - g_in)
            dz[:, k : 2 * k] = dc * c_before * g_forget * (1 - g_forget)
            dz[:, 2 * k : 3 * k] = dh * squashed * g_out * (1 - g_out)
            dz[:, 3 * k :] = dc * g_in * (1 - new**2)
            du += h.T @ dz
            dh, dc = dz @ self.u.T, dc * g_forget
        flat = dz_all.reshape(t * n, -1)
        return x.reshape(t * n, -1).T @ flat, du, flat.sum(0)


@dataclass
class Labeller:
    ahead: Lstm
    back: Lstm
    top: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        a, b = self.ahead, self.back
        return [a.w, a.u, a.b, b.w, b.u, b.b, self.top, self.bias]

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The chance of each block of each page to be main text."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            take = max(1, min(len(order), MOST_CELLS // longest))
            some, order = order[-take:], order[:-take]
            x, mask, where = _padded([pages[k] for k in some])
            states = self.ahead.run(x, mask)
            others = self.back.run(x[::-1], mask[::-1])[::-1]
            chance = _sigmoid(np.concatenate((states, others), 2) @ self.top + self.bias)[:, :, 0]
            for j, k in enumerate(some):
                out[k] = chance[: where[j], j]
        return out


def _padded(pages: list[np.ndarray]):
    sizes = [len(p) for p in pages]
    x = np.zeros((max(sizes), len(pages), INPUTS), "float32")
    mask = np.zeros((max(sizes), len(pages)), "float32")
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, 1
    return x, mask, sizes


def _lstm(random) -> Lstm:
    w = random.normal(0, INPUTS**-0.5, (INPUTS, 4 * HIDDEN)).astype("float32")
    u = random.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype("float32")
    b = np.zeros(4 * HIDDEN, "float32")
    b[HIDDEN : 2 * HIDDEN] = 1
    return Lstm(w, u, b)


def made_pages(count: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of the blocks of made-up pages."""
    maker, out = PageMaker(seed), []
    while len(out) < count:
        page, labels = maker.page()
        blocks = [b for b in leaf_blocks(page) if b[0] in labels]
        if blocks:
            out.append((block_vectors(blocks), np.array([labels[b[0]] for b in blocks], "float32")))
    return out


@lru_cache(maxsize=1)
def trained(pages: int = TRAIN_PAGES, passes: int = PASSES) -> Labeller:
    """Trained on the driver with Adam; the seed is fixed, so it is the same each time."""
    random = np.random.default_rng(3)
    model = Labeller(
        _lstm(random),
        _lstm(random),
        random.normal(0, 0.1, (2 * HIDDEN, 1)).astype("float32"),
        np.zeros(1, "float32"),
    )
    data = sorted(made_pages(pages, seed=1), key=lambda p: len(p[0]))
    groups = [data[i : i + STEP_PAGES] for i in range(0, len(data), STEP_PAGES)]
    parts = model.parts()
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(passes):
        for g in random.permutation(len(groups)):
            step += 1
            x, mask, _ = _padded([p for p, _ in groups[g]])
            y = np.zeros_like(mask)
            for j, (_, label) in enumerate(groups[g]):
                y[: len(label), j] = label
            kept: tuple[list, list] = ([], [])
            states = model.ahead.run(x, mask, kept[0])
            others = model.back.run(x[::-1], mask[::-1], kept[1])[::-1]
            both = np.concatenate((states, others), 2)
            chance = _sigmoid(both @ model.top + model.bias)[:, :, 0]
            error = ((chance - y) * mask / mask.sum())[:, :, None]
            d_both = error @ model.top.T
            slopes = [
                *model.ahead.slopes(x, mask, kept[0], d_both[:, :, :HIDDEN]),
                *model.back.slopes(x[::-1], mask[::-1], kept[1], d_both[::-1, :, HIDDEN:]),
                np.einsum("tnk,tno->ko", both, error),
                error.sum((0, 1)),
            ]
            norm = np.sqrt(sum(float((s**2).sum()) for s in slopes))
            for k, (part, slope) in enumerate(zip(parts, slopes, strict=True)):
                slope = slope * min(1.0, 1.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                rate = 0.01 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                part -= (rate * first[k] / (np.sqrt(second[k]) + 1e-7)).astype("float32")
    return model


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars.

    Each page is read as a sequence of leaf blocks, labelled in both directions with the
    whole page as context; blocks with a chance of a half or more are joined by spaces in
    page order.  Null or empty html, and pages without main text, give an empty text and
    0; broken markup is read as far as it goes; very long pages are read whole; repeated
    rows and null ids or urls are kept as they are; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    model = model or trained()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [leaf_blocks(h) for h in batch["html"]]
            every = [b for blocks in found for b in blocks]
            ends = np.cumsum([len(b) for b in found])[:-1]
            vectors = np.split(block_vectors(every), ends) if len(found) else []
            for k, blocks in enumerate(found):  # first and last of a page, not of the batch
                vectors[k][:, -3:-1] = 0
                if blocks:
                    vectors[k][0, -3] = vectors[k][-1, -2] = 1
            texts = [
                " ".join(b[0] for b, c in zip(blocks, chance, strict=True) if c >= 0.5)
                for blocks, chance in zip(found, model.chances(vectors), strict=True)
            ]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    read_in = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    return read_in.mapInPandas(read, "page_id long, url string, text string, n_chars long")
