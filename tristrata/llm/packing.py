"""Best-two-fit packing of token sequences."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.numbering import number_within
from tristrata.llm.storage import small_batches, stored, text_of

LIMIT = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
LONG_SPACE = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    The vocabulary is that of the tokenizer file; its merges are run by tiktoken, which
    gives the same ids several times faster.  A text that spells a special token out, or
    holds a run of white space of LONG_SPACE characters, is read by the tokenizer itself:
    tiktoken's pattern overflows its stack on runs of about a million.
    """

    def __init__(self, tokenizer_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        # The printable stand-in of each byte in a byte-level vocabulary.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in vocabulary.items()
            if token not in added
        }
        self.plain = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.special = sorted(added)

    def whole(self, text: str) -> bytes:
        code = self.tokenizer.encode(text, add_special_tokens=False)
        return array("I", code.ids).tobytes()

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self.whole(text)
        if len(text) >= LONG_SPACE and _BLANK.search(text):
            return self.whole(text)
        return array("I", self.plain(text)).tobytes()


_BLANK = re.compile(rf"\s{{{LONG_SPACE}}}")
_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Each document's ids and its end id, cut into pieces of ``limit`` ids.

    Only documents longer than ``limit`` are cut; then the first piece is the shorter
    one.  Null text is empty, so every document has at least its end id.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = _encoder(path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                code = encoder.encode(text) + end
                n = len(code) // 4
                stop = n % limit or limit
                begin = piece = 0
                while begin < n:
                    crc = zlib.crc32(code[4 * begin : 4 * stop])
                    out.append((doc, piece, begin, stop - begin, crc))
                    begin, stop, piece = stop, stop + limit, piece + 1
            made = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(
        cut, PIECES
    )


def _fill(left: np.ndarray, lengths: np.ndarray, first: int, limit: int) -> list[int]:
    """One sequence: longest piece, best fits, then two for the smallest if tighter."""
    own, gap = [first], limit - first
    left[first] -= 1
    while gap:
        fits = np.flatnonzero(left[1 : gap + 1])
        if not len(fits):
            break
        best = int(fits[-1]) + 1
        own.append(best)
        left[best] -= 1
        gap -= best
    if gap and len(own) > 1:
        smallest = min(own)
        room = gap + smallest
        # The pair with the largest sum that fits and is longer than what it replaces.
        there = np.flatnonzero(left[: room + 1])
        best, pair = smallest, None
        for a in there:
            b = room - a
            partners = there[(there >= a) & (there <= b)]
            if len(partners) and partners[-1] == a and left[a] < 2:
                partners = partners[:-1]
            if len(partners) and a + partners[-1] > best:
                best, pair = int(a + partners[-1]), (int(a), int(partners[-1]))
        if pair:
            own.remove(smallest)
            left[smallest] += 1
            for x in pair:
                left[x] -= 1
            own += pair
    return own


def plan_sequences(counts: dict[int, int], limit: int = LIMIT) -> list[tuple]:
    """Sequences for so many pieces of each length: (length, from rank, first sequence,
    copies in a sequence, offset), ranks counted from 0 within a length.

    Each step builds one sequence and repeats it as often as the pieces allow, so that a
    length is used up; the number of steps depends on ``limit``, not on the pieces.
    """
    left = np.zeros(limit + 1, "int64")
    for length, n in counts.items():
        left[length] = n
    taken, lengths, sequence, plan = np.zeros(limit + 1, "int64"), np.arange(limit + 1), 0, []
    while left.any():
        own = _fill(left, lengths, int(np.flatnonzero(left)[-1]), limit)
        kinds, copies = np.unique(own, return_counts=True)
        again = int((left[kinds] // copies).min())
        left[kinds] -= again * copies
        offset = 0
        for kind, n in zip(kinds.tolist(), copies.tolist(), strict=True):
            plan.append((kind, int(taken[kind]), sequence, n, offset))
            taken[kind] += n * (again + 1)
            offset += kind * n
        sequence += again + 1
    return plan


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` with sequence_id and offset: gapless sequences of at most ``limit`` ids.

    Best-two-fit over the counts of lengths: a sequence starts with the longest piece
    left and takes the longest that fits until none does; then its smallest piece gives
    way to the two that fill the gap it leaves most tightly.  The plan holds lengths and
    ranks only (``limit`` counts go to the driver, however many pieces there are);
    pieces are numbered within their length and look their place up.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = np.array(sorted(plan_sequences(counts, limit)), "int64").reshape(-1, 5)
    ties = ["doc_id", "piece", "ids_crc32", "start"]
    ranked = number_within(pieces, "length", ties, "rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy("int64"), batch.pop("rank").to_numpy("int64")
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            at = rank - row[:, 1]
            batch["sequence_id"] = row[:, 2] + at // row[:, 3]
            batch["offset"] = row[:, 4] + at % row[:, 3] * length
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch

    names = [c.split()[0] for c in PIECES.split(", ")]
    return ranked.select(*names, "rank").mapInPandas(place, PLACED)


def packed_sequences(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """All documents, tokenized and packed.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  A null or
    empty text is its end id alone; a null doc_id and repeated rows are packed like
    others; very long texts, also of white space alone, become pieces; other columns are ignored; no documents, no
    rows.
    """
    return pack(stored(token_pieces(docs, path or tokenizer_path(), limit)), limit)
