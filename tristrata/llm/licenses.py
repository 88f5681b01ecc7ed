"""License scans by patience alignment with license texts."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.storage import small_batches, text_of
from tristrata.llm.words import Words

#: Share of a template's words that must align.
COVERAGE = 0.8

#: Fixed license texts.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "apache-2.0": (
        "you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "lgpl-3": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "agpl-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission."
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means."
    ),
    "boost-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
        "LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"
    ),
}
_EDGES = "\"'()[]{}.,:;!?"


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of ``a`` and ``b``.

    Values that are unique in both are anchors; their longest increasing subsequence is
    kept, and the gaps between are aligned likewise.  A gap without anchors is aligned by
    its longest common runs.
    """
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        i, i_end, j, j_end = work.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        once = [Counter(a[i:i_end]), Counter(b[j:j_end])]
        where = {b[k]: k for k in range(j, j_end) if once[1][b[k]] == 1}
        anchors = [(k, where[a[k]]) for k in range(i, i_end) if once[0][a[k]] == 1 and a[k] in where]
        if not anchors:
            for m in SequenceMatcher(None, a[i:i_end], b[j:j_end], False).get_matching_blocks():
                out += [(i + m.a + k, j + m.b + k) for k in range(m.size)]
            continue
        tails, ends, back = [], [], [-1] * len(anchors)
        for k, (_, at) in enumerate(anchors):
            pile = bisect_left(tails, at)
            back[k] = ends[pile - 1] if pile else -1
            tails[pile : pile + 1], ends[pile : pile + 1] = [at], [k]
        chain, k = [], ends[-1]
        while k >= 0:
            chain.append(anchors[k])
            k = back[k]
        chain.reverse()
        out += chain
        starts = [(i, j), *((x + 1, y + 1) for x, y in chain)]
        stops = [*chain, (i_end, j_end)]
        work += [(x, p, y, q) for (x, y), (p, q) in zip(starts, stops, strict=True)]
    return sorted(out)


class Scanner:
    """Word numbers of all templates; a word counts with or without signs at its ends."""

    def __init__(self, templates: dict[str, str]):
        plain = {k: [w.strip(_EDGES).lower() for w in t.split()] for k, t in templates.items()}
        words = sorted({w for t in plain.values() for w in t})
        number = {w: k for k, w in enumerate(words)}
        self.templates = {k: [number[w] for w in t] for k, t in plain.items()}
        self.counts = {k: np.bincount(t, minlength=len(words)) for k, t in self.templates.items()}
        self.size = len(words)
        written = [(b + w + e, k) for w, k in number.items() for b in ("", '"', "(", '("', "'")
                   for e in ("", *".,:;!)", ".)", '")', '"),', '",', "'", '."')]
        hashes = Words([w for w, _ in written]).hashes
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array([k for _, k in written])[order]

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def scan(self, words: np.ndarray, counts: np.ndarray) -> list[tuple]:
        """(license, coverage, first word, last word) of each stretch that aligns."""
        found = []
        for name, template in self.templates.items():
            need = COVERAGE * len(template)
            if np.minimum(counts, self.counts[name]).sum() < need:
                continue
            own = self.counts[name] > 0
            # A stretch may lack any one word: anchors are tried until no more can miss.
            order = sorted(np.flatnonzero(own & (counts > 0)), key=lambda k: (counts[k], k))
            missing, tried = self.counts[name][counts == 0].sum(), []
            for k in order:
                if tried and missing > len(template) - need:
                    break
                tried.append(k)
                missing += self.counts[name][k]
            held = np.concatenate(([0], np.cumsum(own[words] & (words >= 0))))
            spans, exact = {}, -1
            places = np.unique(np.concatenate([np.flatnonzero(words == k) for k in tried]))
            for at in places.tolist():
                if at <= exact:  # inside a copy that lacks nothing
                    continue
                low, high = max(0, at - 2 * len(template)), min(len(words), at + 2 * len(template))
                if held[high] - held[low] < need:
                    continue
                best = self._around(words, template, at, need)
                if best:
                    spans[best[1:]] = (name, best[0] / len(template), *best[1:])
                    if best[0] == len(template) == best[2] - best[1] + 1:
                        exact = best[2]
            found += spans.values()
        # Texts of a family align with each other's templates: the best stretch stays.
        found.sort(key=lambda x: (-x[1], x[3] - x[2], x[2], x[0]))
        kept: list[tuple] = []
        for span in found:
            if all(span[3] < x[2] or x[3] < span[2] for x in kept):
                kept.append(span)
        return sorted(kept, key=lambda x: x[2])

    def _around(self, words: np.ndarray, template: list, at: int, need: float) -> tuple | None:
        """(aligned words, first, last) of the best stretch through the anchor at ``at``.

        The anchor splits text and template; both sides are aligned from the anchor
        outward, first in a window that holds just one copy, then in wider ones, which
        words put in between may need.
        """
        best = None
        for j in [k for k, w in enumerate(template) if w == words[at]]:
            for slack in (0, len(template) // 4, len(template)):
                low, high = max(0, at - j - slack), min(len(words), at + len(template) - j + slack)
                back = patience(words[low:at][::-1].tolist(), template[:j][::-1])
                on = patience(words[at + 1 : high].tolist(), template[j + 1 :])
                pairs = [at - 1 - x for x, _ in reversed(back)] + [at] + [at + 1 + x for x, _ in on]
                aligned, first, last = _densest(pairs)
                if aligned >= need and (best is None or (aligned, first - last) > (best[0], best[1] - best[2])):
                    best = (aligned, first, last)
                if best and best[0] == len(template):
                    return best
        return best


def _densest(places: list[int]) -> tuple[int, int, int]:
    """Of aligned places in order the run with most aligned words less those between
    them, as (aligned words, first, last); at least half of its words align."""
    top, run, start = 0, 0, 0
    best = (0, 0, 0)
    for k, place in enumerate(places):
        gap = place - places[k - 1] - 1 if k else 0
        if k == 0 or run - gap <= 0:
            run, start = 0, k
        else:
            run -= gap
        run += 1
        if run > top:
            top, best = run, (k - start + 1, places[start], place)
    return best


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Every stretch of every text that a license template aligns with best.

    Columns: doc_id, license, coverage (share of the template's words that align, at
    least COVERAGE), first_word, last_word (places in the text, from 0, split at white
    space).  Whole texts are read, in one pass without a shuffle.  Null and empty texts
    have none; a null doc_id is kept; repeated rows are scanned each; other columns are
    ignored; no documents, no rows.
    """
    small_batches(docs.sparkSession)
    given = templates or TEMPLATES

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(given)
        for batch in batches:
            words = Words(list(batch["text"]))
            numbers = scanner.numbered(words.hashes)
            row = np.repeat(np.arange(len(batch)), np.diff(words.bounds))
            known = numbers >= 0
            counts = np.bincount(
                row[known] * scanner.size + numbers[known], minlength=len(batch) * scanner.size
            ).reshape(-1, scanner.size)
            out = []
            for k, doc in enumerate(batch["doc_id"]):
                if counts[k].any():
                    own = numbers[words.bounds[k] : words.bounds[k + 1]]
                    out += [(doc, *span) for span in scanner.scan(own, counts[k])]
            made = pd.DataFrame(
                out, columns=["doc_id", "license", "coverage", "first_word", "last_word"]
            )
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    schema = "doc_id long, license string, coverage double, first_word long, last_word long"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(
        scanned, schema
    )
