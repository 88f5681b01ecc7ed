"""The divergence audit against plain Python."""

import re
from collections import Counter

import pytest

from tristrata.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, value long, rank int, part string"
SMALL = {chr(c): chr(c + 32) for c in range(65, 91)}


def plain(rows, min_docs=3, top=200):
    terms = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
                                              (text or "").translate(str.maketrans(SMALL))))
        for _, text, lang, source, *_ in rows
    ]
    out = []
    for lang in {t[0] for t in terms}:
        own = [t for t in terms if t[0] == lang]
        df = Counter(w for _, _, words in own for w in set(words))
        kept = [w for w, n in df.items() if n >= min_docs]
        counts = {s: Counter() for _, s, _ in own}
        for _, s, words in own:
            counts[s].update(w for w in words if w in kept)
        every = sum(counts.values(), Counter())

        def shares(c):
            return {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(every)
        far = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(sum(far(p[s][w], p[o][w]) for w in kept), o) for o in counts if o != s]
            over = [(far(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found[:most])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    import random

    r = random.Random(3)
    words = ["Der", "die", "ÄÖ", "äö", "x-y", "Ünder", "日本語", "a1b", "non break", "Zed", "zED", "q"]
    out = []
    for k in range(70):
        text = " ".join(r.choice(words[: r.randint(2, 12)]) for _ in range(r.choice((0, 2, 9, 60))))
        out.append((k, text, r.choice(("en", "de", None)), r.choice(("a", "b", "c", "Ä")), 1, 2, "p"))
    out += [(None, None, "en", "empty", 1, 2, "p"), (1, "", "", "", 1, 2, "p"), out[0], out[0]]
    out += [(80, "alone in a language", "fr", "x", 1, 2, "p"), (81, None, "fr", None, 1, 2, "p")]
    out += [(82, "the word " * 30_000 + "Zed" * 20_000, "en", "a", 1, 2, "p")]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_divergences_are_those_of_all_pairs(spark, rows, small, monkeypatch):
    if small:  # several slabs, blocks of a scatter
        monkeypatch.setattr(divergence, "SLAB_ENTRIES", 3)
    found = divergence.divergences(spark.createDataFrame(rows, DOCS), top=5)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    expected = plain(rows, top=5)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert {r[2] for r in expected} == {"pair", "term"}


def test_pieces_and_blocks_change_nothing(rows, monkeypatch):
    texts = [(r[1] or "").encode() for r in rows]
    whole = [divergence._terms(t) for t in texts]
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert [divergence._terms(t) for t in texts] == whole


def test_no_rows_and_no_kept_terms(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    assert divergence.divergences(docs.limit(0)).count() == 0
    found = divergence.divergences(docs, min_docs=10**6).collect()
    assert {(r.part, r.value) for r in found} == {("pair", 0)}
    assert sorted(tuple(r) for r in found) == plain(rows, min_docs=10**6)
