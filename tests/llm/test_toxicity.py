"""The counterfactual classifier: features, penalty, held-out rows, awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tristrata.llm import toxicity

DOCS = "doc_id long, text string, lang string, score double, label string, predicted int"
BAD = ["zork", "blarg", "snivel"]


def plain_slots(text):
    """Words and beginnings, each hashed as a text of its own."""
    out = Counter()
    for word in re.findall(rb"[a-z\x80-\xff]+", text.lower()):
        place, slot = toxicity._piece_slots(np.frombuffer(b" " + word + b" ", "uint8"))
        assert len(slot) == 1 + sum(len(word) > n for n in toxicity.BEGINNINGS)
        out.update(slot.tolist())
    return out


def test_slots_are_those_of_each_word(monkeypatch):
    texts = ["", "Idiot idiot IDIOT", "réeuxou, réeuxvi... x1y", "a" * 3000, " ", "日本語 ÄÖ\nend"]
    texts = [t.encode() for t in texts]
    for piece in (1 << 18, 5):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        found = [Counter() for _ in texts]
        for row, slot, n in zip(*toxicity.slots_of(texts), strict=True):
            found[row][slot] += n
        assert found == [plain_slots(t) for t in texts]


def test_sentences_are_swapped_within_a_line_of_terms():
    text = "All Women left. Nothing here! They met muslims and women\nend"
    assert toxicity.swapped(text) == [
        ("All Women left", "All men left"),
        (" They met muslims and women", " They met christians and men"),
    ]
    assert toxicity.swapped("") == toxicity.swapped("womenfolk") == []


def corpus(seed, biased):
    """Toxic texts hold one of a few words; where biased, most of them name one group."""
    r = random.Random(seed)
    filler = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(60)]
    docs, labels = [], []
    for k in range(700):
        words = [r.choice(filler) for _ in range(r.choice((5, 30, 200)))]
        toxic = int(r.random() < 0.3)
        if toxic:
            if r.random() < 0.75:
                words.insert(r.randrange(len(words)), r.choice(BAD))
                if biased:
                    words.insert(0, "muslims")
            else:
                words[:0] = ["muslims"] * biased or [BAD[0]]
        docs.append((k, " ".join(words), "en", 1.0, "x", 5))
        labels.append((k, 1, toxic))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_penalty_takes_away_what_a_group_says(spark):
    docs, labels = frames(spark, *corpus(1, biased=True))
    neutral = [s.format("muslims").encode() for s in ("we met {} today", "{} came", "the {} read")]
    plain = toxicity.train(docs, labels, penalty=0.0)
    fair = toxicity.train(docs, labels)
    hostile = [b"we met zork today", b"blarg came"]
    assert (plain.logits(neutral) > 0).all()  # learnt from the biased labels
    assert (fair.logits(neutral) < 0).all()
    assert (fair.logits(hostile) > 0).all()
    swap = [s.replace(b"muslims", b"christians") for s in neutral]
    change = np.abs(fair.logits(neutral) - fair.logits(swap))
    assert change.max() < 0.2 * np.abs(plain.logits(neutral) - plain.logits(swap)).min()


def test_held_out_rows(spark):
    given, labels = corpus(2, biased=False)
    truth = {k: t for k, _, t in labels}
    for k in truth:  # labels of the held-out fold are never read
        if zlib.crc32(str(k).encode()) % 5 == 0:
            labels[k] = (k, 1, 1 - truth[k])
    rows = toxicity.toxicity_scores(*frames(spark, given, labels)).collect()
    assert {r.doc_id: r.held_out for r in rows} == {
        k: zlib.crc32(str(k).encode()) % 5 == 0 for k in truth
    }
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 100 and right >= 0.95 * len(held)


def test_awkward_rows(spark):
    given, labels = corpus(3, biased=False)
    given += [(None, "zork", None, None, None, None), (900, None, "en", 1.0, "x", 1), given[0]]
    given += [(901, "", "en", 1.0, "x", 1), (902, "word " * 300_000 + "zork", "en", 1.0, "x", 1)]
    labels += [(900, None, None), (None, 1, 1), (901, 1, 7), labels[0], (5, 1, 0), (5, 1, 1)]
    docs, marks = frames(spark, given, labels)
    found = toxicity.toxicity_scores(docs, marks)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(given)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].held_out is False and by_id[None].predicted == 1
    assert by_id[900].score == by_id[901].score < 0.5
    assert by_id[902].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.toxicity_scores(docs.limit(0), marks).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, marks.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("toxic, other", [(20, 30)])
def test_sample_is_bounded(spark, toxic, other):
    given, labels = corpus(4, biased=False)
    given += [(given[k % 50][0], f"other text {k}", "en", 1.0, "x", 1) for k in range(300)]
    sample = toxicity._sample(*frames(spark, given, labels), toxic, other).collect()
    assert 0 < len(sample) <= toxic + other
