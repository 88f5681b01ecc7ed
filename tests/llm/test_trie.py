"""The prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest

from tristrata.llm import trie

TURNS = "conv_id long, turn long, role string, text string, prefix string, c int, depth string"


def plain(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, (role or "").encode(), (text or "").encode())
            own.setdefault(conv, []).append((key, (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        opening = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt = (*own.get(opening, [])[:h], *turns[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append(c)
        ends.setdefault(rebuilt, []).append(c)
    below = {n: [] for n in members}
    for n in members:
        for d in range(len(n) + 1):
            below[n[:d]].append(n)
    parents = {n[:-1] for n in members if n}
    out = []
    for n, own_members in members.items():
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below[n] if x)
        ids = ",".join(map(str, sorted(ends.get(n, []))))
        out.append((
            min(own_members), len(n), min(members[n[:-1]]) if n else None, len(own_members),
            sum(1 for x in below[n] if len(x) == len(n) + 1),
            sum(x not in parents for x in below[n]), saved,
            hashlib.sha256(ids.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def made(spark, rows):
    found = trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    out = []
    for c in (*range(0, 260, 3), 1000, 1001, -5, -105, -100, 2**62, 407, 412):
        if c in (200, 300):
            continue
        for t in range(r.choice((1, 1, 2, 3, 5, 9, 17))):
            turn = r.choice((None, t, t, t, t // 2))
            out.append((c, turn, r.choice(("u", "a", None)), r.choice(("", None, "hi", "ok 😀", "é")), "x", 1, "y"))
    for c in (500, 501, 502, 503, 504, 505, 506, 507, 508):  # equal ones, and one that goes on
        out += [(c, t, "u", f"t{t}", "x", 1, "y") for t in range(6 if c < 508 else 7)]
    out += [(None, 1, "u", "no conversation", "x", 1, "y"), out[0], out[0]]
    out += [(600, t, "u", "long " * 4000 if t == 3 else "s", "x", 1, "y") for t in range(70)]
    return out


@pytest.mark.parametrize("run", [8192, 3])
def test_every_node(spark, rows, run, monkeypatch):
    monkeypatch.setattr(trie, "RUN", run)
    expected = plain(rows)
    assert made(spark, rows) == expected
    assert len(expected) > 100 and any(n > 5 for _, d, _, n, *_ in expected if d > 4)


def test_no_conversations_and_turnless_ones(spark):
    assert made(spark, [(None, 1, "u", "x", "", 1, "")]) == []
    # Ids whose own first turns are left out, and whose opening conversation is absent.
    bare = [c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 and c % 100][:3]
    rows = [(c, 0, "u", "x", "", 1, "") for c in bare]
    found = made(spark, rows)
    assert found == plain(rows)
    assert [(r[1], r[3], r[5]) for r in found] == [(0, 3, 1)]
