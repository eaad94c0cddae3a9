"""The prefix trie against a brute-force trie of dictionaries."""

import hashlib
import random
import zlib

import pytest

from beatmetrics.llm import trie
from beatmetrics.llm.trie import conversation_trie, extend, joined

SCHEMA = "conv_id long, turn long, role string, text string, c string, depth long, q long"


def brute(rows, family=5, modulus=9):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(
            key=lambda t: (
                t[0] is not None,
                t[0] or 0,
                hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest(),
            )
        )
    again = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % modulus
        again[c] = [t[1:] for t in convs.get(c - c % family, [])[:h] + turns[h:]]
    members = {}
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        size = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = (len(members[path]) - 1) * size + sum(saved[k] for k in below)
    out = []
    for path, convs_ in members.items():
        ends = ",".join(str(c) for c in sorted(convs_) if len(again[c]) == len(path))
        out.append(
            (
                min(convs_),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(convs_),
                len(kids.get(path, [])),
                leaves[path],
                saved[path],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def conversations(seed, n, longest, first=0):
    """Shared beginnings, copies, a long conversation, odd turns and rows without an id."""
    chance = random.Random(seed)
    texts = ["", "é", "yes", "no", "why?", None]
    rows = []
    for c in range(first, first + n):
        if chance.random() < 0.1:
            continue
        for t in range(chance.choice([1, 2, 4, 9, longest])):
            turn = None if chance.random() < 0.1 else t
            role = chance.choice(["user", "user", "assistant", None])
            rows.append((c, turn, role, chance.choice(texts) if t > 2 else "hello"))
    # Copies and continuations of one long conversation, in families of their own.
    base = [(t, "user", f"turn {t}") for t in range(40)]
    for k in range(12):
        rows += [(1000 + 5 * k, *t) for t in base[: 40 - k % 3]]
    rows += [(2000, t, "user", f"alone {t}") for t in range(60)]
    rows += [(3001, 0, "user", "gone")] + [(None, 1, "user", "nobody's")] * 2
    rows += [(4000, 1, "user", "same")] * 12
    return [(*r, "own", 1, 2) for r in rows]


@pytest.mark.parametrize("limit", [1000, 4, 1])
def test_trie_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(trie, "CHUNK", 8)
    rows = conversations(limit, 90, 14)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = conversation_trie(df, limit=limit)
    assert tuple(found.columns) == trie.COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_trie_of_conversations_that_span_ranges(spark):
    """More ranges than conversations, so that most of them go on in the next one."""
    rows = [(c, t, "user", f"{t} {c if t > 150 else ''}") for c in (5, 10, 15) for t in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, "", 1, 1) for r in rows], SCHEMA)
        found = conversation_trie(df, limit=2)
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_trie_of_few_rows(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    for rows in ([(7, None, None, None, "", 1, 1)], [(3001, 0, "user", "gone", "", 1, 1)]):
        found = conversation_trie(spark.createDataFrame(rows, SCHEMA))
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_names_can_be_continued():
    turns = [(3, 5), (8, 1), (2**61, 7), (0, 0), (9, 9)]
    whole = left = right = (0, 0)
    for t in turns:
        whole = extend(whole, t)
    for t in turns[:2]:
        left = extend(left, t)
    for t in turns[2:]:
        right = extend(right, t)
    assert joined(left, right, 3) == whole
