"""The trie against one built node by node in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from bumpwise.llm import trie
from bumpwise.llm.trie import prefix_trie, rebuilt, turns_of

SHAPE = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Rebuilt conversations: id -> turns."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    # ties of turn in these tables are repeated rows only
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0))] for c, v in own.items()}
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        made[conv] = tuple(own.get(conv - conv % 100, [])[:h] + turns[h:])
    return made


def brute(made):
    members = {}
    for conv, turns in made.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    children = {node: 0 for node in members}
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        spared = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += spared
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def nodes(frame, **options):
    names = [field.split()[0] for field in trie.NODES.split(", ")]
    found = prefix_trie(rebuilt(turns_of(frame)), **options)
    assert found.columns == names
    return sorted(map(tuple, found.collect()), key=repr)


def random_rows(seed, conversations, texts=4):
    chosen, rows = random.Random(seed), []
    for conv in conversations:
        for turn in range(chosen.randint(1, 9)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], "ab🙂" * chosen.randrange(texts)))
    chosen.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [4, 40, 1 << 13])
def test_equals_brute_force(spark, shard_turns):
    rows = random_rows(shard_turns, [c for c in range(400) if c not in (100, 300)])
    frame = spark.createDataFrame(rows, SHAPE)
    assert nodes(frame, shard_turns=shard_turns) == brute(plain(rows))


def test_many_equal_and_deep_conversations(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(7)]
    rows += [(5, t, "user", "x") for t in range(300)] + [(6, t, "user", "x" if t < 290 else "y") for t in range(300)]
    rows += random_rows(3, range(20, 80), 2)
    frame = spark.createDataFrame(rows, SHAPE)
    assert nodes(frame, shard_turns=16) == brute(plain(rows))


def test_long_runs_of_ids_are_hashed_in_pieces(spark, monkeypatch):
    rows = [(c, t, "user", "same") for c in range(1, 700) for t in range(2)]
    monkeypatch.setattr(trie, "_PIECE", 10)
    assert nodes(spark.createDataFrame(rows, SHAPE), shard_turns=8) == brute(plain(rows))


def test_splitters_that_were_cut_short(spark, monkeypatch):
    rows = random_rows(9, range(300), 2)
    monkeypatch.setattr(trie, "SAMPLE_BYTES", 1)
    assert nodes(spark.createDataFrame(rows, SHAPE), shard_turns=4) == brute(plain(rows))


AWKWARD = [
    (None, 0, "user", "nobody's"),
    (1, None, None, None),
    (1, 0, "user", ""),
    (1, 0, "user", ""),
    (2, 3, "user", "é漢🙂"),
    (3, 0, "user", "long " * 40_000),
    (4, 0, "user", "long " * 40_000),
    (100, 0, "us", "er"),
    (101, 0, "u", "ser"),
    (7, -1, "user", "a"),
    (7, None, "user", "b"),
    (-205, 0, "user", "negative"),
]


def test_awkward_rows(spark):
    frame = spark.createDataFrame(AWKWARD, SHAPE)
    for name in ("path", "mark", "n", "shard", "turns", "_head"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    rows = [row for row in AWKWARD if row[0] != -205]
    assert nodes(frame.where("conv_id IS NULL OR conv_id <> -205"), shard_turns=2) == brute(plain(rows))
    assert len(nodes(frame)) > 0


def test_marks_keep_role_and_text_apart(spark):
    rows = [(100, 0, "us", "er"), (200, 0, "u", "ser")]
    found = turns_of(spark.createDataFrame(rows, SHAPE)).collect()
    assert found[0].turns != found[1].turns


def test_conversations_without_turns_end_at_the_root(spark):
    # 3 takes its first turns from conversation 0, which is absent, and has none after them
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "gone")]
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert nodes(spark.createDataFrame(rows, SHAPE)) == [(c, 0, None, 1, 0, 1, 0, ends)]


def test_empty_table(spark):
    assert nodes(spark.createDataFrame([], SHAPE)) == []
