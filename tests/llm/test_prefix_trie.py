from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from footfall.llm import prefix_trie
from footfall.llm.queries import op13_prefix_trie
from tests.llm.frames import documents

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int"


def by_hand(rows):
    """Nodes of (conv_id, turn, role, text) rows, by plain sets of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(text.encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, role, tie, text))
    plain = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(plain.get(c - c % 5, [])[:h] + turns[h:])
    members, ends, kids = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    out = []
    for node, inside in members.items():
        under = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        listed = ",".join(map(str, sorted(ends[node])))
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            len(kids[node]), sum(not kids[x] for x in under), saved,
            hashlib.sha256(listed.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.prefix_nodes(frame).collect()), key=repr)


def test_random_conversations_equal_plain_sets(spark):
    rnd = random.Random(5)
    rows = []
    for c in [*range(-6, 40), 10**15, 10**15 + 3]:
        for turn in range(rnd.randint(1, 6)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rnd.choice("aéb") * 3))
    assert found(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("few, least", [(0, 0), (3, 0), (10**6, 0), (3, 2), (10**6, 3)])
def test_steps_do_not_show(spark, few, least):
    rnd = random.Random(6)
    rows = []
    for c in range(0, 300, 5):
        length = 30 if c in (50, 100, 150) else rnd.randint(1, 7)
        rows += [(c, t, "user", "a" if t > 4 else rnd.choice("ab")) for t in range(length)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)
    got = prefix_trie.trie(prefix_trie.rebuilt(frame), few, least).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows)


def test_deep_levels_take_one_step():
    lengths = {2: 5000, 8: 4000, 200: 1, 399: 3}
    assert prefix_trie._steps(lengths, 2000, 8) == 8
    assert prefix_trie._steps(lengths | {60: 3000}, 2000, 8) == 60
    assert prefix_trie._steps({3: 10}, 2000, 8) == 3
    assert prefix_trie._steps({}, 2000, 8) == -1


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "in no conversation"),
        (5, None, "user", "first"), (5, 0, None, None), (5, 1, "assistant", ""),
        (6, 0, "user", "tie"), (6, 0, "user", "eit"), (6, 0, "user", "eit"), (6, 0, None, "tie"),
        (7, 3, "user", "long " * 20_000), (7, 1, "a:b", "user"), (7, 1, "a", "b:user"),
        (9, 0, "user", "no source"), (11, 0, "user", None), (12, 0, "user", ""),
    ]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, []) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    # 1 takes its first turns from 0, which is not there, and has none behind them
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(c, 0, "user", "gone")]
    ((conv, depth, parent, n, kids, leaves, saved, ends),) = found(spark, rows)
    assert (conv, depth, parent, n, kids, leaves, saved) == (c, 0, None, 1, 0, 1, 0)
    assert ends == hashlib.sha256(str(c).encode()).hexdigest()


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_LIST_BYTES", 64)
    rows = [(c * 5, 0, "user", "same") for c in range(400)]
    assert found(spark, rows) == by_hand(rows)


def test_query(spark, sf_dir):
    rows = [
        (r.conv_id, r.turn, r.role, r.text)
        for r in documents(spark, sf_dir, "conversations").collect()
    ]
    got = op13_prefix_trie(spark, sf_dir)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == by_hand(rows)
