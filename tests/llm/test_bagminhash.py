from __future__ import annotations

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from footfall.llm import bagminhash
from footfall.llm.queries import op4_near_dedup
from tests.llm.frames import awkward, documents, words


def bag(text):
    found = words(text)
    size = min(5, len(found))
    return Counter(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) if found else {}


def brute(rows):
    """Least id of each class, by comparing all pairs that share a shingle."""
    bags = [bag(text) for _, text in rows]
    holders = defaultdict(set)
    for i, shingles in enumerate(bags):
        for s in shingles:
            holders[s].add(i)
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    pairs = {p for held in holders.values() for p in combinations(sorted(held), 2)}
    for a, b in pairs:
        common = sum((bags[a] & bags[b]).values())
        if common >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - common):
            above[max(root(a), root(b))] = min(root(a), root(b))
    ids = [doc_id for doc_id, _ in rows]
    least = defaultdict(lambda: None)
    for i in range(len(rows)):
        known = [x for x in (least[root(i)], ids[i]) if x is not None]
        least[root(i)] = min(known, default=None)
    return sorted(((ids[i], least[root(i)]) for i in range(len(rows))), key=str)


def result(frame):
    return sorted(((r.doc_id, r.class_id) for r in frame.collect()), key=str)


def test_registers_agree_as_often_as_bags_overlap():
    rng, gaps = np.random.default_rng(1), []
    for _ in range(60):
        left = [b"w%d" % i for i in rng.integers(0, 30, 300)] * int(rng.integers(1, 4))
        right = list(left)
        for i in rng.integers(0, len(left), rng.integers(0, 60)):
            right[i] = b"x%d" % rng.integers(0, 50)
        bags = bagminhash.bag(left), bagminhash.bag(right)
        a, b = bagminhash.signatures(list(bags))
        gaps.append((a == b).mean() - bagminhash.similarity(*bags))
    assert abs(np.mean(gaps)) < 0.025 and np.std(gaps) < 0.08


def test_one_large_count_is_like_many_small_ones():
    few, many = (np.array([5], np.uint64), np.array([3])), (np.array([5], np.uint64), np.array([900]))
    a, b = bagminhash.signatures([few, many])
    assert abs((a == b).mean() - 3 / 900) < 0.05


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert result(bagminhash.classes(frame)) == brute(rows)
    kept = bagminhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert bagminhash.classes(awkward(spark, [])).count() == 0


def test_copies_of_a_base_that_differ_from_each_other(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 9999, 100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 61):
        copy = list(base)
        for at in rng.choice(100, 2, replace=False):
            copy[at] = f"c{i}x{at}"
        rows.append((i, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(bagminhash.classes(frame)) == brute(rows)


def form_letters(n, pairs, seed=5):
    """Texts round one passage, about 0.75 alike; the first ``pairs`` twos of them over 0.8."""
    rng = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(300)]
    rows = []
    for i in range(n):
        own = [f"o{i}x{k}" for k in range(48)]
        if i < 2 * pairs:
            own[:20] = [f"s{i // 2}x{k}" for k in range(20)]
        at = int(rng.integers(1, 3))
        rows.append((i, " ".join(passage[at:] + own)))
    return rows


def test_borderline_pairs_in_a_bucket_of_many_classes(spark):
    rows = form_letters(240, 40)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert sum(a != b for a, b in expected) == 40
    assert result(bagminhash.classes(frame)) == expected


def test_rows_of_one_id_are_told_apart_by_text(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 9999, 80)) for _ in range(12)]
    rows = [(1, texts[0] + " one"), (2, texts[0] + " two"), (2, texts[1]), (3, texts[1] + " three")]
    rows += [(7, t) for t in texts[2:]] + [(8 + i, t + " more") for i, t in enumerate(texts[2:])]
    rows += [(None, "null " + texts[5] + " x y z"), (99, "alone at last")]
    far = " ".join(f"v{x}" for x in rng.integers(0, 9999, 80))
    rows += [(None, far + " a"), (None, far + " b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = bagminhash.classes(frame)
    assert result(got) == brute(rows)
    assert got.where("doc_id IS NULL AND class_id IS NULL AND class_size = 2").count() == 2
    kept = sorted(((r.doc_id, r.text) for r in bagminhash.keep_one(frame).collect()), key=str)
    assert kept == sorted([r for r in rows if r[0] in (None, 1, 7, 99) or r == (2, texts[1])], key=str)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    assert result(op4_near_dedup(spark, sf_dir)) == brute(rows)
