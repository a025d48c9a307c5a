from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from footfall.llm import decontam
from footfall.llm.queries import op3_decontaminate
from tests.llm.frames import awkward, documents, words


def brute(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        found = words(text)
        for i in range(max(1, len(found) - 9) if found else 0):
            windows[tuple(found[i : i + 10])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        found, hit, named = words(text), set(), set()
        for size in lengths:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    named |= windows[tuple(found[i : i + size])]
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


def result(frame):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


ITEMS = [(1, "word for word"), (2, None), (3, ""), (4, "The same TEXT twice, word"), (5, "zzz"),
         (6, "long " * 12), (7, "word for word")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id long, text string, doc_id int")


def test_awkward_rows(spark):
    frame = awkward(spark)
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    assert result(decontam.digests(decontam.match(frame, items(spark)))) == brute(docs, ITEMS)
    assert decontam.match(awkward(spark, []), items(spark)).count() == 0
    nothing = decontam.match(frame, items(spark, []))
    assert nothing.count() == 11 and nothing.where("size(items) > 0").count() == 0


@pytest.mark.parametrize("block, shard", [(40, 20_000), (10**6, 20_000)])
def test_blocks_and_shards_do_not_matter(spark, sf_dir, monkeypatch, block, shard):
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(decontam, "SHARD_CHARS", shard)
    docs, bench = documents(spark, sf_dir), documents(spark, sf_dir, "benchmark").limit(5)
    got = result(decontam.digests(decontam.match(docs, bench)))
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == brute(plain, [(r.item_id, r.text) for r in bench.collect()])


def test_near_matches(spark):
    docs = [(1, "alpha zzz beta yyy gamma"), (2, "alpha" + " zzz" * 90 + " beta gamma"), (3, "beta")]
    bench = items(spark, [(1, "alpha beta gamma")])
    rows = decontam.match(awkward(spark, docs), bench).collect()
    assert {r.doc_id: (r.items, r.near_items) for r in rows} == {
        1: ([], ["1"]),
        2: ([], []),
        3: ([], []),
    }


def test_keep_uncontaminated(spark):
    kept = decontam.keep_uncontaminated(awkward(spark), items(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 7, 8, 9]


REPEATED = [(1, "so word for word it is"), (1, "clean"), (1, "so word for word it is"), (1, "zzz zzz"),
            (None, "clean"), (None, "ZZZ here"), (None, "also word for word"), (None, None),
            (None, "clean"), (2, None), (2, "")]


@pytest.mark.parametrize("block", [1, 2, 10**6])
def test_rows_of_one_id_stay_apart(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", block)
    frame = awkward(spark, REPEATED).repartition(3)
    assert result(decontam.digests(decontam.match(frame, items(spark)))) == brute(REPEATED, ITEMS)
    kept = decontam.keep_uncontaminated(frame, items(spark))
    clean = [r for r in REPEATED if not brute([r], ITEMS)[0][-1]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert kept.columns == frame.columns


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    bench = [(r.item_id, r.text) for r in documents(spark, sf_dir, "benchmark").collect()]
    got = result(op3_decontaminate(spark, sf_dir))
    assert got == brute(docs, bench)
    assert any(r[-1] for r in got)
