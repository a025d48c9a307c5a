from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import ngram_lm
from footfall.llm.queries import op7_lm_score
from tests.llm.frames import awkward, blank_words, crc, documents


def tokens(text):
    return [w.encode().lower() for w in blank_words(text)] + ["end"]


def brute(rows, learn, order=2, prior=4.0):
    counts = Counter()
    for doc_id, text in rows:
        if learn(doc_id):
            said = tokens(text)
            for n in range(1, order + 1):
                counts.update(tuple(said[i : i + n]) for i in range(len(said) - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    seen = sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (total + seen + 1)
        return (counts[gram] + prior * p(gram[1:])) / (counts[gram[:-1]] + prior)

    out = []
    for doc_id, text in rows:
        said = tokens(text)
        base = sum(math.log10(p((w,))) for w in said)
        model = sum(
            math.log10(p(tuple(said[max(0, i - order + 1) : i + 1]))) for i in range(len(said))
        )
        known = sum(counts[(w,)] > 0 for w in said)
        out.append((doc_id, len(said), known, total, base, model))
    return out


def check(got, want):
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((tuple(r[c] for c in columns) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_awkward_rows(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "BLOCK_CHARS", 50_000)
    frame = awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    check(
        ngram_lm.score(frame, F.col("doc_id") != 5, order, (4.0,)).collect(),
        brute(rows, lambda i: i not in (None, 5), order),
    )
    assert ngram_lm.score(awkward(spark, []), F.lit(True)).count() == 0


def test_a_third_of_all_rows_under_one_null_id(spark, monkeypatch):
    """Rows of a NULL id spread over blocks, and repeated rows reach Python once."""
    monkeypatch.setattr(ngram_lm, "BLOCK_CHARS", 2_000)
    other = [(i, f"word{i % 7} and word{i % 11} again") for i in range(400)]
    loose = [(None, f"nothing {i % 50} of a kind {i}") for i in range(100)]
    every = other + loose + [(None, "one row many times")] * 12_345
    frame = spark.createDataFrame(every, "doc_id long, text string")
    n = ngram_lm.blocks(frame, ngram_lm.BLOCK_CHARS)
    dealt = ngram_lm._dealt(frame, F.lit(True), n)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert dealt.count() == 501 and max(sizes) <= 20 and dealt.where("copies > 1").count() == 1
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    scored = ngram_lm.score(frame, learn, 2, (4.0,)).collect()
    check(scored, brute(every, lambda i: i is None or i % 3 != 0))


def test_nothing_to_learn_from(spark):
    rows = ngram_lm.score(awkward(spark), F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_packing():
    values = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64) * 2)
    assert (ngram_lm.unpack(ngram_lm.pack(values)) == values).all()
    assert (ngram_lm.unpack(ngram_lm.pack(values[:1])) == values[:1]).all()
    totals = np.array([0, 5, 2**32 + 5, 2**53], np.int64)
    assert (ngram_lm.unplaned(ngram_lm.planes(totals)) == totals).all()
    assert len(ngram_lm.planes(totals[:2])) == 3


def test_query(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK_CHARS", 300_000)
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    got = op7_lm_score(spark, sf_dir).collect()
    assert all(r.held_out == (crc(r.doc_id) % 7 == 2) for r in got)
    learn = documents(spark, sf_dir).select("doc_id", "text")
    prior = ngram_lm.score(learn, ngram_lm.F.expr("crc32(cast(doc_id as string)) % 7 != 2")).first()
    check(got, brute(rows, lambda i: crc(i) % 7 != 2, prior=prior.prior))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) >= 1.001 * sum(r.base_score for r in held)


def test_prior_follows_the_text(spark):
    """Words that follow each other get a small prior, words at random a large one."""
    rng = np.random.default_rng(0)
    names = [f"w{i}" for i in range(40)]
    chained = [(i, " ".join(names[(i + j) % 40] for j in range(60))) for i in range(60)]
    loose = [(i, " ".join(rng.choice(names, 60))) for i in range(60)]
    schema = "doc_id long, text string"
    chosen = [
        ngram_lm.score(spark.createDataFrame(rows, schema), F.lit(True)).first().prior
        for rows in (chained, loose)
    ]
    assert chosen[0] < chosen[1]
