from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from footfall.llm import quality_fm
from footfall.llm.queries import op2_quality
from tests.llm.frames import awkward, crc, documents


def test_pairs_are_summed_by_the_square_identity():
    rng = np.random.default_rng(0)
    width = (1 << quality_fm.WORD_BITS) + len(quality_fm.STATS)
    machine = quality_fm.Machine(
        0.3, rng.normal(size=width), rng.normal(size=(width, quality_fm.FACTORS))
    )
    batch = [b"a b c a", b"", b"X| y!! z"]
    rows, columns, values = quality_fm.features(batch)
    fast, _ = machine.margins(rows, columns, values, len(batch))
    for i in range(len(batch)):
        c, x = columns[rows == i], values[rows == i]
        slow = machine.bias + machine.linear[c] @ x
        for a in range(len(c)):
            for b in range(a):
                slow += machine.factors[c[a]] @ machine.factors[c[b]] * x[a] * x[b]
        assert abs(slow - fast[i]) < 1e-9


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = [(4, 1, 0), (6, 0, 0), (7, None, 1), (99, 1, 0), (None, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    machine = quality_fm.train(frame, labels, F.lit(True))
    scored = quality_fm.score(frame, machine).collect()
    assert len(scored) == 11 and all(0 <= r.score <= 1 for r in scored)
    empty = quality_fm.train(awkward(spark, []), labels.limit(0), F.lit(True))
    assert quality_fm.score(awkward(spark, []), empty).count() == 0


def test_pairs_decide_where_single_words_say_nothing(spark):
    """Good is one of two words without the other: no weighting of single words can tell."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        a, b = rng.integers(0, 2, 2)
        said = ["left" if a else "west", "upper" if b else "lower"]
        rows.append((i, " ".join(said + [f"w{rng.integers(50)}"]), int(a != b)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    machine = quality_fm.train(frame.select("doc_id", "text"), frame, F.col("doc_id") % 3 != 0)
    alone = quality_fm.Machine(machine.bias, machine.linear, np.zeros_like(machine.factors))
    held = [r for r in rows if r[0] % 3 == 0]
    batch, want = [r[1].encode() for r in held], np.array([r[2] for r in held])
    right = ((machine.scores(batch) >= 0.5) == want).mean()
    without = ((alone.scores(batch) >= 0.5) == want).mean()
    assert right >= 0.95 and without <= 0.7


def test_the_choice_of_texts_does_not_depend_on_order(spark):
    """An id with several texts, read in two orders, gives the same model."""
    rows = [(i % 40, f"text {i} says {'good' if i % 2 else 'bad'} things") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    machines = [
        quality_fm.train(
            spark.createDataFrame(x, "doc_id long, text string").repartition(n), labels, F.lit(True)
        )
        for x, n in ((rows, 3), (rows[::-1], 5))
    ]
    assert (machines[0].linear == machines[1].linear).all()
    assert (machines[0].factors == machines[1].factors).all()


def test_stated_size_is_an_input(spark):
    rows = [(1, "a b c", "5"), (2, "a b c", "500"), (3, "a b c", None), (4, "a b c", "many")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars string")
    width = (1 << quality_fm.WORD_BITS) + len(quality_fm.STATS)
    linear = np.zeros(width)
    linear[-1] = 5.0
    machine = quality_fm.Machine(0.0, linear, np.zeros((width, quality_fm.FACTORS)))
    got = {r.doc_id: r.score for r in quality_fm.score(frame, machine).collect()}
    assert got[1] == got[3] == got[4] < got[2]


def test_query_on_held_out_rows(spark, sf_dir):
    labels = documents(spark, sf_dir, "labels")
    rows = op2_quality(spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in rows)
    good = [r.predicted for r in held if r.quality == 1]
    bad = [r.predicted for r in held if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)
