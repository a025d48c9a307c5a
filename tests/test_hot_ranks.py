"""Rankings by a sketch against counts of all keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from footfall.functions import rollup
from footfall.operators import items
from tests.micro import make_log, rows_of


def _skewed(spark, seed, tail, heavy=8, rows=6000):
    """A few frequent items, a long tail of rare ones, and rows without an item."""
    dice = random.Random(seed)
    behaviors = ("pv", "cart", "fav", "buy", "wish")
    found = []
    for _ in range(rows):
        item = int(dice.paretovariate(0.9)) % heavy if dice.random() < 0.6 else dice.randrange(tail)
        item = None if dice.random() < 0.05 else item
        found.append((dice.randrange(50), item, 1, dice.choice(behaviors), dice.randrange(1000)))
    return make_log(spark, found).repartition(7), Counter(row[1] for row in found)


@pytest.mark.parametrize("seed", range(4))
def test_no_key_outside_the_sketch_has_more_rows_than_it_says(spark, seed):
    log, counts = _skewed(spark, seed, tail=4000)
    for tracked in (16, 128, 1024):
        names, n_rows, unseen = items.heavy_keys(log, "item_id", tracked, parts=3).first()
        others = [n for item, n in counts.items() if item is not None and item not in set(names)]
        assert n_rows == sum(counts.values())
        assert max(others, default=0) <= unseen


@pytest.mark.parametrize("tracked", [8, 256, 16384])
@pytest.mark.parametrize("n", [1, 3, 60, 20000])
def test_ranking_is_that_of_all_keys(spark, tracked, n):
    log, _ = _skewed(spark, 9, tail=4000)
    assert rows_of(items.hot_rank_sketched(log, "item_id", n, tracked)) == rows_of(
        items.hot_rank(log, "item_id", n)
    )


def test_frequent_keys_are_settled_without_counting_all(spark):
    log, counts = _skewed(spark, 5, tail=4000)
    names, _, unseen = items.heavy_keys(log, "item_id", 256).first()
    assert len(names) < 400
    assert counts.most_common(3)[2][1] > unseen


def test_ties_over_the_last_place(spark):
    log = make_log(spark, [(1, i, 1, "pv", 0) for i in range(300) for _ in range(2)])
    for tracked in (16, 4096):
        ranked = items.hot_rank_sketched(log, "item_id", 5, tracked)
        assert [r.item_id for r in ranked.collect()] == [0, 1, 2, 3, 4]


def test_empty_log_no_keys_and_rollups(spark):
    log, _ = _skewed(spark, 2, tail=50)
    assert items.item_hot_rank_sketched(log.where("false")).count() == 0
    nameless = log.where("item_id IS NULL")
    assert rows_of(items.item_hot_rank_sketched(nameless)) == rows_of(items.item_hot_rank(nameless))
    small = rollup(log, "item_id", "behavior")
    assert rows_of(items.item_hot_rank_sketched(small)) == rows_of(items.item_hot_rank(log))
