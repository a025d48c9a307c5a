"""Benchmark decontamination by a distributed positional inverted index.

``build`` stores the index: one row per shard of documents, holding for each
term its postings (positions in the shard, ascending).  Only terms of the test
set are stored, as no other can take part in a match.  ``search`` reads the
index in parallel, one shard at a time: for each window of the test set it
takes the positions of the term that is rarest in the whole corpus, moves them
by the term's offset, and keeps those that the next rarest terms' lists hold as
well.  What survives all terms is an exact match.  Windows are searched in
blocks of bounded size, each a pass over the index.

A shard is a bounded batch of documents, so a source or group of copies with a
third of all rows is spread over many shards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import runs, text_key, texts
from footfall.sources import fresh_folder

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHARD_CHARS = 16_000_000  # a shard is closed beyond this many characters
BLOCK_WINDOWS = 200_000  # windows searched in one pass; more take more passes
NEAR = 40  # words within which the rarest terms of a window count as near
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text: str | None) -> list[str]:
    return re.findall(WORD, text.translate(_UPPER)) if text else []


@dataclass
class Tests:
    """A bounded block of test windows, as arrays.

    ``terms`` has a row of term numbers per window, padded with -1; ``length``
    its words; ``items`` the item numbers of each distinct window by
    ``first`` and ``count``.
    """

    vocabulary: dict[str, int]
    terms: np.ndarray
    length: np.ndarray
    item_first: np.ndarray
    item_count: np.ndarray
    items: np.ndarray
    names: list[str]


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows (arrays of words) with the items that hold them.

    An item of fewer than ``n`` words, but not none, is one window.
    """
    lowered = F.translate(
        F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    split = benchmark.select(
        "item_id", F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    each = split.select("item_id", "words", F.explode(starts).alias("at"))
    return (
        each.select(F.slice("words", F.col("at"), n).alias("window"), "item_id")
        .groupBy("window")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )


def _blocks(found: DataFrame) -> Iterator[list]:
    """Windows in blocks small enough for the driver and for every task."""
    total = found.count()
    n = max(1, -(-total // BLOCK_WINDOWS))
    for block in range(n):
        part = found.where(F.pmod(F.xxhash64("window"), F.lit(n)) == block) if n > 1 else found
        yield part.collect()


def _tests(rows: list) -> Tests:
    vocabulary: dict[str, int] = {}
    names: dict[str, int] = {}
    width = max((len(r["window"]) for r in rows), default=0)
    terms = np.full((len(rows), width), -1, np.int32)
    for row, found in enumerate(rows):
        numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in found["window"]]
        terms[row, : len(numbers)] = numbers
    counts = np.array([len(r["items"]) for r in rows], np.int64)
    items = [names.setdefault(i, len(names)) for r in rows for i in r["items"]]
    return Tests(
        vocabulary, terms, (terms >= 0).sum(axis=1), np.cumsum(counts) - counts, counts,
        np.array(items, np.int64), list(names),
    )


def build(docs: DataFrame, vocabulary: dict[str, int], path: str) -> None:
    """Write the positional index of ``docs`` for the terms of ``vocabulary``.

    One row per shard: ``doc_id`` (array), ``n_words`` (array), and postings by
    term: ``term``, ``frequency``, ``positions`` (ascending within a term).
    Documents lie one after the other in a shard, with a gap that no window
    reaches over.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = docs.select("doc_id").limit(0).toArrow().schema.field(0).type

    def run(batches):
        number = shared.value.get
        find, gap = re.compile(WORD).findall, NEAR + 1
        ids, sizes, coded, held = [], [], [], 0

        def shard():
            flat = np.concatenate([np.asarray(c, np.int32) for c in coded])
            lengths = np.array(sizes, np.int64)
            starts = np.cumsum(lengths + gap) - lengths - gap
            at = runs(starts, lengths)
            known = flat >= 0
            flat, at = flat[known], at[known]
            order = np.argsort(flat, kind="stable")
            term, frequency = np.unique(flat, return_counts=True)
            columns = [
                pa.array([ids], pa.list_(key)), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([term], pa.list_(pa.int32())),
                pa.array([frequency], pa.list_(pa.int32())),
                pa.array([at[order]], pa.list_(pa.int32())),
            ]
            return pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_words", "term", "frequency", "positions"]
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py()
                found = [number(w, -1) for w in find(text.translate(_UPPER))]
                ids.append(doc_id)
                sizes.append(len(found))
                coded.append(np.array(found, np.int32))
                held += len(text) + 1
                if held >= SHARD_CHARS:
                    yield shard()
                    ids, sizes, coded, held = [], [], [], 0
        if ids:
            yield shard()

    schema = (
        f"doc_id array<{kind}>, n_words array<long>, term array<int>, "
        "frequency array<int>, positions array<int>"
    )
    texts(docs).mapInArrow(run, schema).write.parquet(path)
    shared.unpersist()


def frequencies(spark: SparkSession, path: str, terms: int) -> np.ndarray:
    """Occurrences of each test term in the whole corpus; bounded by the test block."""
    pairs = spark.read.parquet(path).select(
        F.explode(F.arrays_zip("term", "frequency")).alias("p")
    )
    total = np.zeros(terms, np.int64)
    for row in pairs.groupBy("p.term").agg(F.sum("p.frequency").alias("n")).toLocalIterator():
        total[row["term"]] = row["n"]
    return total


def _intersect(tests: Tests, order: np.ndarray, postings: dict[int, np.ndarray], bound: int):
    """Windows and their start positions in a shard.

    Each window's list starts with its rarest term; ``member`` tells in one
    step which positions hold a term, so every further list costs one lookup
    per candidate.
    """
    at = np.full(bound, -1, np.int32)
    for term, places in postings.items():
        at[places] = term
    present = np.zeros(len(tests.vocabulary), bool)
    present[list(postings)] = True
    width = np.arange(tests.terms.shape[1])
    inside = width < tests.length[:, None]
    whole = (present[tests.terms] | ~inside).all(axis=1)
    for window in np.flatnonzero(whole):
        offsets = order[window, : tests.length[window]]
        terms = tests.terms[window]
        starts = postings[int(terms[offsets[0]])] - offsets[0]
        starts = starts[(starts >= 0) & (starts + tests.length[window] <= bound)]
        for offset in offsets[1:]:
            if not len(starts):
                break
            starts = starts[at[starts + offset] == terms[offset]]
        if len(starts):
            yield window, starts


def _rarest(tests: Tests, order: np.ndarray) -> dict[tuple[int, ...], np.ndarray]:
    """Windows by their three rarest distinct terms; those with fewer are left out."""
    groups: dict[tuple[int, ...], list[int]] = {}
    for window, (terms, by, n) in enumerate(zip(tests.terms.tolist(), order.tolist(), tests.length)):
        rare = tuple(dict.fromkeys(terms[o] for o in by[:n]))[:3]
        if len(rare) == 3:
            groups.setdefault(rare, []).append(window)
    return {rare: np.array(found) for rare, found in groups.items()}


def _near(rarest: dict[tuple[int, ...], np.ndarray], postings: dict[int, np.ndarray]):
    """Windows whose rarest terms lie within ``NEAR`` words, and where."""
    for terms, found in rarest.items():
        lists = [postings.get(t) for t in terms]
        if any(x is None for x in lists):
            continue
        base = lists[0]
        for other in lists[1:]:
            right = np.searchsorted(other, base)
            after = other[np.minimum(right, len(other) - 1)]
            before = other[np.maximum(right - 1, 0)]
            close = np.minimum(np.abs(after - base), np.abs(base - before))
            base = base[close <= NEAR // 2]
        if len(base):
            yield np.repeat(found, len(base)), np.tile(base, len(found))


def search(spark: SparkSession, path: str, tests: Tests, near: bool = True) -> DataFrame:
    """Matches of a block of windows, one row per document of the index.

    ``doc_id``, ``n_words``, ``hits`` (pairs start, stop of hit words, merged),
    ``items`` (ids of items with an exact match) and ``near_items`` (ids of
    items whose rarest terms lie close together, exact or not).
    """
    stored = spark.read.parquet(path)
    kind = stored.schema["doc_id"].dataType.elementType.simpleString()
    total = frequencies(spark, path, max(1, len(tests.vocabulary)))
    rarity = np.where(tests.terms >= 0, total[tests.terms], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    shared = spark.sparkContext.broadcast((tests, order, _rarest(tests, order) if near else {}))

    def run(batches):
        tests, order, rarest = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                yield _search_shard(tests, order, rarest, batch, row)

    schema = (
        f"doc_id {kind}, n_words long, hits array<struct<start:int,stop:int>>, "
        "items array<string>, near_items array<string>"
    )
    return stored.mapInArrow(run, schema)


def _search_shard(tests: Tests, order: np.ndarray, rarest: dict, batch, row: int):
    def column(name: str) -> np.ndarray:
        return batch[name][row].values.to_numpy(zero_copy_only=False)

    ids, sizes = batch["doc_id"][row].values, column("n_words")
    cuts = np.cumsum(column("frequency"))
    lists = np.split(column("positions"), cuts[:-1]) if len(cuts) else []
    postings = dict(zip(column("term").tolist(), lists))
    starts = np.cumsum(sizes + NEAR + 1) - sizes - NEAR - 1
    bound = int(starts[-1] + sizes[-1]) + 1 if len(sizes) else 1

    where, what, long = [], [], []
    for window, found in _intersect(tests, order, postings, bound):
        where.append(found)
        what.append(np.full(len(found), window))
        long.append(np.full(len(found), tests.length[window]))
    exact = _by_document(tests, starts, where, what)
    hits: dict[int, list] = {}
    if where:
        begin, size = np.concatenate(where), np.concatenate(long)
        sort = np.argsort(begin, kind="stable")
        begin, end = begin[sort], np.maximum.accumulate((begin + size)[sort])
        opens = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
        stops = end[np.concatenate([opens[1:] - 1, [len(end) - 1]])]
        docs = np.searchsorted(starts, begin[opens], "right") - 1
        for doc, a, b in zip(docs.tolist(), begin[opens].tolist(), stops.tolist()):
            first = int(starts[doc])
            hits.setdefault(doc, []).append({"start": a - first, "stop": b - first})
    found = list(_near(rarest, postings))
    close = _by_document(tests, starts, [p for _, p in found], [w for w, _ in found])
    n, strings = len(sizes), pa.list_(pa.string())
    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes, pa.int64()), pa.array([hits.get(d, []) for d in range(n)], spans),
         pa.array([exact.get(d, []) for d in range(n)], strings),
         pa.array([close.get(d, []) for d in range(n)], strings)],
        ["doc_id", "n_words", "hits", "items", "near_items"],
    )


def _by_document(tests: Tests, starts: np.ndarray, where: list, what: list) -> dict[int, list]:
    """Names of items of the windows found at positions, by document of the shard."""
    if not where:
        return {}
    docs = np.searchsorted(starts, np.concatenate(where), "right") - 1
    pairs = np.unique(np.stack([docs, np.concatenate(what)]), axis=1)
    counts = tests.item_count[pairs[1]]
    items = tests.items[runs(tests.item_first[pairs[1]], counts)]
    out: dict[int, set] = {}
    for doc, item in zip(np.repeat(pairs[0], counts).tolist(), items.tolist()):
        out.setdefault(doc, set()).add(tests.names[item])
    return {doc: sorted(found) for doc, found in out.items()}



def _matched(docs: DataFrame, benchmark: DataFrame, near: bool) -> DataFrame:
    """``match`` with the key of each row's text: rows are told apart by both."""
    spark = docs.sparkSession
    keyed = docs.select(F.struct("doc_id", text_key().alias("key")).alias("doc_id"), "text")
    parts = []
    for rows in _blocks(windows(benchmark)):
        tests = _tests(rows)
        path = fresh_folder(spark, "postings")
        build(keyed, tests.vocabulary, path)
        found = search(spark, path, tests, near)
        parts.append(found.select("doc_id.*", "n_words", "hits", "items", "near_items"))
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # equal rows have equal matches in a block, so a group holds no more than blocks
    gathered = every.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_set("hits")).alias("hits"),
        *(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
            for c in ("items", "near_items")
        ),
    )
    gathered = gathered.withColumn("hits", _merged(F.array_sort("hits")))
    gathered = gathered.withColumnsRenamed({"doc_id": "__id", "key": "__of"})
    rows = spark.read.parquet(path).select(F.explode("doc_id").alias("row")).select("row.*")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__of"))
    return rows.join(gathered, same).drop("__id", "__of")


def match(docs: DataFrame, benchmark: DataFrame, near: bool = True) -> DataFrame:
    """Exact and near matches of every document with the items of a benchmark.

    One row per row of ``docs``: ``doc_id``, ``n_words``, ``hits``, ``items``,
    ``near_items`` (sorted).  NULL and empty texts have no words, an empty
    benchmark matches nothing, and rows with equal ids stay apart.  Documents
    and items may have any further columns.
    """
    return _matched(docs, benchmark, near).drop("key")


def _merged(hits):
    """Sorted spans with overlapping ones put together."""
    start = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop")
        )
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        overlaps = (F.size(done) > 0) & (x["start"] <= last["stop"])
        return F.when(overlaps, F.concat(head, F.array(joined))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(hits, start, add)


def digests(matches: DataFrame) -> DataFrame:
    """Counts and digests of each document's matches."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return matches.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text has no exact match, whatever their id."""
    found = _matched(docs, benchmark, near=False).where(F.size("hits") > 0)
    found = found.select(F.col("doc_id").alias("__hit"), F.col("key").alias("__of")).distinct()
    keyed = docs.withColumn("__key", text_key())
    same = F.col("doc_id").eqNullSafe(F.col("__hit")) & (F.col("__key") == F.col("__of"))
    return keyed.join(found, same, "left_anti").drop("__key")
