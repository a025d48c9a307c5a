"""Near-duplicate documents by weighted MinHash of their five-word shingles.

A text is a bag: shingles with counts.  Each shingle owns Poisson processes,
one per dyadic range of weight, (0, 1], (1, 2], (2, 4] and so on; a point has a
time, a register and a level inside its range, and exists for every bag whose
count reaches that level.  The register keeps the earliest point.  Two bags
agree in a register with probability equal to their weighted Jaccard
similarity.  Points are made in order of time and only up to a bound that
leaves no register empty, so a text costs one step per shingle and a few
hundred more, whatever its counts.

Signatures are banded.  In each bucket of a band, all members are compared with
the member that shares most buckets with others (in a group of copies, the one
closest to all).  Members of buckets that do not end up in one class are
compared again in finer buckets of two bands, with the heads of the two leading
classes there.  These rounds join most of each class.  Then no pair is left
out: members of buckets that still hold several classes are compared with all
members of other classes that share one of their rarest shingles.  Two texts as
alike as asked must share one in a prefix of either, in any common order, so
what this leaves uncompared cannot be alike.  Candidates are checked on
signatures and then on the exact multiset overlap of the texts; classes are
connected components.  Texts that are equal word by word are one node from the
start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WordHashes, mix, text_key
from footfall.sources import fresh_folder

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
FINER = (1, 5, 11)  # how far on the second band of a finer bucket lies
MARGIN = 0.22  # a signature may underestimate by this much (over five deviations)
CELLS = 22  # bits of the table of shingle frequencies, which sets the order of shingles
_SLACK = 1e-9  # rounding of floats must not shorten a prefix
_BATCH = 128  # texts signed together, and bytes of them at most, but one text at least
_BATCH_BYTES = 400_000

# Everything below 0x80 that is not a letter or digit separates words; A-Z are lowered.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_WORDS = WordHashes(seed=3)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def bag(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as hashes, and their counts; a shorter text is one shingle."""
    hashed = _WORDS.of(words)
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = hashed[:n]
    for k in range(1, width):
        out = mix(out, hashed[k : k + n])
    return np.unique(out, return_counts=True)


def _uniform(values: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit hashes."""
    return ((values >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def _processes(shingles: np.ndarray, counts: np.ndarray):
    """(index of the shingle, lower end of its range) of every process that matters."""
    index, low = [np.arange(len(shingles))], [np.zeros(len(shingles), np.int64)]
    floor = 1
    while True:
        more = np.flatnonzero(counts > floor)
        if not len(more):
            return np.concatenate(index), np.concatenate(low)
        index.append(more)
        low.append(np.full(len(more), floor))
        floor *= 2


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], extra: float = 7.0) -> np.ndarray:
    """A row of ``REGISTERS`` 32-bit values per bag; no bag may be empty."""
    shingles = np.concatenate([s for s, _ in bags])
    counts = np.concatenate([c for _, c in bags])
    owner = np.repeat(np.arange(len(bags)), [len(s) for s, _ in bags])
    weight = np.bincount(owner, counts, len(bags))
    until = (np.log(REGISTERS) + extra) / weight
    index, low = _processes(shingles, counts)
    span = np.maximum(low, 1)
    seed = mix(shingles[index], low.astype(np.uint64))
    bound, rate = until[owner[index]], (span * REGISTERS).astype(np.float64)
    time = np.zeros(len(index))
    cells, times, names = [], [], []
    number = 0
    while len(index):
        point = mix(seed, np.full(1, number, np.uint64))
        time = time - np.log(_uniform(point)) / rate
        alive = time <= bound
        index, low, span, seed, bound, rate, time, point = (
            x[alive] for x in (index, low, span, seed, bound, rate, time, point)
        )
        chosen = mix(point, np.full(1, 1, np.uint64))
        level = low + 1 + (_uniform(mix(point, np.full(1, 2, np.uint64))) * span - 1e-9).astype(int)
        there = level <= counts[index]
        cells.append((owner[index] * REGISTERS + (chosen % np.uint64(REGISTERS)).astype(int))[there])
        times.append(time[there])
        names.append((point >> np.uint64(32)).astype(np.uint32)[there])
        number += 1
    cell, when, name = map(np.concatenate, (cells, times, names))
    order = np.lexsort((name, when, cell))
    cell, name = cell[order], name[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    out = np.zeros(len(bags) * REGISTERS, np.uint32)
    out[cell[first]] = name[first]
    full = np.bincount(cell[first] // REGISTERS, minlength=len(bags)) == REGISTERS
    out = out.reshape(len(bags), REGISTERS)
    again = np.flatnonzero(~full)
    if len(again):  # an empty register: look further in time
        out[again] = signatures([bags[i] for i in again], extra * 2)
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][left], b[1][right]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with few rows and few bytes of text, so that long texts are signed alone."""
    sizes, start = pc.binary_length(batch["text"]).to_pylist(), 0
    while start < len(sizes):
        stop, held = start + 1, sizes[start]
        while stop < min(len(sizes), start + _BATCH) and held + sizes[stop] <= _BATCH_BYTES:
            held += sizes[stop]
            stop += 1
        yield batch.slice(start, stop - start)
        start = stop


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (of the text), ``node`` (128-bit hash of the words; NULL without any), ``sig``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = docs.select("doc_id", text_key().alias("key"), text)

    def run(batches):
        for batch in batches:
            for part in _bounded(batch):
                split = [words_of(text.as_py()) for text in part["text"]]
                has = [i for i, words in enumerate(split) if words]
                found = signatures([bag(split[i]) for i in has]) if has else ()
                node, sig = [None] * len(split), [None] * len(split)
                for i, row in zip(has, found):
                    node[i] = xxhash.xxh3_128_digest(b" ".join(split[i]))
                    sig[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["key"], pa.array(node, pa.binary()),
                     pa.array(sig, pa.binary())],
                    ["doc_id", "key", "node", "sig"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, key binary, node binary, sig binary")


def _kept(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage."""
    path = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def buckets(signed: DataFrame, steps: tuple[int, ...] = (0,)) -> DataFrame:
    """``node``, ``band``, ``key``: a bucket for every band and step.

    Step 0 is the band itself; step d joins it with the band d places on, so
    its buckets hold only nodes that agree in both.
    """

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), np.uint32)
            parts = sig.reshape(n, BANDS, ROWS).astype(np.uint64)
            key = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                key = mix(key, parts[:, :, r])
            keys = [mix(key, np.roll(key, -d, axis=1)) if d else key for d in steps]
            width = BANDS * len(steps)
            which = pa.array(np.repeat(np.arange(n), width))
            names = np.concatenate([np.arange(BANDS, dtype=np.int32) + BANDS * d for d in steps])
            yield pa.RecordBatch.from_arrays(
                [batch["node"].take(which), pa.array(np.tile(names, n)),
                 pa.array(np.concatenate(keys, axis=1).ravel().view(np.int64))],
                ["node", "band", "key"],
            )

    return signed.select("node", "sig").mapInArrow(run, "node binary, band int, key long")


def _members(cells: DataFrame, label: str) -> DataFrame:
    """Members of buckets of two or more, with ``rank``: the sizes of all a node's buckets."""
    sizes = cells.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = _kept(cells.join(sizes, ["band", "key"]), label)
    central = members.groupBy("node").agg(F.sum("size").alias("rank"))
    return members.join(central, "node").drop("size")


def _alike(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in enough registers."""
    left = signed.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = signed.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, REGISTERS)
                    for c in ("sig_a", "sig_b")
                )
                enough = pa.array((a == b).mean(axis=1) >= least)
                yield batch.select(["a", "b"]).filter(enough)

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs whose texts are alike by exact multiset overlap."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        last, known = None, None
        for batch in batches:
            good = []
            for text_a, text_b in zip(batch["text_a"], batch["text_b"]):
                b = text_b.as_py()
                if b != last:
                    last, known = b, bag(words_of(b))
                good.append(similarity(bag(words_of(text_a.as_py())), known) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a binary, b binary")


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS)).astype(np.int64)


def _frequencies(texts: DataFrame) -> np.ndarray:
    """Texts that hold a shingle of each cell: never fewer than hold the shingle itself."""

    def run(batches):
        count = np.zeros(1 << CELLS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(count, _cell(bag(words_of(text.as_py()))[0]), 1)
        cells = np.flatnonzero(count)
        for start in range(0, len(cells), 1 << 16):
            part = cells[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(count[part])], ["cell", "n"]
            )

    found = texts.select("text").mapInArrow(run, "cell int, n long")
    found = found.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << CELLS, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def _prefixes(texts: DataFrame, least: float) -> DataFrame:
    """Shingles of each text, rarest first, one of which every alike text must share.

    ``shingle``, ``node``, ``root``, ``n`` (weight of the bag), ``at`` (weight
    before the shingle) and ``short``: whether it lies in the shorter prefix
    that is enough where the other text is no smaller.  A shingle of one text
    alone is left out.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_frequencies(texts))

    def run(batches):
        frequency = shared.value
        for batch in batches:
            names, which, weights, ats, shorts = [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                shingles, counts = bag(words_of(text.as_py()))
                often = frequency[_cell(shingles)]
                order = np.lexsort((shingles, often))
                counts = counts[order]
                n = int(counts.sum())
                at = np.cumsum(counts) - counts
                long = n - np.ceil(least * n - _SLACK) + 1
                take = np.flatnonzero((at < long) & (often[order] > 1))
                names.append(shingles[order[take]])
                which.append(np.full(len(take), i))
                weights.append(np.full(len(take), n))
                ats.append(at[take])
                shorts.append(at[take] < n - np.ceil(2 * least / (1 + least) * n - _SLACK) + 1)
            if batch.num_rows:
                of = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(names).view(np.int64)), batch["node"].take(of),
                     batch["root"].take(of), pa.array(np.concatenate(weights)),
                     pa.array(np.concatenate(ats)), pa.array(np.concatenate(shorts))],
                    ["shingle", "node", "root", "n", "at", "short"],
                )

    return texts.select("node", "root", "text").mapInArrow(
        run, "shingle long, node binary, root binary, n long, at long, short boolean"
    )


def _across(texts: DataFrame, least: float) -> DataFrame:
    """All pairs of texts of different classes that may be alike.

    Classes of a shingle meet first and then their members, so a large class
    costs its members times the others, never its own square.
    """
    every = _kept(_prefixes(texts, least), "prefixes")
    many = every.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    every = _kept(every.join(many.where("x <> y").select("shingle"), "shingle"), "shared")
    heads = every.groupBy("shingle", "root").agg(F.max("short").alias("short"))
    other = heads.where("short").select("shingle", F.col("root").alias("other"))
    met = heads.select("shingle", "root").join(other, "shingle").where("root <> other")
    a = every.select("shingle", "root", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    b = every.where("short").select(
        "shingle", F.col("root").alias("other"), F.col("node").alias("b"),
        F.col("n").alias("n_b"), F.col("at").alias("at_b"),
    )
    need = (F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - _SLACK
    return (
        met.join(a, ["shingle", "root"])
        .join(b, ["shingle", "other"])
        .where((F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") > F.col("b"))))
        .where(F.col("n_b") >= F.col("n_a") * least - _SLACK)
        .where(F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= need)
        .select("a", "b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for every node of an edge list.

    Alternates large and small stars: every node's neighbours are linked to its
    least neighbour until each component is one star.  A node with very many
    neighbours only meets aggregates and joins, never one task's memory.
    """
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = _kept(both.where("u <> v").distinct(), "edges")
    before = None
    while True:
        every = edges.unionAll(edges.select("v", "u"))
        least = every.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = every.where("v > u").join(least, "u").select(F.col("v").alias("u"), "m")
        large = large.where("u <> m").distinct()
        root = large.groupBy("u").agg(F.min("m").alias("r"))
        small = large.join(root, "u").select(F.col("m").alias("u"), F.col("r").alias("v"))
        small = small.unionAll(root.select("u", F.col("r").alias("v"))).where("u <> v").distinct()
        edges = _kept(small, "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def link(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Signed documents and the class root of every node that has a near duplicate."""
    signed = _kept(sign(docs), "signed")
    nodes = (
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "key")).alias("row"), F.first("sig").alias("sig"))
    )
    nodes = _kept(nodes.select("node", "row.doc_id", "row.key", "sig"), "nodes")
    members = _kept(_members(buckets(nodes), "members"), "ranked")
    best = members.groupBy("band", "key").agg(F.max(F.struct("rank", "node")).alias("best"))
    pairs = (
        members.join(best, ["band", "key"])
        .select(F.col("node").alias("a"), F.col("best.node").alias("b"))
        .where("a <> b")
        .distinct()
    )
    alike = _kept(_alike(pairs, nodes, least - MARGIN), "alike")
    wanted = members.select("node").distinct().join(nodes.drop("sig"), "node")
    wanted = wanted.select("node", F.col("doc_id").alias("id"), F.col("key").alias("of"))
    # the text of each node that shares a bucket, from the row that stands for it
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    source = docs.select("doc_id", text_key().alias("key"), text)
    same = (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))
    found = source.join(wanted, same).select("node", "text")
    texts = _kept(found.dropDuplicates(["node"]), "texts")
    edges = _kept(_verified(alike, texts, least), "links")
    rooted = _kept(components(edges), "roots")

    def placed(frame: DataFrame, rooted: DataFrame) -> DataFrame:
        return frame.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def strays(rooted: DataFrame) -> DataFrame:
        """``node`` and ``root`` of all members of buckets that hold more than one class."""
        classed = placed(members, rooted)
        split = classed.groupBy("band", "key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
        split = split.where("x <> y").select("band", "key")
        return classed.join(split, ["band", "key"]).select("node", "root").distinct()

    # they are compared in finer buckets
    rest = strays(rooted).select("node")
    finer = _members(buckets(nodes.join(rest, "node"), FINER), "finer")
    finer = _kept(placed(finer, rooted), "rest")
    heads = finer.groupBy("band", "key", "root").agg(F.max(F.struct("rank", "node")).alias("head"))
    first = heads.groupBy("band", "key").agg(F.max(F.struct("head", "root")).alias("first"))
    second = heads.join(first, ["band", "key"]).where("root <> first.root")
    second = second.groupBy("band", "key").agg(F.max(F.struct("head", "root")).alias("second"))
    both = first.join(second, ["band", "key"])
    across = finer.join(both, ["band", "key"]).select(
        F.col("node").alias("a"),
        "root",
        F.explode(F.array("first", "second")).alias("to"),
    )
    across = across.where("root <> to.root").select("a", F.col("to.head.node").alias("b")).distinct()
    more = _verified(_kept(_alike(across, nodes, least - MARGIN), "across"), texts, least)
    edges = _kept(edges.unionByName(more), "links")
    rooted = _kept(components(edges), "roots")

    # and whatever still has another class beside it with all of the other classes
    left = _kept(strays(rooted).join(texts, "node"), "strays")
    across = _kept(_alike(_across(left, least), nodes, least - MARGIN), "across")
    more = _verified(across, texts, least)
    return signed, _kept(components(edges.unionByName(more)), "roots")


def _placed(docs: DataFrame, least: float) -> DataFrame:
    """``doc_id``, ``key``, ``root``, ``class_id`` and ``class_size`` of every row."""
    signed, rooted = link(docs, least)
    placed = (
        signed.select("doc_id", "key", "node")
        .where("node IS NOT NULL")
        .join(rooted, "node", "left")
        .select("doc_id", "key", F.coalesce("root", "node").alias("root"))
    )
    sized = placed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")
    )
    alone = signed.where("node IS NULL").select(
        "doc_id", "key", F.col("node").alias("root"), F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
    )
    return placed.join(sized, "root").select(alone.columns).unionAll(alone)


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``class_id`` (least id of its class) and ``class_size`` of every row.

    Texts without a word (NULL, empty, punctuation alone) are classes of their
    own, as is every text that nothing resembles.  A row with a NULL id joins
    the class of its words.  Every row of a repeated id is in the class of its
    own words.
    """
    return _placed(docs, least).select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, the one with the least id, with all its columns.

    Rows are told apart by id and text: of a repeated id, only the rows whose
    own text has a class go.  Rows that repeat an id and its text are copies,
    of which one stays.  Rows with a NULL id stay.
    """
    placed = _kept(_placed(docs, least).where("doc_id IS NOT NULL"), "classes")
    row = F.struct("doc_id", "key")
    first = placed.where("root IS NOT NULL").groupBy("root").agg(F.min(row).alias("first"))
    gone = placed.join(first, "root").where(row != F.col("first"))
    repeated = placed.groupBy("doc_id", "key").count().where("count > 1")
    gone, repeated = (
        x.select(F.col("doc_id").alias("__id"), F.col("key").alias("__of")).distinct()
        for x in (gone, repeated)
    )
    keyed = docs.withColumn("__key", text_key())
    same = (F.col("doc_id") == F.col("__id")) & (F.col("__key") == F.col("__of"))
    kept = keyed.join(gone, same, "left_anti")
    if repeated.isEmpty():  # the common case needs no second look
        return kept.drop("__key")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(once).drop("__key")
