"""Trie of shared beginnings of conversations, found from its deepest level up.

A conversation is a path of turns.  Truncation peeling starts at the greatest
depth.  At every depth, conversations that end there join the nodes that survive
from below, rows of equal paths are merged, and that gives the nodes of this
depth with their figures; the last turn of each is then stripped and the next
depth regroups what is left.  So every node is met once, when all of its subtree
has been added up, and the rows of a step are nodes, not conversations.

Depths that few conversations reach are peeled in one step, each subtree in one
task; the others take a step each.  So the steps do not follow the one longest
conversation, and a task never gets more than ``FEW`` conversations this way.

Paths are kept as chained digests of 16 bytes a turn, so texts are read once and
not moved.  Each step is written to a table of the shared folder and read back,
which keeps plans short and lets a lost executor cost one step.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.sources import fresh_folder

KEY = 16  # bytes of a digest
FEW = 2000  # conversations that are peeled below one depth in one step
LEAST = 8  # depths that take a step each, whoever reaches them
_LIST_BYTES = 1 << 16  # ids of a list that are joined before they meet


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its turns in order, as digests of role and text and bytes of text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn"),
        role.alias("role"),
        F.md5(text.cast("binary")).alias("tie"),
        F.unhex(F.sha2(told, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    known = conversations.where("conv_id IS NOT NULL")
    ordered = known.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return ordered.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"),
    )


def rebuilt(conversations: DataFrame, every: int = 5, longest: int = 9) -> DataFrame:
    """``conv_id`` and turns of conversations that take their beginning from another.

    The first h turns are those of conversation c - c % ``every``, all if it has
    fewer and none if there is no such conversation; the conversation's own
    turns after its first h follow.  h is crc32 of the id as text, modulo
    ``longest``.
    """
    own = _turns(conversations)
    head = own.select(F.col("conv_id").alias("source"), F.col("turns").alias("first"))
    source = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    joined = own.withColumn("source", source).withColumn("h", h).join(head, "source", "left")
    begin = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(begin, rest).alias("turns"))


def _paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, chained digests of all turns and the bytes of each text."""

    def run(batches):
        for batch in batches:
            ids, depths, paths, sizes = batch["conv_id"], [], [], []
            for turns in batch["turns"].to_pylist():
                last, path = b"", []
                for turn in turns:
                    last = hashlib.sha256(last + turn["digest"]).digest()[:KEY]
                    path.append(last)
                depths.append(len(path))
                paths.append(b"".join(path))
                sizes.append([turn["bytes"] for turn in turns])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(depths, pa.int32()), pa.array(paths, pa.binary()),
                 pa.array(sizes, pa.list_(pa.int64()))],
                ["conv_id", "depth", "path", "sizes"],
            )

    return conversations.mapInArrow(
        run, "conv_id long, depth int, path binary, sizes array<long>"
    )


_LEVEL = (
    "path binary, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, sizes array<long>"
)
_DEEP = ["depth", "key", "parent", *(c.split()[0] for c in _LEVEL.split(", "))]


def _ended() -> list[Column]:
    """A conversation that ends at this depth, as a row to be merged."""
    zero = F.lit(0).cast("long")
    return [
        F.col("path"), F.col("conv_id"), (zero + 1).alias("n_convs"), zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), F.col("sizes"),
    ]


def _stripped() -> list[Column]:
    """A node without its last turn: a child to be merged one depth up."""
    kept = F.size("sizes") - 1
    return [
        F.substring("path", F.lit(1), kept * KEY).alias("path"),
        F.col("conv_id"),
        F.col("n_convs"),
        F.lit(1).cast("long").alias("n_children"),
        F.col("n_leaves"),
        F.col("saved_tokens"),
        F.slice("sizes", F.lit(1), kept).alias("sizes"),
    ]


def _merged(rows: DataFrame) -> DataFrame:
    """One row per path; all rows of a path add up on the map side first."""
    node = rows.groupBy("path", "sizes").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.sum("saved_tokens").alias("below"),
    )
    last = F.coalesce(F.try_element_at("sizes", F.lit(-1)), F.lit(0))
    return node.select(
        "path", "conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * last).alias("saved_tokens"), "sizes",
    )


def _key(at: Column) -> Column:
    """Digest of the first ``at`` turns of a path; empty for the root."""
    return F.when(at > 0, F.substring("path", (at - 1) * KEY + 1, F.lit(KEY))).otherwise(
        F.lit(b"")
    )


def _deep_nodes(deep: DataFrame, above: int) -> DataFrame:
    """Nodes deeper than ``above`` of few conversations, peeled subtree by subtree.

    A node has its own and its parent's digest; those that survive into depth
    ``above`` also have path and sizes.
    """

    def peel(table: pa.Table) -> pa.Table:
        rows = table.select(["conv_id", "depth", "path", "sizes"]).to_pylist()
        ended = {}
        for row in rows:
            ended.setdefault(row["depth"], []).append(row)
        nodes, alive, depth = [], {}, max(ended)
        while depth > above:
            at, here = slice((depth - 1) * KEY, depth * KEY), {}
            joining = [(r, r["conv_id"], 1, 0, 0, 0) for r in ended.get(depth, ())]
            for row, conv, n, kids, leaves, saved in joining + list(alive.values()):
                _, conv_, n_, kids_, leaves_, saved_ = here.get(
                    row["path"][at], (row, conv, 0, 0, 0, 0)
                )
                here[row["path"][at]] = (
                    row, min(conv, conv_), n + n_, kids + kids_, leaves + leaves_, saved + saved_
                )
            alive = {}
            for key, (row, conv, n, kids, leaves, saved) in here.items():
                leaves, saved = max(leaves, 1), saved + (n - 1) * row["sizes"][depth - 1]
                alive[key] = (row, conv, n, 1, leaves, saved)
                top = depth == above + 1
                nodes.append((
                    depth, key, row["path"][at.start - KEY : at.start] if depth > 1 else b"",
                    row["path"][: at.stop] if top else None, conv, n, kids, leaves, saved,
                    row["sizes"][:depth] if top else None,
                ))
            # survivors are children of what they are stripped to
            depth -= 1
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 5,
                 pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*nodes), types)], names=_DEEP)

    subtree = F.substring("path", 1, above * KEY)
    schema = f"depth int, key binary, parent binary, {_LEVEL}"
    return deep.withColumn("subtree", subtree).groupBy("subtree").applyInArrow(peel, schema)


def _lists_of_ended(ended: DataFrame) -> DataFrame:
    """``key`` and SHA-256 of the ascending ids of the conversations that end at a node.

    Ids are ordered over all tasks and joined to texts of bounded length where
    they lie; only these meet, and are hashed one after the other, so that a node
    where a third of all conversations end is neither one task's rows nor one
    value.
    """

    def joined(batches):
        key, first, said, held = None, None, [], 0

        def out():
            return pa.RecordBatch.from_pydict({
                "key": pa.array([key], pa.binary()), "first": [first], "said": [",".join(said)]
            })

        for batch in batches:
            for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
                if said and (k != key or held >= _LIST_BYTES):
                    yield out()
                    said, held = [], 0
                if not said:
                    key, first = k, c
                said.append(str(c))
                held += len(said[-1]) + 1
        if said:
            yield out()

    def hashed(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch["key"].to_pylist(), batch["said"].to_pylist()):
                if state is not None and k == key:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            if done:
                yield _digests(done)
        if state is not None:
            yield _digests([(key, state.hexdigest())])

    def _digests(rows):
        keys, digests = zip(*rows)
        return pa.RecordBatch.from_pydict({
            "ended_at": pa.array(keys, pa.binary()), "ends_sha256": pa.array(digests)
        })

    ids = ended.select(_key(F.col("depth")).alias("key"), "conv_id")
    texts = (
        ids.repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(joined, "key binary, first long, said string")
    )
    return (
        texts.repartition("key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(hashed, "ended_at binary, ends_sha256 string")
    )


def _steps(lengths: dict[int, int], few: int, least: int) -> int:
    """Greatest depth that takes a step of its own; -1 where there is nothing."""
    if not lengths:
        return -1
    deepest, longer = max(lengths), 0
    for depth in range(deepest, least, -1):
        longer += lengths.get(depth, 0)
        if longer > few:
            return depth
    return min(deepest, least)


def trie(conversations: DataFrame, few: int = FEW, least: int = LEAST) -> DataFrame:
    """One row per node of the trie of ``conv_id`` and ``turns`` (digest, bytes).

    ``conv_id`` is the smallest conversation that begins with the node's turns,
    ``depth`` their number (0 is the root), ``parent_conv_id`` the parent's
    ``conv_id`` (NULL for the root), ``n_convs`` the conversations below or at
    the node, ``n_children`` its children, ``n_leaves`` nodes without children
    in its subtree, ``saved_tokens`` the bytes that need not be repeated there,
    ``ends_sha256`` the digest of the ids of conversations that end at it.

    No conversations give no rows; conversations without turns are members of
    the root.  A repeated conversation counts as often as it is there.  A path
    of the upper depths is carried whole, so a node costs ``KEY`` + 8 bytes a
    turn there.
    """
    spark = conversations.sparkSession
    folder = fresh_folder(spark, "trie")
    _paths(conversations).write.partitionBy("depth").parquet(f"{folder}/ended")
    schema = "conv_id long, path binary, sizes array<long>, depth int"
    ended = spark.read.schema(schema).parquet(f"{folder}/ended")
    # one row per length that occurs
    lengths = {r["depth"]: r["count"] for r in ended.groupBy("depth").count().collect()}
    from_there = _steps(lengths, few, least)

    deep_schema = f"depth int, key binary, parent binary, {_LEVEL}"
    _deep_nodes(ended.where(F.col("depth") > from_there), from_there).write.parquet(
        f"{folder}/deep"
    )
    deep = spark.read.schema(deep_schema).parquet(f"{folder}/deep")
    below = deep.where(F.col("depth") == from_there + 1)
    for depth in range(from_there, -1, -1):
        here = ended.where(F.col("depth") == depth).select(*_ended())
        here = here.unionByName(below.select(*_stripped()))
        path = f"{folder}/nodes/depth={depth}"
        _merged(here).write.parquet(path)
        below = spark.read.schema(_LEVEL).parquet(path)
    if from_there < 0:
        nodes = spark.createDataFrame([], f"{_LEVEL}, depth int")
    else:
        nodes = spark.read.schema(f"{_LEVEL}, depth int").parquet(f"{folder}/nodes")
    depth = F.col("depth")
    keyed = nodes.withColumns(
        {"key": _key(depth), "parent": F.when(depth > 0, _key(depth - 1))}
    ).drop("path", "sizes")
    keyed = keyed.unionByName(deep.drop("path", "sizes"))
    parents = keyed.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    lists = _lists_of_ended(ended)
    return (
        keyed.join(parents, F.col("parent") == F.col("above"), "left")
        .join(lists, F.col("key") == F.col("ended_at"), "left")
        .select(
            "conv_id",
            depth.cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """Nodes of the rebuilt conversations of a table of turns.

    Turns go by ``turn``, NULL first; ties go by role and a digest of the text.
    NULL roles and texts are empty, repeated rows are turns of their own, and
    rows without ``conv_id`` belong to no conversation.  Other columns do not
    matter.  A conversation's turns meet in one task as digests.
    """
    return trie(rebuilt(conversations.select("conv_id", "turn", "role", "text")))
