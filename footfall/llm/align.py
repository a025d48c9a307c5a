"""Two tokenizers laid side by side: groups of tokens that cover the same bytes.

A text is a space and the document's text, in UTF-8.  Byte offsets at which a
token of either tokenizer ends cut both token sequences into groups; the last
tokens of a group, which end together, are linked.

Fragments form a monoid.  A fragment holds what is known from the tokens of some
consecutive chunks of a text: an open prefix up to the first common end, the
closed groups after it, and an open suffix behind the last common end.  Putting
two side by side closes what lies between them; how a long text is bracketed
does not matter.  Texts of one chunk are aligned where they are.  Longer ones
are cut into byte ranges, whose fragments are made in any task and put together
eight at a time.  A range begins at the first place after its offset that no
token can reach over; that place may differ for the two tokenizers, so tokens
near a border stay open until both sides are known.

Corpus-wide counts of linked pairs go by blocks of documents: a block sends each
distinct pair once, with its count, and gets totals back, so a pair that a third
of all links hold is one row a block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.byte_level import ByteLevel
from footfall.llm.common import texts
from footfall.sources import fresh_folder

CHUNK = 1 << 16  # bytes of a range
TOGETHER = 8  # fragments of a text that one step puts together
BLOCK_LINKS = 1 << 21  # links of a block of documents
_BLOCKS = 1 << 24  # blocks that a task may number

# White space after a printable ASCII character: no token reaches over such a place.
_CUT = {"a": re.compile(rb"(?<=[!-~])[ \n]"), "b": re.compile(rb"(?<=[!-~]) (?=[\s\S])")}
_SPACE = "▁"  # how pieces spell a space


@dataclass
class Open:
    """Tokens of both tokenizers with the byte offsets at which they end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Open) -> Open:
        mine, theirs = vars(self).values(), vars(other).values()
        return Open(*map(np.concatenate, zip(mine, theirs)))

    def within(self, after: int, up_to: int) -> Open:
        """Tokens that end in (after, up_to]."""
        out = []
        for ids, end in ((self.a, self.a_end), (self.b, self.b_end)):
            low, high = np.searchsorted(end, (after, up_to), "right")
            out += [ids[low:high], end[low:high]]
        return Open(*out)


_NONE = np.zeros(0, np.int64)
NOTHING = Open(_NONE, _NONE, _NONE, _NONE)


@dataclass
class Fragment:
    """``closed`` says that there is a common end; without one, all is in ``head``."""

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    closed: bool = False
    head: Open = field(default_factory=lambda: NOTHING)
    text: bytes = b""
    groups: int = 0
    links: np.ndarray = field(default_factory=lambda: _NONE)
    tail: Open = field(default_factory=lambda: NOTHING)


class Aligner:
    """Fragments of texts by a byte-level BPE file (a) and a piece model (b)."""

    def __init__(self, bpe_file: str, piece_file: str):
        import sentencepiece

        self.bpe = ByteLevel(bpe_file, special=False)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        a_bytes = self.bpe.token_bytes()
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        self.b_bytes = [self._bytes(i, name) for i, name in enumerate(names)]
        self.a_size = np.array([len(x) for x in a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.n_right = len(names)
        # a piece with a space after another letter would reach over cuts
        self.cuttable = not any(_SPACE in name.lstrip(_SPACE) for name in names)
        self.ids = max(len(a_bytes), len(names))
        self.spelled = [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(self.ids)]

    def _bytes(self, i: int, name: str) -> bytes:
        if self.pieces.is_byte(i):
            return bytes([int(name[3:5], 16)])
        plain = not (self.pieces.is_control(i) or self.pieces.is_unknown(i))
        return name.replace(_SPACE, " ").encode() if plain else b""

    def ranges(self, text: bytes, kind: str, chunk: int) -> list[bytes]:
        """What each byte range of a text gives one tokenizer; some may get nothing."""
        count = -(-len(text) // chunk)
        cuts = [0]
        for i in range(1, count):
            found = _CUT[kind].search(text, max(i * chunk, cuts[-1])) if self.cuttable else None
            cuts.append(found.start() if found else len(text))
        return [text[x:y] for x, y in zip(cuts, [*cuts[1:], len(text)])]

    def fragment(self, a_part: bytes, a_at: int, b_part: bytes, b_at: int) -> Fragment:
        """The fragment of a range whose parts begin at these offsets.

        ``b_part`` is empty or begins with the space that the piece model adds.
        """
        a = self.bpe.ids(a_part.decode()).astype(np.int64) if a_part else _NONE
        b_list = self.pieces.encode(b_part[1:].decode(), num_threads=1) if b_part else []
        b = np.array(b_list, np.int64)
        a_end, b_end = a_at + self.a_size[a].cumsum(), b_at + self.b_size[b].cumsum()
        whole = len(a_part) == (a_end[-1] - a_at if len(a) else 0)
        if not whole or b"".join(map(self.b_bytes.__getitem__, b_list)) != b_part:
            return Fragment(ok=False)
        out = self._of(Open(a, a_end, b, b_end))
        out.n_a, out.n_b = len(a), len(b)
        return out

    def _of(self, tokens: Open) -> Fragment:
        common = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)
        if not len(common):
            return Fragment(head=tokens)
        text, links = self._groups(tokens.within(common[0], common[-1]), common[1:])
        return Fragment(
            closed=True,
            head=tokens.within(-1, common[0]),
            text=text,
            groups=len(common) - 1,
            links=links,
            tail=tokens.within(common[-1], np.iinfo(np.int64).max),
        )

    def _groups(self, tokens: Open, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Closed groups as text with a stop behind each, and their linked pairs."""
        if not len(ends):
            return b"", _NONE
        a_last = np.searchsorted(tokens.a_end, ends)
        b_last = np.searchsorted(tokens.b_end, ends)
        a_group = np.searchsorted(ends, tokens.a_end)
        b_group = np.searchsorted(ends, tokens.b_end)
        b_before = np.concatenate([[0], b_last[:-1] + 1])
        said = np.empty(len(tokens.a) + len(tokens.b), np.int64)
        a_place = np.arange(len(tokens.a)) + b_before[a_group]
        b_place = np.arange(len(tokens.b)) + a_last[b_group] + 1
        said[a_place], said[b_place] = tokens.a, tokens.b
        said[a_place[a_last]] += self.ids
        said[b_place[b_last]] += 2 * self.ids
        text = b"".join(map(self.spelled.__getitem__, said.tolist()))
        return text, tokens.a[a_last] * self.n_right + tokens.b[b_last]

    def join(self, x: Fragment, y: Fragment) -> Fragment:
        """Two neighbours as one; associative."""
        out = Fragment(x.ok and y.ok, x.n_a + y.n_a, x.n_b + y.n_b)
        if not out.ok:
            return Fragment(ok=False)
        between = self._of((x.tail if x.closed else x.head) + y.head)
        if not between.closed:
            if x.closed:
                between = Fragment(closed=True, head=x.head, text=x.text, groups=x.groups,
                                   links=x.links, tail=between.head)
            out.closed, out.head = between.closed, between.head
            out.text, out.groups, out.links = between.text, between.groups, between.links
            out.tail = between.tail
            return out
        parts = [between]
        out.closed, out.head, out.tail = True, between.head, between.tail
        if x.closed:
            text, links = self._shut(between.head)
            parts = [x, Fragment(text=text, groups=1, links=links), between]
            out.head = x.head
        if y.closed:
            parts.append(y)
            out.tail = y.tail
        out.text = b"".join(p.text for p in parts)
        out.groups = sum(p.groups for p in parts)
        out.links = np.concatenate([p.links for p in parts])
        return out

    def _shut(self, tokens: Open) -> tuple[bytes, np.ndarray]:
        """Open tokens that end together, as one group."""
        return self._groups(tokens, tokens.a_end[-1:])

    def finish(self, whole: Fragment) -> Fragment:
        """The fragment of a whole text: all its groups are closed."""
        if not whole.ok or not whole.closed:
            return Fragment(ok=False)
        text, links = self._shut(whole.head)
        return Fragment(
            n_a=whole.n_a, n_b=whole.n_b, closed=True, text=(text + whole.text)[:-1],
            groups=whole.groups + 1, links=np.concatenate([links, whole.links]),
        )


@lru_cache(maxsize=2)
def _aligner(bpe_file: str, piece_file: str) -> Aligner:
    return Aligner(bpe_file, piece_file)


_OPEN = [f"{side}_{name}" for side in ("head", "tail") for name in ("a", "a_end", "b", "b_end")]
_FRAGMENT = (
    "ok boolean, n_a long, n_b long, closed boolean, text binary, groups long, "
    "links array<long>, " + ", ".join(f"{c} array<long>" for c in _OPEN)
)
_LONGS = pa.list_(pa.int64())


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([_NONE, *values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _pack(fragments: list[Fragment]) -> dict[str, pa.Array]:
    out = {
        "ok": pa.array([f.ok for f in fragments], pa.bool_()),
        "n_a": pa.array([f.n_a for f in fragments], pa.int64()),
        "n_b": pa.array([f.n_b for f in fragments], pa.int64()),
        "closed": pa.array([f.closed for f in fragments], pa.bool_()),
        "text": pa.array([f.text for f in fragments], pa.binary()),
        "groups": pa.array([f.groups for f in fragments], pa.int64()),
        "links": _lists([f.links for f in fragments]),
    }
    for name in _OPEN:
        side, part = name.split("_", 1)
        out[name] = _lists([getattr(getattr(f, side), part) for f in fragments])
    return out


def _unpack(batch: pa.RecordBatch | pa.Table) -> Iterator[Fragment]:
    for row in batch.to_pylist():
        sides = {
            side: Open(*(np.array(row[c], np.int64) for c in _OPEN if c.startswith(side)))
            for side in ("head", "tail")
        }
        links = np.array(row["links"], np.int64)
        plain = {k: row[k] for k in ("ok", "n_a", "n_b", "closed", "text", "groups")}
        yield Fragment(**plain, links=links, **sides)


def _few(batches: Iterable[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _whole(aligner: Aligner, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, Fragment]]:
    """Ids and finished fragments of texts that are no longer than a chunk."""
    for few in _few(batches):
        for doc, text in zip(few["doc_id"].to_pylist(), few["text"].to_pylist()):
            if text:
                data = b" " + text.encode()
                yield doc, aligner.finish(aligner.fragment(data, 0, data, 0))
            else:
                yield doc, Fragment(ok=False)


def _long_texts(docs: DataFrame, bpe_file: str, piece_file: str, chunk: int) -> DataFrame:
    """``doc_id`` and the one fragment of every text that is longer than a chunk.

    Ranges are dealt over tasks by (row, range) and their fragments are stored.
    How many steps put them together follows from the longest text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        aligner = _aligner(bpe_file, piece_file)
        for few in _few(batches, 1):
            text = b" " + few["text"][0].as_py().encode()
            a_parts, b_parts = (aligner.ranges(text, k, chunk) for k in "ab")
            n = len(a_parts)
            same = pa.array(np.zeros(n, np.int64))
            starts = [np.cumsum([0, *map(len, p[:-1])]) for p in (a_parts, b_parts)]
            yield pa.RecordBatch.from_arrays(
                [few["row"].take(same), few["doc_id"].take(same), pa.array(np.arange(n)),
                 pa.array(a_parts, pa.binary()), pa.array(starts[0]),
                 pa.array(b_parts, pa.binary()), pa.array(starts[1])],
                ["row", "doc_id", "range", "a_part", "a_at", "b_part", "b_at"],
            )

    def make(batches):
        aligner = _aligner(bpe_file, piece_file)
        for few in _few(batches, 8):
            made = _pack([
                aligner.fragment(r["a_part"], r["a_at"], r["b_part"], r["b_at"])
                for r in few.select(["a_part", "a_at", "b_part", "b_at"]).to_pylist()
            ])
            yield pa.RecordBatch.from_pydict(
                {c: few[c] for c in ("row", "doc_id", "range")} | made
            )

    def put_together(table: pa.Table) -> pa.Table:
        aligner, whole = _aligner(bpe_file, piece_file), None
        table = table.sort_by("range")
        for part in _unpack(table):
            whole = part if whole is None else aligner.join(whole, part)
        first = table.slice(0, 1)
        ranges = pa.array([first["range"][0].as_py() // TOGETHER])
        return pa.table(
            {"row": first["row"].combine_chunks(), "doc_id": first["doc_id"].combine_chunks(),
             "range": ranges} | _pack([whole])
        )

    keys = f"row long, doc_id {kind}, range long, "
    ranged = (
        docs.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(cut, keys + "a_part binary, a_at long, b_part binary, b_at long")
        .repartition("row", "range")
        .mapInArrow(make, keys + _FRAGMENT)
    )
    path = fresh_folder(docs.sparkSession, "fragments")
    ranged.write.parquet(path)
    fragments = docs.sparkSession.read.schema(ranged.schema).parquet(path)
    most = (fragments.agg(F.max("range")).first()[0] or 0) + 1
    while most > 1:
        eighth = F.floor(F.col("range") / TOGETHER)
        fragments = fragments.groupBy("row", eighth).applyInArrow(put_together, keys + _FRAGMENT)
        most = -(-most // TOGETHER)
    return fragments.drop("row", "range")


def _split(docs: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    plain = texts(docs)
    length = F.octet_length("text") + 1
    return plain.where(length <= chunk), plain.where(length > chunk)


def align(
    docs: DataFrame, bpe_file: str, piece_file: str, chunk: int = CHUNK
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups`` and ``groups`` of every document.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of both tokenizers, group after
    group.  NULL and empty texts have no tokens, and neither have texts that a
    tokenizer does not give back byte by byte (such as one that holds the sign
    the pieces spell a space with): zeros and ''.  Special strings inside texts
    are ordinary text.

    Rows with NULL or repeated ids are documents of their own; other columns of
    ``docs`` do not matter; no documents give no rows.  A text is one value of
    the result.  A stretch without white space is tokenized in one task, as
    merges may reach over all of it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups string"

    def rows(made, kind):
        for doc, f in made:
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([doc], kind), "n_a": [f.n_a], "n_b": [f.n_b],
                "n_groups": [f.groups], "groups": [f.text.decode()],
            })

    def short_ones(batches):
        for batch in batches:
            yield from rows(
                _whole(_aligner(bpe_file, piece_file), [batch]), batch["doc_id"].type
            )

    def long_ones(batches):
        for few in _few(batches, 1):
            yield from rows(_finished(bpe_file, piece_file, [few]), few["doc_id"].type)

    short, long = _split(docs, chunk)
    joined = _long_texts(long, bpe_file, piece_file, chunk)
    return short.mapInArrow(short_ones, schema).unionAll(joined.mapInArrow(long_ones, schema))


def _finished(bpe_file: str, piece_file: str, batches) -> Iterator[tuple[Any, Fragment]]:
    aligner = _aligner(bpe_file, piece_file)
    for few in _few(batches, 8):
        for doc, whole in zip(few["doc_id"].to_pylist(), _unpack(few)):
            yield doc, aligner.finish(whole)


_DOCUMENT = "n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def _in_blocks(
    made: Iterator[tuple[Any, Fragment]], kind: pa.DataType, first: int, step: int, most: int
) -> Iterator[pa.RecordBatch]:
    """Documents with their links as places among the distinct pairs of their block.

    The first row of a block also has those pairs and how many links hold each.
    """
    number, rows, held = first, [], 0

    def block() -> pa.RecordBatch:
        docs, n_a, n_b, groups, digests, links = zip(*rows)
        pairs, places, times = np.unique(
            np.concatenate(links), return_inverse=True, return_counts=True
        )
        places = places.astype("<i4")
        ends = np.cumsum([0, *map(len, links)])
        # only the first row has the pairs
        offsets = pa.array(np.minimum(np.arange(len(rows) + 1), 1) * len(pairs), pa.int32())
        missing = pa.array(np.arange(len(rows)) > 0)
        return pa.RecordBatch.from_pydict({
            "block": pa.array(np.full(len(rows), number)),
            "doc_id": pa.array(docs, kind),
            "n_a": pa.array(n_a, pa.int64()),
            "n_b": pa.array(n_b, pa.int64()),
            "n_groups": pa.array(groups, pa.int64()),
            "groups_sha256": pa.array(digests, pa.string()),
            "links": pa.array([places[x:y].tobytes() for x, y in zip(ends, ends[1:])]),
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(pairs), mask=missing),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times), mask=missing),
        })

    for doc, f in made:
        digest = hashlib.sha256(f.text).hexdigest() if f.ok else ""
        rows.append((doc, f.n_a, f.n_b, f.groups, digest, f.links))
        held += len(f.links) + 64
        if held >= most:
            yield block()
            number, rows, held = number + step, [], 0
    if rows:
        yield block()


def _stored(
    docs: DataFrame, bpe_file: str, piece_file: str, chunk: int, block_links: int
) -> DataFrame:
    """Aligned documents in blocks, written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_id {kind}, {_DOCUMENT}, pairs array<long>, times array<long>"

    def blocked(parity: int, made):
        def run(batches):
            batches = iter(batches)
            first = next((b for b in batches if b.num_rows), None)
            if first is None:
                return
            part, kind = first["part"][0].as_py(), first["doc_id"].type

            def every():
                yield first
                yield from batches

            number = part * _BLOCKS + parity
            yield from _in_blocks(made(every()), kind, number, 2, block_links)

        return run

    part = F.spark_partition_id().alias("part")
    short, long = _split(docs, chunk)
    joined = _long_texts(long, bpe_file, piece_file, chunk)
    from_short = blocked(0, lambda batches: _whole(_aligner(bpe_file, piece_file), batches))
    from_long = blocked(1, lambda batches: _finished(bpe_file, piece_file, batches))
    made = short.select("*", part).mapInArrow(from_short, schema).unionAll(
        joined.select("*", part).mapInArrow(from_long, schema)
    )
    path = fresh_folder(docs.sparkSession, "aligned")
    made.write.parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def link_counts(
    docs: DataFrame,
    bpe_file: str,
    piece_file: str,
    chunk: int = CHUNK,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """Every document with figures of its links, by their counts in all documents.

    ``n_links`` are its links, ``count_sum`` adds up how many links of all
    documents hold the pair of each, and ``n_best`` are those whose pair no
    other pair of the same piece exceeds.  ``groups_sha256`` is the digest of
    ``groups`` as ``align`` gives it, '' for documents without tokens.  Rows
    without tokens, odd rows and long texts are handled as there.
    """
    stored = _stored(docs, bpe_file, piece_file, chunk, block_links)
    pieces = _vocabulary(piece_file)
    each = stored.where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("pairs", "times")).alias("x")
    )
    each = each.select("block", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("n"))
    # at most one row per token of the first tokenizer stands beside a piece
    highest = F.max("n").over(Window.partitionBy(F.pmod("pair", F.lit(pieces))))
    counts = counts.withColumn("best", F.col("n") == highest)
    asked = each.select(F.col("block").alias("asked_by"), "pair")
    answers = asked.join(counts, "pair").select("asked_by", "pair", "n", "best")

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string"
    )

    def looked_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("pair")
        n, best = (found[c].to_numpy().astype(np.int64) for c in ("n", "best"))
        sums = []
        for places in rows["links"].to_pylist():
            at = np.frombuffer(places, "<i4")
            sums.append((len(at), int(best[at].sum()), int(n[at].sum())))
        links, bests, totals = zip(*sums)
        return pa.table({
            "doc_id": rows["doc_id"], "n_a": rows["n_a"], "n_b": rows["n_b"],
            "n_groups": rows["n_groups"], "n_links": list(links),
            "n_best": list(bests), "count_sum": list(totals), "groups_sha256": rows["groups_sha256"],
        })

    linked = stored.drop("pairs", "times").groupBy("block").cogroup(answers.groupBy("asked_by"))
    return linked.applyInArrow(looked_up, schema)


@lru_cache(maxsize=2)
def _vocabulary(piece_file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file).vocab_size()
