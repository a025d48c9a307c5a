"""Documents packed into token sequences by the sum-of-squares rule.

Every task packs the documents of its own partition as they come: nothing is
shuffled, no document is known in advance and no key can be hot.  A document is
cut into whole sequences first.  What is left of it goes to the fill level that
makes the sum of squared numbers of partly filled windows least, which keeps
windows of many levels at hand so that later rests find one that they fill.
One array holds how many windows are at each level.

At most ``MOST_OPEN`` windows are open in a task.  Beyond that, the next rest is
cut at the end of the fullest one.  When a task's documents end, the emptiest
windows are cut up to fill the others, and the last window is cut into powers of
two, so that no sequence needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.byte_level import byte_level
from footfall.llm.common import texts

SIZE = 2048
END_ID = 1
MOST_OPEN = 1024  # windows of a task, of 4 bytes a token
_TASK = 1 << 40  # sequences that a task may number


@dataclass
class Piece:
    """Consecutive ids of one document from ``start`` on."""

    doc: Any
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.doc_tokens),
            Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens),
        )


@dataclass
class Sequence:
    """Pieces that follow each other without a gap."""

    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)


class SumOfSquares:
    """Online packing into windows of one size; yields sequences when they are done."""

    def __init__(self, size: int = SIZE, most_open: int = MOST_OPEN):
        self.size, self.most_open = size, most_open
        self.levels = np.zeros(size + 1, np.int64)  # open windows at each fill
        self.at: list[list[Sequence]] = [[] for _ in range(size)]
        self.open = 0

    def choose(self, length: int) -> int:
        """Fill level to put a rest on: 0 is a new window, ties go to the fullest.

        Moving a window from level h to h + length changes the sum of squares by
        2 * (N[h + length] - N[h]) + 2, by one less where it is full and gone,
        and a new window by 2 * N[length] + 1.
        """
        room = self.size - length
        fits = np.flatnonzero(self.levels[1 : room + 1]) + 1
        if not len(fits):
            return 0
        change = 2 * (self.levels[fits + length] - self.levels[fits]) + 2
        change -= fits == room
        best = len(fits) - 1 - int(np.argmin(change[::-1]))
        return int(fits[best]) if change[best] <= 2 * self.levels[length] + 1 else 0

    def _take(self, level: int) -> Sequence:
        if not level:
            return Sequence()
        self.levels[level] -= 1
        self.open -= 1
        return self.at[level].pop()

    def _keep(self, window: Sequence) -> None:
        self.levels[window.fill] += 1
        self.open += 1
        self.at[window.fill].append(window)

    def put(self, piece: Piece) -> Iterator[Sequence]:
        """Place all ids of a document."""
        while len(piece.ids) >= self.size:
            whole, piece = piece.cut(self.size)
            yield Sequence([whole], self.size)
        if not len(piece.ids):
            return
        level = self.choose(len(piece.ids))
        if not level and self.open >= self.most_open:
            level = int(np.flatnonzero(self.levels)[-1])
            if level + len(piece.ids) > self.size:
                first, piece = piece.cut(self.size - level)
                window = self._take(level)
                window.add(first)
                yield window
                level = 0
        window = self._take(level)
        window.add(piece)
        if window.fill == self.size:
            yield window
        else:
            self._keep(window)

    def finish(self) -> Iterator[Sequence]:
        """Close what is open: emptiest windows fill the fullest, the last is cut."""
        left = [window for level in reversed(self.at) for window in level]
        self.__init__(self.size, self.most_open)
        while len(left) > 1:
            into, giver = left[0], left[-1]
            piece = giver.pieces.pop()
            giver.fill -= len(piece.ids)
            room = self.size - into.fill
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                giver.add(rest)
            into.add(piece)
            if into.fill == self.size:
                yield left.pop(0)
            if not giver.fill:
                left.pop()
        for window in left:
            yield from _powers_of_two(window)


def _powers_of_two(window: Sequence) -> Iterator[Sequence]:
    """Sequences of lengths that are different powers of two, longest first."""
    waiting, left = window.pieces[::-1], window.fill
    while left:
        length = 1 << (left.bit_length() - 1)
        part = Sequence()
        while part.fill < length:
            piece = waiting.pop()
            if len(piece.ids) > length - part.fill:
                piece, rest = piece.cut(length - part.fill)
                waiting.append(rest)
            part.add(piece)
        left -= length
        yield part


def _rows(sequences: list[tuple[int, Sequence]], kind: pa.DataType) -> pa.RecordBatch:
    rows = []
    for number, sequence in sequences:
        offset = 0
        for p in sequence.pieces:
            n = len(p.ids)
            rows.append((p.doc, p.start, n, p.ids.tobytes(), p.doc_tokens, number, offset))
            offset += n
    long = pa.int64()
    types = (kind, long, long, pa.binary(), long, long, long)
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=list(_COLUMNS)
    )


_COLUMNS = {
    "doc_id": None,
    "start": "long",
    "length": "long",
    "ids": "binary",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
}


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SIZE,
    end_id: int = END_ID,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """One row per piece of a document, with the sequence that holds it.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` is the number
    of the document's ids before them and ``offset`` their place in the
    sequence.  A document's ids are those of its whole text and the end id.
    Sequences have ``size`` ids, or a smaller power of two.  ``sequence_id``
    begins with the number of the task.

    NULL and empty texts are the end id alone.  Each row is a document of its
    own, whatever its id: NULL ids and repeated rows are packed like any other.
    Very long texts are encoded whole and span many sequences.  Other columns of
    ``docs`` do not matter.  No documents give no rows.
    """

    def run(batches):
        encoder, packer, number = byte_level(tokenizer), SumOfSquares(size, most_open), 0
        end, done, kind = np.array([end_id], np.uint32), [], None
        for batch in batches:
            kind = batch["doc_id"].type
            if number == 0 and batch.num_rows:
                number = batch["part"][0].as_py() * _TASK
            for first in range(0, batch.num_rows, 64):
                few = batch.slice(first, 64)
                for doc, text in zip(few["doc_id"].to_pylist(), few["text"].to_pylist()):
                    ids = np.concatenate([encoder.ids(text), end]).astype("<u4", copy=False)
                    for sequence in packer.put(Piece(doc, 0, ids, len(ids))):
                        done.append((number, sequence))
                        number += 1
                yield _rows(done, kind)
                done = []
        if kind is not None:
            yield _rows([(number + i, s) for i, s in enumerate(packer.finish())], kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"{name} {t or kind}" for name, t in _COLUMNS.items())
    return texts(docs).withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a crc32 in the place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
