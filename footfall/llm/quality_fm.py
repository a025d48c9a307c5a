"""Quality classifier: a factorisation machine over words and structure.

Inputs of a text are its hashed words (counts, scaled to length one), a few
statistics of its structure, and the stated size of the document (``n_chars``)
against that of its text.  The score is the logistic function of
bias + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, and the pairs are summed
in linear time as half of (sum v_i x_i)^2 - sum (v_i x_i)^2 per factor.

The model is fitted in numpy on a bounded sample of labelled rows and is a few
hundred kilobytes, whatever the corpus; scoring is one pass without a shuffle.
Of the sample only inputs reach the driver, never texts: a row has at most
2^WORD_BITS words and the statistics, six bytes each, so 6,000 rows are below
300 MB however long their texts are.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WordHashes

WORD_BITS = 13
FACTORS = 6
TRAIN_ROWS = 6000  # labelled rows that are fitted on, at most
EPOCHS = 12
STEPS = 1500  # at least; few rows are gone over more often
RATE = 0.1
DECAY = 1e-4
SEED = 11

# Structure statistics, in order; all are shares or squashed to about 0 .. 1.
STATS = (
    "symbols", "separators", "exclaimed", "capitals", "digits", "blanks", "line_rate",
    "same_as_last", "distinct", "short", "size", "stated_size",
)
_SYMBOLS, _CAPITALS = b"#*$%&<>", bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_WORDS = WordHashes(seed=2)


def _stats(text: bytes, words: list[bytes], stated: float | None) -> tuple[float, ...]:
    n, size = max(1, len(words)), max(1, len(text))

    def share(of: bytes) -> float:
        return (len(text) - len(text.translate(None, of))) / size

    return (
        min(1.0, share(_SYMBOLS) * 4),
        min(1.0, text.count(b"|") / n * 2),
        min(1.0, text.count(b"!") / n),
        min(1.0, share(_CAPITALS) * 2),
        min(1.0, share(_DIGITS) * 4),
        text.count(b" ") / size,
        min(1.0, text.count(b"\n") / n * 4),
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        1.0 / (1.0 + len(words) / 16),
        min(1.0, np.log1p(len(words)) / 12),
        0.5 if stated is None else min(1.0, max(0.0, stated) / (size + max(0.0, stated))),
    )


Inputs = tuple[np.ndarray, np.ndarray, np.ndarray]


def features(batch: list[bytes], stated: list[float | None] | None = None) -> Inputs:
    """Row, feature and value of everything that is not zero in a batch of texts.

    ``stated`` has the documents' own figures of their sizes, None where unknown.
    """
    stated = stated or [None] * len(batch)
    width = 1 << WORD_BITS
    keys, stats = [], np.empty((len(batch), len(STATS)))
    for row, text in enumerate(batch):
        words = text.lower().split()
        keys.append((_WORDS.of(words) % np.uint64(width)).astype(np.int64) + row * width)
        stats[row] = _stats(text, words, stated[row])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row, value = key // width, np.sqrt(count)
    norm = np.sqrt(np.bincount(row, value * value, len(batch)))
    rows = np.concatenate([row, np.repeat(np.arange(len(batch)), len(STATS))])
    columns = np.concatenate([key % width, np.tile(width + np.arange(len(STATS)), len(batch))])
    return rows, columns, np.concatenate([value / norm[row], stats.ravel()])


@dataclass
class Machine:
    """Bias, linear weights and factors."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int):
        """Raw scores of ``n`` rows, and the factor sums that a gradient needs."""
        out = self.bias + np.bincount(rows, self.linear[columns] * values, n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            each = self.factors[columns, f] * values
            sums[:, f] = np.bincount(rows, each, n)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(rows, each * each, n))
        return out, sums

    def scores(self, batch: list[bytes], stated: list[float | None] | None = None) -> np.ndarray:
        if not batch:
            return np.empty(0)
        margins, _ = self.margins(*features(batch, stated), len(batch))
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def fit(inputs: Inputs, labels: np.ndarray) -> Machine:
    """Fit by AdaGrad on log loss; without rows of both labels, the prior alone.

    ``inputs`` are those of ``features``, with rows numbered like ``labels``.
    """
    random = np.random.default_rng(SEED)
    width = (1 << WORD_BITS) + len(STATS)
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(width), random.normal(0, 0.05, (width, FACTORS))
    )
    if len(set(labels.tolist())) < 2:
        return machine
    rows, columns, values = inputs
    order = np.argsort(rows, kind="stable")
    rows, columns, values = rows[order], columns[order], values[order]
    edges = np.searchsorted(rows, np.arange(len(labels) + 1))
    seen_bias, seen_linear = 1.0, np.ones(width)
    seen_factors = np.ones((width, FACTORS))
    for _ in range(max(EPOCHS, -(-STEPS * 64 // len(labels)))):
        for chosen in np.array_split(random.permutation(len(labels)), max(1, len(labels) // 64)):
            at = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in chosen])
            row = np.repeat(np.arange(len(chosen)), edges[chosen + 1] - edges[chosen])
            column, value = columns[at], values[at]
            margin, sums = machine.margins(row, column, value, len(chosen))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
            step = error.mean()
            seen_bias += step * step
            machine.bias -= RATE * step / np.sqrt(seen_bias)
            used, place = np.unique(column, return_inverse=True)
            each = error[row] * value
            grad = np.bincount(place, each, len(used)) / len(chosen) * 8
            grad += DECAY * machine.linear[used]
            seen_linear[used] += grad * grad
            machine.linear[used] -= RATE * grad / np.sqrt(seen_linear[used])
            for f in range(FACTORS):
                own = machine.factors[column, f] * value
                grad = np.bincount(place, each * (sums[row, f] - own), len(used)) / len(chosen) * 8
                grad += DECAY * machine.factors[used, f]
                seen_factors[used, f] += grad * grad
                machine.factors[used, f] -= RATE * grad / np.sqrt(seen_factors[used, f])
    return machine


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, text as bytes (NULL as empty) and the stated size, if there is a number."""
    known = "n_chars" in docs.columns
    stated = F.col("n_chars").try_cast("double") if known else F.lit(None).cast("double")
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select("doc_id", text, F.nanvl(stated, F.lit(None)).alias("stated"))


def _inputs(rows: DataFrame) -> DataFrame:
    """Inputs of each row in two byte strings, in place of its text."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                row, column, value = features(part["text"].to_pylist(), part["stated"].to_pylist())
                order = np.argsort(row, kind="stable")
                edges = np.searchsorted(row[order], np.arange(1, part.num_rows))
                columns = np.split(column[order].astype("<u2"), edges)
                values = np.split(value[order].astype("<f4"), edges)
                kept = [part[c] for c in ("doc_id", "__key", "__label")]
                packed = [pa.array([x.tobytes() for x in each], pa.binary())
                          for each in (columns, values)]
                yield pa.RecordBatch.from_arrays(
                    kept + packed, ["doc_id", "__key", "__label", "columns", "values"]
                )

    kind, label = (rows.schema[c].dataType.simpleString() for c in ("doc_id", "__label"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, __key binary, __label {label}, columns binary, values binary"
    )


def train(docs: DataFrame, labels: DataFrame, use: Column, limit: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``limit`` rows of ``labels`` that ``use`` admits.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1; others are ignored), and
    ``use`` is a condition on its ``doc_id``.  Ids are chosen by a hash, and of
    an id with several texts the one with the least hash of text and size is
    taken, so the choice does not depend on the order of rows.  An id labelled
    more than once has its highest label.  NULL ids have no label, NULL texts
    are empty, texts are read whole, and further columns are not looked at.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & use)
        .groupBy("doc_id")
        .agg(F.max("quality").alias("__label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    rows = _rows(docs).withColumn(
        "__key", F.unhex(F.md5(F.concat("text", F.coalesce(F.col("stated").cast("string"), F.lit("")).cast("binary"))))
    )
    made = _inputs(rows.join(F.broadcast(chosen), "doc_id"))
    one = made.groupBy("doc_id").agg(
        F.min(F.struct("__key", "__label", "columns", "values")).alias("__one")
    )
    sample = one.select("doc_id", "__one.*").orderBy("doc_id").toArrow()
    columns = [np.frombuffer(x, "<u2") for x in sample["columns"].to_pylist()]
    values = [np.frombuffer(x, "<f4") for x in sample["values"].to_pylist()]
    row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    inputs = (
        row,
        np.concatenate([*columns, np.empty(0, "<u2")]).astype(np.int64),
        np.concatenate([*values, np.empty(0, "<f4")]).astype(float),
    )
    return fit(inputs, np.array(sample["__label"].to_pylist(), float))


def score(docs: DataFrame, machine: Machine, *keep: Column) -> DataFrame:
    """``doc_id``, ``score`` and ``keep`` (made of these two) of every row.

    NULL text is scored as empty, texts of any length are read whole, repeated
    rows are scored each, and an empty table gives none.  Of further columns
    only ``n_chars`` is read, as a number where it is one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores = shared.value.scores(part["text"].to_pylist(), part["stated"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(scores)], ["doc_id", "score"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(run, f"doc_id {kind}, score double").select("*", *keep)
