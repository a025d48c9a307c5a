"""Scoring with a word n-gram model as a weighted backoff automaton.

Documents are dealt into blocks of bounded size.  Counting sends, for each
block, its distinct n-grams as sorted 64-bit hashes with their counts in
training documents, cut into ranges of the hash; a range adds up all blocks
and answers each with the totals of exactly the n-grams it asked for, in order.
So no n-gram is a hot key (it comes once per block), no model is broadcast,
and what moves grows with the text.  Blocks are dealt by id and text and equal
rows are counted in the JVM before Python reads them, so neither a NULL id nor a
row repeated without end makes a block large.  There are as many ranges and
partitions as blocks, so both keep their size however large the corpus is.

From its answers a block builds its part of the automaton: a state for every
known context, an arc for every known n-gram with its log-probability, and a
failure arc from each state to the next shorter context with the weight that
is left for unseen words.  Probabilities are interpolated with a Dirichlet
prior, P(w|h) = (c(hw) + m P(w|h')) / (c(h) + m), down to add-one unigrams, so
each state's probabilities sum to one.  Of a few values of m, the one is taken
under which the training tokens are likeliest when each is left out of its own
counts; all are scored in one pass, so choosing costs no further one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WordHashes, blocks, mix, texts
from footfall.sources import fresh_folder

BLOCK_CHARS = 8_000_000
END = 0x5BD1E9955BD1E995  # the end token; words hash to 64 bits of their own
ORDER = 2
PRIORS = (4.0, 64.0, 1024.0, 16384.0, 1048576.0)


@dataclass
class Block:
    """The tokens of a block's documents, one document after the other.

    ``weight`` is how many equal training rows a token stands for, or 0.
    """

    tokens: np.ndarray
    lengths: np.ndarray
    weight: np.ndarray

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n-gram that ends at each token, and whether there is one."""
        hashed, inside = self.tokens, np.ones(len(self.tokens), bool)
        first = np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        place = np.arange(len(self.tokens)) - first
        for back in range(1, order):
            earlier = np.empty_like(self.tokens)
            earlier[back:] = self.tokens[: len(self.tokens) - back]
            earlier[:back] = 0
            hashed = mix(earlier, hashed)
            inside = place >= order - 1
        return hashed, inside


_WORDS = WordHashes(seed=7)


def read_block(table: pa.Table) -> Block:
    """Split texts at ASCII blanks, lower-case A-Z, and add an end to each."""
    text = table["text"].to_pylist()
    weight = np.where(table["train"].to_numpy(), table["copies"].to_numpy(), 0)
    end = np.array([END], np.uint64)
    parts, lengths = [], []
    for value in text:
        words = value.lower().split()
        parts += [_WORDS.of(words), end]
        lengths.append(len(words) + 1)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return Block(flat, np.array(lengths, np.int64), np.repeat(weight, lengths))


def _distinct(block: Block, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams, each token's index among them (-1: none), training counts."""
    hashed, inside = block.grams(order)
    unique, inverse = np.unique(hashed[inside], return_inverse=True)
    counts = np.bincount(inverse, weights=block.weight[inside], minlength=len(unique))
    index = np.full(len(hashed), -1, np.int64)
    index[inside] = inverse
    return unique, index, counts.astype(np.int64)


def _ranges(unique: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of the hash that a sorted list reaches, and where each starts and ends."""
    parts, starts = np.unique(unique >> np.uint64(64 - bits), return_index=True)
    return parts, np.append(starts, len(unique))


def _sorted_rows(table: pa.Table) -> pa.Table:
    """The group's rows in one order, however they arrived."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _dealt(docs: DataFrame, train: Column, n: int) -> DataFrame:
    """Distinct rows of ``doc_id``, ``text`` (bytes) and ``train`` with ``copies`` and block."""
    rows = texts(docs, train.alias("train")).select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"),
        "doc_id",
        F.col("text").cast("binary").alias("text"),
        F.coalesce("train", F.lit(False)).alias("train"),
    )
    equal = rows.repartition(n, "block").groupBy("block", "doc_id", "text", "train")
    return equal.agg(F.count(F.lit(1)).alias("copies"))


def _requests(dealt: DataFrame, order: int, bits: int) -> DataFrame:
    """Per block and range: sorted n-gram hashes of each order and their training counts."""

    def run(key, table):
        block = read_block(_sorted_rows(table))
        out = []
        for n in range(1, order + 1):
            unique, _, counts = _distinct(block, n)
            parts, cuts = _ranges(unique, bits)
            for part, a, b in zip(parts.tolist(), cuts, cuts[1:]):
                out.append((n, part, pack(unique[a:b]), planes(counts[a:b])))
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "n": pa.array([o[0] for o in out], pa.int32()),
                "part": pa.array([o[1] for o in out], pa.int32()),
                "grams": pa.array([o[2] for o in out], pa.binary()),
                "counts": pa.array([o[3] for o in out], pa.binary()),
            }
        )

    return dealt.groupBy("block").applyInArrow(
        run, "block int, n int, part int, grams binary, counts binary"
    )


def planes(values: np.ndarray) -> bytes:
    """64-bit values in as few byte planes as the largest of them needs.

    Planes put equal high bytes side by side, where compression removes them.
    """
    split = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = 8
    while used > 1 and not split[used - 1].any():
        used -= 1
    return bytes([used]) + split[:used].tobytes()


def unplaned(packed: bytes) -> np.ndarray:
    used = packed[0]
    n = (len(packed) - 1) // used
    split = np.zeros((8, n), np.uint8)
    split[:used] = np.frombuffer(packed, np.uint8, offset=1).reshape(used, n)
    return np.ascontiguousarray(split.T).view("<u8").ravel()


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as planes of their differences."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(unplaned(packed), dtype=np.uint64)


def _answers(requests: DataFrame, partitions: int) -> DataFrame:
    """Totals over all blocks, sent back to each block in the order it asked.

    A row of block -1 per range holds its number of distinct n-grams seen in
    training and the sum of their counts.
    """

    def run(key, table):
        grams = [unpack(x) for x in table["grams"].to_pylist()]
        counts = [unplaned(x) for x in table["counts"].to_pylist()]
        unique, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(unique))
        totals = totals.astype(np.int64)
        back = np.split(totals[inverse], np.cumsum([len(g) for g in grams])[:-1])
        n, part = key[0].as_py(), key[1].as_py()
        size = table.num_rows + 1
        return pa.table(
            {
                "block": pa.array(table["block"].to_pylist() + [-1], pa.int32()),
                "n": pa.array([n] * size, pa.int32()),
                "part": pa.array([part] * size, pa.int32()),
                "totals": pa.array([planes(x) for x in back] + [b""], pa.binary()),
                "seen": pa.array([0] * (size - 1) + [int((totals > 0).sum())], pa.int64()),
                "sum": pa.array([0] * (size - 1) + [int(totals.sum())], pa.int64()),
            }
        )

    dealt = requests.repartition(partitions, "n", "part")
    return dealt.groupBy("n", "part").applyInArrow(
        run, "block int, n int, part int, totals binary, seen long, sum long"
    )


@dataclass
class Automaton:
    """States are known contexts; arcs and failure arcs carry log10 weights.

    ``arc[n]`` and ``fail[n]`` belong to the block's distinct n-grams: the
    log-probability of the arc that spells an n-gram (NaN without one), and
    the weight of the failure arc of the state it names (0 without a state).
    """

    arc: list[np.ndarray]
    fail: list[np.ndarray]
    unknown: float


def compile_block(totals: list[np.ndarray], index: list[np.ndarray], total: int, seen: int,
                  prior: float) -> Automaton:
    """Arc and failure weights for the n-grams of a block, shorter contexts first."""
    floor = total + seen + 1
    arc = [np.full(0, np.nan), np.log10((totals[0] + 1) / floor)]
    fail = [np.zeros(0), np.log10(prior / (totals[0] + prior))]
    lower = (totals[0] + 1) / floor  # P of each known shorter n-gram, by its index
    for n in range(2, len(totals) + 1):
        at = np.flatnonzero(index[n - 1] >= 0)
        gram = index[n - 1][at]
        context = totals[n - 2][index[n - 2][at - 1]]
        shorter = lower[index[n - 2][at]]
        p = np.empty(len(totals[n - 1]))
        p[gram] = (totals[n - 1][gram] + prior * shorter) / (context + prior)
        arc.append(np.where(totals[n - 1] > 0, np.log10(p), np.nan))
        fail.append(np.log10(prior / (totals[n - 1] + prior)))
        lower = p
    return Automaton(arc, fail, -np.log10(floor))


def traverse(automaton: Automaton, index: list[np.ndarray], totals: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of every token, reading left to right.

    A token's state is the longest context before it that is known.  Where the
    state has no arc for the token, its failure arc is taken and its weight
    added, down to the empty context, which has an arc for everything.  All
    tokens of a block do this side by side, one context length at a time.
    """
    size = len(index[0])
    score, open_ = np.zeros(size), np.ones(size, bool)
    for n in range(len(index), 0, -1):
        gram = index[n - 1]
        known = gram >= 0
        weight = np.full(size, np.nan)
        weight[known] = automaton.arc[n][gram[known]]
        here = open_ & ~np.isnan(weight)
        score[here] += weight[here]
        open_ &= ~here
        if n > 1:
            context = np.where(np.arange(size) > 0, index[n - 2][np.arange(size) - 1], -1)
            falls = open_ & (gram >= 0) & (context >= 0)
            falls[falls] = totals[n - 2][context[falls]] > 0
            score[falls] += automaton.fail[n - 1][context[falls]]
    return score


def left_out(index: list[np.ndarray], totals: list[np.ndarray], total: int, seen: int,
             prior: float) -> np.ndarray:
    """Log10 probability of every training token by the counts without itself."""
    p = np.maximum(totals[0][index[0]], 1) / (total + seen)
    for n in range(2, len(index) + 1):
        at = np.flatnonzero(index[n - 1] >= 0)
        count = np.maximum(totals[n - 1][index[n - 1][at]] - 1, 0)
        context = np.maximum(totals[n - 2][index[n - 2][at - 1]] - 1, 0)
        p[at] = (count + prior * p[at]) / (context + prior)
    return np.log10(p)


def _score_block(rows: pa.Table, replies: pa.Table, order: int, total: int, seen: int,
                 priors: tuple[float, ...]) -> dict:
    """Columns of a block's documents: base score, scores and left-out scores by prior."""
    rows = _sorted_rows(rows)
    replies = replies.sort_by([("n", "ascending"), ("part", "ascending")])
    block = read_block(rows)
    index, totals = [], []
    asked, answered = np.array(replies["n"]), replies["totals"].to_pylist()
    for n in range(1, order + 1):
        index.append(_distinct(block, n)[1])
        mine = [unplaned(answered[i]) for i in np.flatnonzero(asked == n)]
        totals.append(np.concatenate([*mine, np.empty(0, "<u8")]).astype(np.int64))
    starts = np.cumsum(block.lengths) - block.lengths
    counts = totals[0][index[0]]

    def of_documents(tokens: np.ndarray) -> np.ndarray:
        return np.add.reduceat(tokens, starts)

    scores, without = [], []
    for prior in priors:
        automaton = compile_block(totals, index, total, seen, prior)
        scores.append(of_documents(traverse(automaton, index, totals)))
        own = left_out(index, totals, total, seen, prior) if total else np.zeros(len(counts))
        without.append(of_documents(np.where(block.weight > 0, own, 0.0)))
    return {
        "doc_id": rows["doc_id"],
        "train": rows["train"],
        "copies": rows["copies"],
        "n_tokens": pa.array(block.lengths, pa.int64()),
        "n_known": pa.array(of_documents((counts > 0).astype(np.int64))),
        "base_score": pa.array(of_documents(np.log10((counts + 1) / (total + seen + 1)))),
        "scores": pa.array(np.stack(scores, axis=1).tolist(), pa.list_(pa.float64())),
        "without": pa.array(np.stack(without, axis=1).tolist(), pa.list_(pa.float64())),
    }


def _every_copy(counted: DataFrame) -> DataFrame:
    """As many rows as ``copies`` says, made in steps so that no array is long."""
    step = 10_000
    some = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step)))
    left = F.least(F.lit(step), F.col("copies") - F.col("__step") * step)
    each = F.explode(F.sequence(F.lit(1).cast("long"), left))
    return counted.select("*", some.alias("__step")).select("*", each.alias("__copy"))


def score(
    docs: DataFrame, train: Column, order: int = ORDER, priors: tuple[float, ...] = PRIORS
) -> DataFrame:
    """Base and model log10 probabilities of every text.

    ``train`` marks the rows to learn from (NULL: not).  Returns ``doc_id``,
    ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``prior``; one row per row of ``docs``.  NULL and empty texts
    hold the end token alone.  Without training rows every token is unknown.
    """
    spark = docs.sparkSession
    n = blocks(texts(docs), BLOCK_CHARS)
    dealt = _dealt(docs, train, n)
    bits = max(1, (2 * n - 1).bit_length())  # ranges: two to four a block
    path = fresh_folder(spark, "ngrams")
    _answers(_requests(dealt, order, bits), n).write.parquet(path)
    answers = spark.read.parquet(path)
    known = answers.where("block = -1 AND n = 1").agg(F.sum("sum"), F.sum("seen")).first()
    total, seen = int(known[0] or 0), int(known[1] or 0)

    docs_type = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    names = ["doc_id", "train", "copies", "n_tokens", "n_known", "base_score", "scores", "without"]
    lists = pa.list_(pa.float64())
    kinds = [docs_type, pa.bool_(), *[pa.int64()] * 3, pa.float64(), lists, lists]

    def run(key, rows, replies):
        if not rows.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        return pa.table(_score_block(rows, replies, order, total, seen, priors))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, train boolean, copies long, n_tokens long, n_known long, base_score double, "
        "scores array<double>, without array<double>"
    )
    asked = answers.where("block >= 0").select("block", "n", "part", "totals")
    asked = asked.repartition(n, "block")
    scored = dealt.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, schema)
    path = fresh_folder(spark, "scores")
    scored.write.parquet(path)
    scored = spark.read.parquet(path)
    weighed = (F.get("without", F.lit(i)) * F.col("copies") for i in range(len(priors)))
    sums = scored.agg(*map(F.sum, weighed)).first()
    best = max(range(len(priors)), key=lambda i: (sums[i] or 0.0, i))
    return _every_copy(scored).select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        F.get("scores", F.lit(best)).alias("score"),
        F.lit(priors[best]).alias("prior"),
    )
