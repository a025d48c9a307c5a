"""Secret scan: patterns propose, a character network judges what they propose.

Candidates are the base findings and every other token of 16 characters or
more, long words included.  A convolutional
network in numpy reads each candidate with its surroundings.  It is trained on
all findings, labelled by the base patterns, with the telling words before them
hidden for a part, so that it learns what secrets look like; its outputs are
calibrated on windows it has not seen, and the threshold is the highest that still
finds the wanted share of the secrets among those.

One pass stores candidates per document, one more scores them.  For training,
all distinct windows are dealt by hash into parts of bounded size.  In each
round every part goes on from the same network, and the mean of what they
learned is the next; calibration and threshold come from sums and ranks over
the held-out windows of all parts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import texts
from footfall.sources import fresh_folder

# The base kinds in their order, and the kind that the network adds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "other")

BEFORE, INSIDE, AFTER = 24, 40, 8
PART = 8000  # distinct windows that one task trains on at a time, about
MEANS = 100  # networks that are averaged in one task
ROUNDS, FULL = 10, 50_000  # beyond so many windows, each is seen less often, once a round at least
RECALL = 0.98
WIDTH, FILTERS, EMBED = 5, 24, 8
EPOCHS, RATE, SEED = 30, 0.01, 5


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of base findings and other candidates, sorted."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6
    ]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    at, reach = 0, -1
    for m in TOKEN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if m.start() >= reach:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


LENGTH = BEFORE + INSIDE + AFTER


def windows(text: str, start: int, stop: int) -> bytes:
    """A candidate with its surroundings as character classes, in windows of ``LENGTH``.

    A candidate that does not fit one window is seen through several that
    overlap by half, so every place of it is read with what stands beside it.
    """
    out = []
    for at in range(start, max(start + 1, stop - INSIDE // 2), INSIDE // 2):
        inner = text[at : min(at + INSIDE, stop)]
        end = at + len(inner)
        before = text[max(0, at - BEFORE) : at].rjust(BEFORE, "\0")
        after = text[end : end + AFTER].ljust(AFTER, "\0")
        out.append(before + inner.ljust(INSIDE, "\0") + after)
    return bytes(min(ord(c), 127) for c in "".join(out))


@dataclass
class Network:
    """Embedding, one convolution, max pooling, a logistic output, and its calibration."""

    embed: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0

    def forward(self, coded: np.ndarray):
        """Logits of windows, with what backpropagation needs."""
        seen = self.embed[coded]
        n = coded.shape[1] - WIDTH + 1
        stacked = np.concatenate([seen[:, i : i + n] for i in range(WIDTH)], axis=2)
        mapped = stacked @ self.kernel + self.shift
        peak = mapped.argmax(axis=1)
        pooled = np.take_along_axis(mapped, peak[:, None], 1)[:, 0]
        active = np.maximum(pooled, 0)
        return active @ self.out + self.bias[0], (stacked, peak, pooled, active)

    def probability(self, coded: np.ndarray) -> np.ndarray:
        logit = np.concatenate(
            [self.forward(part)[0] for part in np.array_split(coded, max(1, len(coded) // 512))]
        )
        return self.calibrated(logit)

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.offset, -30, 30)))


def _start() -> Network:
    random = np.random.default_rng(SEED)
    return Network(
        random.normal(0, 0.3, (128, EMBED)),
        random.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
        np.zeros(FILTERS),
        random.normal(0, 0.2, FILTERS),
        np.zeros(1),
    )


NAMES = ("embed", "kernel", "shift", "out", "bias")


def _coded(windows: bytes) -> np.ndarray:
    return np.frombuffer(windows, np.uint8).reshape(-1, LENGTH).astype(np.int64)


def _hidden(coded: np.ndarray) -> np.ndarray:
    """Windows without what stands before the candidate."""
    hidden = coded.copy()
    hidden[:, :BEFORE] = 0
    return hidden


def fit(windows: list[bytes], labels: np.ndarray) -> Network:
    """Train, calibrate and set the threshold; without both labels nothing is added."""
    network = _start()
    if len(set(labels.tolist())) < 2:
        return network
    random = np.random.default_rng(SEED)
    coded = _coded(b"".join(windows))
    mix = random.permutation(len(coded))
    held, kept = mix[: len(mix) // 4], mix[len(mix) // 4 :]
    network = _descend(network, coded[kept], labels[kept], EPOCHS, random)
    return _calibrate(network, _hidden(coded[held]), labels[held])


def _descend(
    network: Network, coded: np.ndarray, labels: np.ndarray, epochs: int, random: np.random.Generator
) -> Network:
    """Gradient steps (Adam) over all windows, ``epochs`` times."""
    network, names, hidden = replace(network), NAMES, _hidden(coded)
    first = {k: np.zeros_like(getattr(network, k)) for k in names}
    second = {k: np.zeros_like(getattr(network, k)) for k in names}
    step = 0
    for _ in range(epochs):
        for chosen in np.array_split(random.permutation(len(coded)), max(1, len(coded) // 64)):
            masked = random.random(len(chosen))[:, None] < 0.5
            seen = np.where(masked, hidden[chosen], coded[chosen])
            logit, (stacked, peak, pooled, active) = network.forward(seen)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]) / len(chosen)
            through = np.outer(error, network.out) * (pooled > 0)
            # the place each filter's maximum came from, and its inputs there
            inputs = np.take_along_axis(stacked, peak[:, :, None], 1)
            to_inputs = through[:, :, None] * network.kernel.T[None]
            embed = np.zeros_like(network.embed)
            places = peak[:, :, None] + np.arange(WIDTH)
            letters = np.take_along_axis(seen[:, None, :], places.reshape(len(seen), 1, -1), 2)
            np.add.at(embed, letters.reshape(-1), to_inputs.reshape(-1, EMBED))
            gradient = {
                "embed": embed,
                "kernel": np.einsum("nfi,nf->if", inputs, through),
                "shift": through.sum(axis=0),
                "out": active.T @ error,
                "bias": np.array([error.sum()]),
            }
            step += 1
            for k, g in gradient.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                size = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                setattr(network, k, getattr(network, k) - RATE * first[k] / (1 - 0.9**step) / size)
    return network


def _moments(network: Network, logit: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """What a step of calibration sums up over held-out windows."""
    p = network.calibrated(logit)
    w = p * (1 - p)
    return np.array([(p - labels) @ logit, (p - labels).sum(), w @ (logit * logit), w @ logit, w.sum()])


def _fit_scale(network: Network, moments: Callable[[Network], np.ndarray]) -> None:
    """Logistic calibration: Newton steps on two parameters, with a small prior for stability."""
    for _ in range(50):
        a, b, c, d, e = moments(network)
        curve = np.array([[c + 1e-2, d], [d, e + 1e-2]])
        move = np.linalg.solve(curve, np.array([a + 1e-2 * (network.scale - 1), b]))
        network.scale -= float(np.clip(move[0], -1, 1))
        network.offset -= float(np.clip(move[1], -1, 1))
        if np.abs(move).max() < 1e-9:
            break


def _calibrate(network: Network, coded: np.ndarray, labels: np.ndarray) -> Network:
    """Logistic calibration on held-out rows, then the recall-constrained threshold."""
    if len(set(labels.tolist())) < 2:
        return network
    logit = network.forward(coded)[0]
    _fit_scale(network, lambda current: _moments(current, logit, labels))
    found = np.sort(network.probability(coded)[labels == 1])
    network.threshold = float(found[int((1 - RECALL) * len(found))])
    return network


_SPAN = "struct<start:int,kind:int,stop:int,window:binary>"


def propose(docs: DataFrame, path: str) -> None:
    """Store ``doc_id`` and the candidates of every document."""

    def run(batches):
        kinds = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()),
                           ("window", pa.binary())])
        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text.as_py()
                rows.append(
                    [
                        {"start": a, "kind": k, "stop": b, "window": windows(text, a, b)}
                        for a, k, b in candidates(text)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(rows, pa.list_(kinds))], ["doc_id", "found"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts(docs).mapInArrow(run, f"doc_id {kind}, found array<{_SPAN}>").write.parquet(path)


def _stored_parts(spark: SparkSession, path: str, part: int) -> tuple[str, int, int]:
    """Store all distinct labelled windows, one row per part, in an order of their own.

    Columns: ``part``, ``windows`` and ``secret`` of those to learn from, and
    ``held_windows`` and ``held_secret`` of a quarter.  Returns the folder and
    the numbers of parts and of windows.
    """
    each = spark.read.parquet(path).select(F.explode("found").alias("x"))
    starts = F.sequence(F.lit(1), F.length("x.window"), F.lit(LENGTH))
    cut = F.transform(starts, lambda i: F.substring("x.window", i, F.lit(LENGTH)))
    labelled = each.select((F.col("x.kind") < 3).alias("secret"), F.explode(cut).alias("window"))
    distinct, parted = fresh_folder(spark, "windows"), fresh_folder(spark, "window-parts")
    labelled.distinct().write.parquet(distinct)
    rows = spark.read.parquet(distinct)
    n = rows.count()
    parts = max(1, math.ceil(n / part))
    hashed = F.xxhash64("window")
    dealt = rows.select(
        F.pmod(hashed, F.lit(parts)).cast("int").alias("part"),
        (F.pmod(F.shiftright(hashed, 40), F.lit(4)) == 0).alias("held"),
        "secret",
        "window",
    )

    def pack(key, table):
        table = table.sort_by([("window", "ascending"), ("secret", "ascending")])
        held = table["held"].to_numpy()
        secret = table["secret"].to_numpy().astype(np.uint8)
        window = np.array(table["window"].to_pylist(), object)
        values = [v for side in (~held, held) for v in (b"".join(window[side]), secret[side].tobytes())]
        return pa.table([[key[0].as_py()], *([v] for v in values)], schema=packed)

    names = ("windows", "secret", "held_windows", "held_secret")
    packed = pa.schema([("part", pa.int32()), *((name, pa.binary()) for name in names)])
    schema = "part int, " + ", ".join(f"{name} binary" for name in names)
    dealt.groupBy("part").applyInArrow(pack, schema).write.parquet(parted)
    return parted, parts, n


def _each_part(rows: DataFrame, columns: tuple[str, ...], work: Callable, schema: str) -> DataFrame:
    """``part`` and the values that ``work`` makes of the columns of each part."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        for batch in batches:
            parts = batch["part"].to_pylist()
            for part, *values in zip(parts, *(batch[c].to_pylist() for c in columns)):
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, **dict(zip(names, work(part, *values)))}],
                    pa.schema([("part", pa.int32()), *((name, pa.binary()) for name in names)]),
                )

    return rows.select("part", *columns).mapInArrow(run, f"part int, {schema}")


def _flat(network: Network) -> np.ndarray:
    return np.concatenate([getattr(network, k).ravel() for k in NAMES])


def _shaped(network: Network, flat: np.ndarray) -> Network:
    sizes = np.cumsum([getattr(network, k).size for k in NAMES])[:-1]
    values = zip(NAMES, np.split(flat, sizes))
    return replace(network, **{k: v.reshape(getattr(network, k).shape) for k, v in values})


def _mean(learned: DataFrame) -> np.ndarray | None:
    """Mean of networks weighted by their windows; sums go by groups of parts, in order."""

    def add(key, table):
        rows = sorted(zip(table["part"].to_pylist(), table["sums"].to_pylist()))
        total = np.sum([np.frombuffer(v) for _, v in rows], axis=0)
        return pa.table([[key[0].as_py()], [total.tobytes()]], schema=schema)

    schema = pa.schema([("group", pa.int32()), ("sums", pa.binary())])
    grouped = learned.groupBy((F.col("part") / MEANS).cast("int").alias("group"))
    rows = grouped.applyInArrow(add, "group int, sums binary").collect()
    if not rows:
        return None
    total = np.sum([np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.group)], axis=0)
    return total[1:] / total[0] if total[0] else None


def train(spark: SparkSession, path: str, part: int = PART) -> Network:
    """Fit on all distinct candidates, in parts of about ``part`` windows; see the module's text."""
    network = _start()
    parted, parts, n = _stored_parts(spark, path, part)
    if not n:
        return network
    stored = spark.read.parquet(parted).repartition(parts)
    epochs = max(1, round(EPOCHS / ROUNDS * min(1, FULL / n)))
    kinds = spark.read.parquet(path).select(F.explode("found.kind").alias("kind"))
    if kinds.select(F.col("kind") < 3).distinct().count() < 2:
        return network

    for turn in range(ROUNDS):

        def learn(key, windows, secret, network=network, turn=turn):
            labels = np.frombuffer(secret, np.uint8).astype(float)
            if not len(labels):
                return (np.zeros(1 + _flat(network).size).tobytes(),)
            random = np.random.default_rng([SEED, turn, key])
            found = _flat(_descend(network, _coded(windows), labels, epochs, random))
            return ((len(labels) * np.concatenate([[1.0], found])).tobytes(),)

        mean = _mean(_each_part(stored, ("windows", "secret"), learn, "sums binary"))
        if mean is None:
            return network
        network = _shaped(network, mean)
    return _calibrate_all(spark, network, stored)


def _calibrate_all(spark: SparkSession, network: Network, stored: DataFrame) -> Network:
    """``_calibrate`` over the held-out windows of all parts."""

    def judge(key, windows, secret):
        coded = _hidden(_coded(windows))
        split = np.array_split(coded, max(1, len(coded) // 512))
        return np.concatenate([network.forward(x)[0] for x in split]).tobytes(), secret

    path = fresh_folder(spark, "logits")
    columns = ("held_windows", "held_secret")
    _each_part(stored, columns, judge, "logit binary, secret binary").write.parquet(path)
    judged = spark.read.parquet(path)

    def summed(current: Network, of: Callable) -> np.ndarray:
        def work(key, logit, secret):
            logit, labels = np.frombuffer(logit), np.frombuffer(secret, np.uint8).astype(float)
            return (np.asarray(of(current, logit, labels), float).tobytes(),)

        rows = _each_part(judged, ("logit", "secret"), work, "sums binary").collect()
        each = [np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.part)]
        return np.array([math.fsum(column) for column in zip(*each)])

    n, secret = summed(network, lambda _, x, y: [len(y), y.sum()])
    if not 0 < secret < n:
        return network
    _fit_scale(network, lambda current: summed(current, _moments))

    def secrets_of(batches):
        for batch in batches:
            for logit, label in zip(batch["logit"].to_pylist(), batch["secret"].to_pylist()):
                chosen = np.frombuffer(logit)[np.frombuffer(label, np.uint8) == 1]
                yield pa.RecordBatch.from_arrays([pa.array(chosen)], ["logit"])

    ranked = judged.select("logit", "secret").mapInArrow(secrets_of, "logit double").orderBy("logit")
    rank = int((1 - RECALL) * int(secret))
    logit = ranked.rdd.zipWithIndex().filter(lambda row: row[1] == rank).first()[0].logit
    network.threshold = float(network.calibrated(np.array([logit]))[0])
    return network


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs``, by start and kind.

    A span has start, kind (index in ``KINDS``), stop (code points, stop
    exclusive) and probability.  Base findings stay whatever the network says;
    other candidates need its threshold.  NULL and empty texts have none, and
    rows with equal ids are scanned each.
    """
    spark = docs.sparkSession
    path = fresh_folder(spark, "candidates")
    propose(docs, path)
    shared = spark.sparkContext.broadcast(train(spark, path))

    def run(batches):
        network = shared.value
        kinds = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()),
                           ("probability", pa.float64())])
        for batch in batches:
            found = batch["found"].to_pylist()
            flat = [x for row in found for x in row or ()]
            scored = iter(())
            if flat:
                coded = np.frombuffer(b"".join(x["window"] for x in flat), np.uint8)
                coded = coded.reshape(-1, LENGTH).astype(np.int64)
                sizes = np.array([len(x["window"]) // LENGTH for x in flat])
                each = network.probability(coded)
                scored = iter(np.maximum.reduceat(each, np.cumsum(sizes) - sizes).tolist())
            rows = []
            for row in found:
                kept = []
                for x in row or ():
                    p = next(scored)
                    if x["kind"] < 3 or p >= network.threshold:
                        kept.append({"start": x["start"], "kind": x["kind"], "stop": x["stop"],
                                     "probability": p})
                rows.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(rows, pa.list_(kinds))], ["doc_id", "spans"]
            )

    stored = spark.read.parquet(path)
    kind = stored.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start:int,kind:int,stop:int,probability:double>>"
    return stored.mapInArrow(run, f"doc_id {kind}, spans {spans}")


def listed(spans: str = "spans", base: bool = False):
    """kind:start:stop of spans, joined by commas; base kinds alone on request."""
    chosen = F.filter(spans, lambda x: x["kind"] < 3) if base else F.col(spans)
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            chosen, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["stop"])
        ),
        ",",
    )


def keep_safe(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind in angle brackets.

    No document is dropped; the other columns stay.  Rows are matched by id
    and a hash of the text; equal rows have equal spans.
    """
    keyed = docs.select("*", F.xxhash64("text").alias("__hash"))
    pairs = keyed.select(F.struct("doc_id", "__hash").alias("doc_id"), "text")
    found = scan(pairs).where(F.size("spans") > 0).select("doc_id.*", "spans")
    found = found.select(
        F.col("doc_id").alias("__id"), F.col("__hash").alias("__of"), F.col("spans").alias("__spans")
    ).dropDuplicates(["__id", "__of"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__hash").eqNullSafe(F.col("__of"))
    joined = keyed.join(found, same, "left")
    names = F.array(*map(F.lit, KINDS))

    def step(done, x):
        gap = F.greatest(x["start"] - done["at"], F.lit(0))
        mark = F.concat(F.lit("<"), F.get(names, x["kind"]), F.lit(">"))
        added = F.concat(F.substring(F.col("text"), done["at"] + 1, gap), mark)
        covered = x["start"] < done["at"]
        return F.struct(
            F.when(covered, done["out"]).otherwise(F.concat(done["out"], added)).alias("out"),
            F.greatest(done["at"], x["stop"]).alias("at"),
        )

    done = F.aggregate("__spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    staged = joined.withColumn("__done", F.when(F.col("__spans").isNotNull(), done))
    rest = F.col("text").substr(F.col("__done.at") + 1, F.length("text"))
    clean = F.when(F.col("__done").isNotNull(), F.concat("__done.out", rest))
    return staged.select(
        *(clean.otherwise(F.col(c)).alias(c) if c == "text" else c for c in docs.columns)
    )
