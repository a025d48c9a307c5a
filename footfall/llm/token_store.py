"""Token ids as Parquet list columns, in order of document, for selective reads.

Documents are range-partitioned and sorted by id before they are encoded, so
file after file holds ids in order, row-group and page statistics of ``doc_id``
are narrow, and a reader of a few documents skips the rest.  Small numbers
(dictionary or delta encoding) and counts lie in columns of their own, which a
reader of metadata reads alone.
"""

from __future__ import annotations

import json
import sys
import zlib
from unicodedata import category, is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.byte_level import byte_letters
from footfall.llm.common import texts

END_ID = 1
# Row groups and pages; version 2 pages hold integers without a dictionary as deltas.
LAYOUT = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "v2",
    "compression": "zstd",
}


# The parts of a tokenizer file that are done here; others go to the library.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# A pattern of which no match holds white space, nor depends on what is beyond it.
_WITHIN_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN_WORDS = 300_000  # stretches of text that a process remembers, some 60 MB
_STOP = "\0"  # stands for the end of a word


def _word_ranks(spec: dict) -> dict[bytes, int] | None:
    """Rank of every token by its bytes and stop, or None unless ids rank the merges."""
    model, letters = spec["model"], byte_letters()
    end, vocab = model.get("end_of_word_suffix"), model.get("vocab")
    plain = model.get("type") == "BPE" and end and not any(
        model.get(k) for k in
        ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    )
    if not plain or spec.get("truncation") or spec.get("padding"):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    singles = [*letters.values(), *(letter + end for letter in letters.values())]
    in_order = [vocab.get(m) for m in merged]
    if any(s not in vocab for s in singles) or None in in_order or in_order != sorted(in_order):
        return None
    if in_order and in_order[0] < max(vocab[s] for s in singles):
        return None
    back, ranks = {letter: byte for byte, letter in letters.items()}, {}
    for word in {*singles, *merged}:
        body = word.removesuffix(end)
        spelled = bytes(map(back.__getitem__, body))
        ranks[spelled + _STOP.encode() * (body != word)] = vocab[word]
    return ranks


def _split_pattern(spec: dict) -> str | None:
    """What the file takes for a word, if the rest of its preparation is done here."""
    normal, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    split, *rest = pre.get("pretokenizers") or [{}]
    known = (
        normal.get("type") == pre.get("type") == "Sequence"
        and normal.get("normalizers") == _NORMALIZERS
        and rest == [_BYTES]
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and split.get("invert")
    )
    return split["pattern"].get("Regex") if known else None


_ODD_LETTERS = (_STOP, "\u0130", "\u03a3")
_SETTLED = "\u0530"  # below it every character is known or in _ODD_LETTERS


def _unknown() -> np.ndarray:
    """For every code point, whether this Python's tables do not know it yet."""
    every = map(chr, range(sys.maxunicode + 1))
    return np.fromiter((category(c) == "Cn" for c in every), bool, sys.maxunicode + 1)


class WordEncoder:
    """Ids of texts by a tokenizer file of words with an end mark.

    The file says how text is prepared.  Where it is lower-cased and split into
    words by a pattern, that is done here, a stop is put behind each word, and
    ``tiktoken`` applies the merges, in which letter and stop come first.  Texts
    with special strings, that are not normalised, that hold capitals whose lower
    form depends on more than themselves or characters unknown here, and all texts of any other file go to the library, so ids are always the
    library's.  Where no word reaches over a space, what stands between spaces is
    split and encoded when first seen and remembered, ``KNOWN_WORDS`` at most;
    else words are.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<i4").tobytes()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ranks, pattern = _word_ranks(spec), _split_pattern(spec)
        self.plain = bool(ranks and pattern)
        if self.plain:
            import tiktoken

            self.special = [t["content"] for t in spec.get("added_tokens") or []]
            self.unknown, self.words = _unknown(), regex.compile(pattern).findall
            self.by_spaces = pattern == _WITHIN_SPACES
            self.merges = tiktoken.Encoding(
                path, pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={}
            )
            self.ends = np.zeros(max(ranks.values()) + 1, bool)
            self.ends[[i for token, i in ranks.items() if token[1:].endswith(_STOP.encode())]] = True
            self.known: dict[str, bytes] = {}

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text and the end id, as little-endian 32-bit integers."""
        return [self.text(text) + self.end for text in texts]

    def text(self, text: str) -> bytes:
        if not self.plain or not self._as_usual(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()
        parts = self._parts(text.lower())
        distinct = set(parts)
        new = distinct.difference(self.known)
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.known, new = {}, distinct
            self._learn(list(new))
        return b"".join(map(self.known.__getitem__, parts))

    def _parts(self, text: str) -> list[str]:
        """Stretches that are encoded each by itself."""
        return text.replace("\n", " ").split(" ") if self.by_spaces else self.words(text)

    def _learn(self, parts: list[str]) -> None:
        """Encode parts in one go; the last token of each word, and no other, holds the stop."""
        found = list(map(self.words, parts)) if self.by_spaces else [[part] for part in parts]
        every = [word for words in found for word in words]
        ids = np.array(self.merges.encode_ordinary(_STOP.join([*every, ""])), "<i4")
        ends = np.concatenate([[0], 4 * (np.flatnonzero(self.ends[ids]) + 1)])
        ends = ends[np.cumsum([0, *map(len, found)])].tolist()
        packed = ids.tobytes()
        self.known.update((part, packed[x:y]) for part, x, y in zip(parts, ends, ends[1:]))

    def _as_usual(self, text: str) -> bool:
        return (
            is_normalized("NFC", text)
            and not any(letter in text for letter in _ODD_LETTERS)
            and not any(word in text for word in self.special)
            and (text.isascii() or max(text) < _SETTLED or not self._holds_unknown(text))
        )

    def _holds_unknown(self, text: str) -> bool:
        return bool(self.unknown[np.frombuffer(text.encode("utf-32-le"), "<u4")].any())


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every text and write the ids in ascending order of ``doc_id``.

    Columns of the files: ``doc_id``, ``n_tokens``, ``part`` (the writing
    partition, in order), ``before`` (ids of that partition before the row)
    and ``ids``.  NULL and empty texts hold the end id alone, NULL ids come
    first, and rows with equal ids go by a hash of their text.
    """
    tie = F.xxhash64("text")
    ordered = (
        texts(docs)
        .repartitionByRange(F.col("doc_id"), tie)
        .sortWithinPartitions(F.col("doc_id"), tie)
        .withColumn("part", F.spark_partition_id())
    )

    def run(batches):
        encoder, before = _encoder(tokenizer, end_id), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                few = batch.slice(start, 64)
                packed = encoder.packed(few["text"].to_pylist())
                counts = np.array([len(p) // 4 for p in packed], np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [few["doc_id"], pa.array(counts), few["part"], pa.array(before + ends[:-1]),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)],
                    ["doc_id", "n_tokens", "part", "before", "ids"],
                )
                before += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, part int, before long, ids array<int>"
    writer = ordered.mapInArrow(run, schema).write.mode("overwrite")
    writer.options(**LAYOUT).parquet(path)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``; no ids are read."""
    rows = spark.read.parquet(path).select("doc_id", "n_tokens", "part", "before")
    return _started(rows, rows).select("doc_id", "start", "n_tokens")


def _started(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``start``: one row per partition of the writer is summed up in order.

    ``counts`` has ``part`` and ``n_tokens`` of all rows, and is read for them alone.
    """
    sizes = counts.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"),
    )
    joined = rows.join(F.broadcast(offsets), rows["part"] == offsets["of_part"])
    return joined.withColumn("start", F.col("offset") + F.col("before"))


def tokens(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """``doc_id`` and ``ids`` of documents low .. high; other row groups and pages are skipped."""
    return spark.read.parquet(path).where(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and crc32 of the ids of every document."""

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            values = ids.flatten().cast(pa.int32()).to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(batch["n_tokens"].to_numpy(zero_copy_only=False))
            view = memoryview(values.tobytes())
            sums, first = [], 0
            for end in (ends * 4).tolist():
                sums.append(zlib.crc32(view[first:end]))
                first = end
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_tokens"], batch["part"], batch["before"],
                 pa.array(sums, pa.int64())],
                ["doc_id", "n_tokens", "part", "before", "ids_crc32"],
            )

    stored = spark.read.parquet(path)
    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, part int, before long, ids_crc32 long"
    return _started(stored.mapInArrow(run, schema), stored).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )
