"""What several text operators share: reading tables, ASCII words, word hashes."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def visible_to_workers(spark: SparkSession) -> None:
    """Let Python workers of a local session import this library from any folder.

    On a cluster it is installed or given by ``--py-files`` like any other.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if spark.sparkContext.master.startswith("local") and root not in known.get("PYTHONPATH", ""):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    visible_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *keep: Column) -> DataFrame:
    """``doc_id`` and ``text`` (NULL as empty), whatever else the table holds."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text, by which rows are dealt to folds."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def text_key() -> Column:
    """128-bit hash of ``text`` (NULL as empty), which with the id tells rows apart."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def blocks(docs: DataFrame, chars: int) -> int:
    """How many blocks of about ``chars`` characters the texts make."""
    total = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    return max(1, round(total / chars))


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound that never shows in results."""

    def __init__(self, seed: int = 0, limit: int = 250_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two columns of 64-bit values."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + right
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indexes start .. start + length - 1, run after run."""
    before = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(int(lengths.sum())) - before + np.repeat(starts, lengths)
