"""Small documents with every awkward case, and plain helpers to check against."""

from __future__ import annotations

import random
import re
import zlib

AWKWARD = [
    (None, "a text without an id"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "The same text twice, word for word, with one more word at its end."),
    (4, "The same text twice, word for word, with one more word at its end."),
    (5, "The same text twice, word for word, with one more word at its end."),
    (6, "long " * 20_000),
    (7, "x" * 60_000),
    (8, "1." * 9_000 + "a@" + "b." * 9_000),
    (9, "Ünï­code 漢字 😀 é \x1c\x85　 ß"),
]
SCHEMA = "doc_id long, text string, lang string, text_ string, kept int, node int, block int"


def awkward(spark, rows=AWKWARD):
    """Documents with further columns, some named like what operators make."""
    return spark.createDataFrame([(i, t, "en", t, 1, 2, 3) for i, t in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def blank_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def noise(letters: str, n: int, longest: int, seed: int = 1) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def documents(spark, sf_dir, name="documents"):
    from footfall.llm.common import read

    return read(spark, sf_dir, name)
