"""Byte-level BPE files of the ``tokenizers`` library, encoded into numpy arrays.

A file whose parts are those of plain byte-level BPE (they are read, not
assumed) is given to ``tiktoken``, which applies the same merges several times
faster.  Any other file, and any text that holds one of the file's special
strings, goes to the library itself, so ids are always the library's.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

# Fixed value: how byte-level pre-tokenizers split text.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[int, str]:
    """Letters that byte-level vocabularies spell bytes with: printable ones as they are."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _plain_ranks(spec: dict) -> dict[bytes, int] | None:
    """Rank of every token by its bytes, or None unless ids rank the merges."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
            "byte_fallback", "ignore_merges",
        ))
        and not spec.get("normalizer")
        and not spec.get("truncation")
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
    )
    if not plain:
        return None
    vocab = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    letters = byte_letters()
    singles = [letters[b] for b in range(256)]
    in_order = [vocab.get(m) for m in merged]
    if any(s not in vocab for s in singles) or len(vocab) != 256 + len(merged):
        return None
    first = max(vocab[s] for s in singles)
    if None in in_order or in_order != sorted(in_order) or in_order[:1] < [first]:
        return None
    back = {letter: byte for byte, letter in letters.items()}
    return {bytes(map(back.__getitem__, word)): i for word, i in vocab.items()}


class ByteLevel:
    """Ids of texts by one tokenizer file.

    ``special`` says whether special strings inside a text become their ids, as
    the library does unless told otherwise, or are ordinary text.
    """

    def __init__(self, path: str, special: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.special = path, special
        self.ranks = _plain_ranks(spec)
        self.reserved = [t["content"] for t in spec.get("added_tokens") or []] if special else []
        self._library = None
        if self.ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding(
                path, pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens={}
            )

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = not self.special
        return self._library

    def ids(self, text: str) -> np.ndarray:
        if self.ranks is None or any(word in text for word in self.reserved):
            found = self.library().encode(text, add_special_tokens=False).ids
            return np.array(found, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def token_bytes(self) -> list[bytes]:
        """Bytes of every id; only for plain byte-level files."""
        if self.ranks is None:
            raise ValueError(f"{self.path} is no plain byte-level BPE file")
        table = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            table[i] = token
        return table


@lru_cache(maxsize=4)
def byte_level(path: str, special: bool = True) -> ByteLevel:
    """The tokenizer of a file, loaded once in a process."""
    return ByteLevel(path, special)
