"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its text exactly when every two
neighbours are what BPE makes of their own concatenation.  So the encoder is a
nondeterministic transducer: a hypothesis is a token sequence for a prefix
plus a trie node for the token in progress, and a token may be appended where
it is compatible with the one before.  States of the deterministic machine are
sets of such hypotheses, made when first reached and as long as there is room;
beyond it the hypotheses are followed one after the other, with the same
outcome.  A token is emitted as soon as all living hypotheses agree on it; the
wait is bounded because hypotheses in progress are prefixes of vocabulary entries.

The decoder is an incremental UTF-8 state machine: its state is the bytes of
an unfinished character (at most three), its steps are whole tokens.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from footfall.llm.common import texts

# What a process remembers; no limit shows in results.
STEP_LIMIT = 10_000  # deterministic steps, beyond which hypotheses are simulated
START, START_LIMIT = 4, 100_000  # bytes of a beginning, and beginnings of one known longest token
PAIR_LIMIT = 1_000_000  # verdicts on neighbours
PIECE_LIMIT = 100_000  # pieces, and as many of an older half
WORD_LIMIT = 400_000  # words, likewise; the older half is dropped when a task ends


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Encodes one piece of bytes after the other."""

    def __init__(self, ranks: dict[bytes, int], limit: int = STEP_LIMIT):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                step = node << 8 | byte
                if step not in self.child:
                    self.child[step] = len(self.token_at)
                    self.token_at.append(-1)
                node = self.child[step]
            self.token_at[node] = rank
        self.fits: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.prefix: dict[int, int] = {}
        self.longest: dict[bytes, int] = {}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.widest = max(map(len, ranks))
        self.limit = limit
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._state((-1, (((), 0),)))

    def _state(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        return self.number[state]

    def merge(self, text: bytes, stop: int = 1) -> list[int]:
        """BPE by its definition: join the lowest-ranked neighbours, leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > stop:
            pairs = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [rank for rank in pairs if rank is not None]
            if not known:
                break
            at = pairs.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            parts = self.merge(self.bytes_of[token], stop=2)
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether BPE of both tokens' bytes gives these two tokens again.

        Merging goes by rising rank, so time is a rank.  Going back in time
        from the finished tokens, the ones at the seam are split, the later
        made first (of equal ranks, the right one, because merges go from the
        left).  If a pair that once met at the seam could have merged before
        either was used up, it would have.
        """
        bytes_of, ranks = self.bytes_of, self.ranks
        used_left = used_right = len(bytes_of) + 256
        while True:
            joint = ranks.get(bytes_of[left] + bytes_of[right])
            if joint is not None and joint < used_left and joint <= used_right:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                used_left, left = left, a[1]
            else:
                used_right, right = right, b[0]

    def _fit(self, before: int, token: int) -> bool:
        pair = before << 32 | token
        fit = self.fits.get(pair)
        if fit is None:
            if len(self.fits) >= PAIR_LIMIT:
                self.fits.clear()
            fit = self.fits[pair] = before < 0 or self._compatible(before, token)
        return fit

    def _advance(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the step from a state by a byte: the next state and what it emits."""
        last, hypotheses = self.states[state]
        alive, ended = [], None
        for tail, node in hypotheses:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            alive.append((tail, node))
            token = self.token_at[node]
            # at most one sequence can end here
            if token >= 0 and ended is None and self._fit(tail[-1] if tail else last, token):
                ended = (tail + (token,), 0)
        if ended:  # always in the order of their token's start
            alive.append(ended)
        first = alive[0][0]
        agreed = min(len(tail) for tail, _ in alive)
        while any(tail[:agreed] != first[:agreed] for tail, _ in alive):
            agreed -= 1
        emitted = first[:agreed]
        rest = tuple((tail[agreed:], node) for tail, node in alive)
        step = self._state((emitted[-1] if emitted else last, rest)), emitted
        self.steps[state << 8 | byte] = step
        return step

    def _shorter(self, token: int) -> int:
        """The longest token that this one begins with; -1 for a single byte."""
        found = self.prefix.get(token)
        if found is None:
            whole = self.bytes_of[token]
            begins = (self.ranks.get(whole[:k]) for k in range(len(whole) - 1, 0, -1))
            found = self.prefix[token] = next((r for r in begins if r is not None), -1)
        return found

    def _walk(self, piece: bytes, at: int) -> int:
        """The longest token that begins at a place; remembered if its first bytes decide it."""
        child, token_at = self.child.get, self.token_at
        node, token, walked = 0, -1, 0
        for byte in piece[at : at + self.widest]:
            node = child(node << 8 | byte)
            walked += 1
            if node is None:
                break
            if token_at[node] >= 0:
                token = token_at[node]
        if node is None and walked <= START:
            if len(self.longest) >= START_LIMIT:
                self.longest.clear()
            self.longest[piece[at : at + START]] = token
        return token

    def _simulate(self, piece: bytes, out: list[int]) -> list[int]:
        """The same without deterministic states: one hypothesis after the other.

        ``out`` holds the tokens that all hypotheses agreed on so far.  Longest
        tokens come first, and where no token goes on, the last one is taken
        back for a shorter.  The bytes up to a place have one sequence only, so
        a place that led nowhere is not tried again, and the number of trials
        is linear in the bytes.
        """
        size, length, fits, longest = len(piece), self.length, self.fits, self.longest.get
        nowhere: set[int] = set()
        at, before, token = sum(map(length.__getitem__, out)), out[-1] if out else -1, -1
        while at < size:
            if token < 0:
                token = longest(piece[at : at + START], -1)
                if token < 0:
                    token = self._walk(piece, at)
            end = at + length[token]
            if end not in nowhere:
                fit = fits.get(before << 32 | token)
                if fit or (fit is None and self._fit(before, token)):
                    out.append(token)
                    at, before, token = end, token, -1
                    continue
            token = self._shorter(token)
            if token < 0:
                nowhere.add(at)
                token = out.pop()
                at -= length[token]
                before = out[-1] if out else -1
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, steps = 0, self.steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                if len(steps) >= self.limit:
                    return self._simulate(piece, out)
                step = self._advance(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        if piece:
            out += next(tail for tail, node in self.states[state][1] if node == 0)
        return out


class Memory(dict):
    """Packed ids of strings, made when first asked for.

    When full, the entries become the older half; those still in use come back.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int = PIECE_LIMIT):
        super().__init__()
        self.make, self.limit = make, limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        packed = self.older.get(key)
        if packed is None:
            packed = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = packed
        return packed


class Encoder:
    """Splits a text by the pattern and encodes each match separately.

    No match reaches over a space between two characters that are not white
    space, other than by starting with it; so the words between such spaces
    can be split one by one, and frequent ones are remembered.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find = regex.compile(pattern).findall
        self.between = re.compile(r"(?<=\S) (?=\S)").split
        self.transducer = Transducer(ranks)
        self.pieces = Memory(self._piece)
        self.later = Memory(self._word, WORD_LIMIT)

    def _piece(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        found = self.find(" " + word)
        if len(found) == 1:  # remembered as a word, so not as a piece
            return self._piece(found[0])
        return b"".join(map(self.pieces.__getitem__, found))

    def words(self, text: str) -> list[str]:
        """A text cut at the spaces between two characters that are not white space."""
        simple = (
            text[:1] != " "
            and text[-1:] != " "
            and not any(pair in text for pair in ("  ", " \n", "\n "))
            and text.replace("\n", "").isprintable()  # so it has no other white space
        )
        return text.split(" ") if simple else self.between(text)

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def rest(self) -> None:
        """Between tasks, keep only what was in use last."""
        self.pieces.older = {}
        self.later.older = {}

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        first, *later = self.words(text)
        return self._split(first) + b"".join(map(self.later.__getitem__, later))


def _wanted(lead: int) -> tuple[int, int, int]:
    """Continuation bytes after a lead byte and the range of the first of them."""
    if 0xC2 <= lead <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= lead <= 0xEF:
        return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
    if 0xF0 <= lead <= 0xF4:
        return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
    return 0, 0, 0


class Decoder:
    """Incremental UTF-8: feed ids, get text; bad bytes become U+FFFD."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        alone = ((token, self._step(b"", token)) for token in bytes_of)
        self.whole = {token: text for token, (text, held) in alone if not held and "�" not in text}

    def _step(self, held: bytes, token: int) -> tuple[str, bytes]:
        out: list[str] = []
        for value in self.bytes_of[token]:
            if held:
                more, low, high = _wanted(held[0])
                if (low if len(held) == 1 else 0x80) <= value <= (high if len(held) == 1 else 0xBF):
                    held += bytes([value])
                    if len(held) > more:
                        out.append(held.decode())
                        held = b""
                    continue
                out.append("�")
                held = b""
            if value < 0x80:
                out.append(chr(value))
            elif _wanted(value)[0]:
                held = bytes([value])
            else:
                out.append("�")
        return "".join(out), held

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as soon as its characters are complete."""
        held, steps = b"", self.steps.setdefault(b"", {})
        for token in ids:
            step = steps.get(token)
            if step is None:
                step = steps[token] = self._step(held, token)
            text, after = step
            if after != held:
                held, steps = after, self.steps.setdefault(after, {})
            yield text
        if held:
            yield "�"

    def text(self, ids: Sequence[int]) -> str:
        """The whole text; where every token is whole characters, no state is needed."""
        parts = list(map(self.whole.get, ids))
        return "".join(self.stream(ids) if None in parts else parts)


_MACHINES: dict[tuple[str, str], tuple[Encoder, Decoder]] = {}


def machines(path: str, pattern: str) -> tuple[Encoder, Decoder]:
    """The encoder and decoder of a rank file, kept for the life of the process."""
    if (path, pattern) not in _MACHINES:
        ranks = read_ranks(path)
        decoder = Decoder({rank: token for token, rank in ranks.items()})
        _MACHINES[path, pattern] = Encoder(ranks, pattern), decoder
    return _MACHINES[path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) of every text.

    A NULL or empty text has no ids; repeated rows are encoded each.  Other
    columns of ``docs`` are ignored.
    """

    def run(batches):
        encoder, _ = machines(ranks_path, pattern)
        for batch in batches:
            packed = [encoder.packed(text) for text in batch["text"].to_pylist()]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])
        encoder.rest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``text`` of every row of ``doc_id``, ``ids``; NULL ids give an empty text."""

    def run(batches):
        _, decoder = machines(ranks_path, pattern)
        for batch in batches:
            out = [decoder.text(ids or ()) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids again, and return digests of both.

    Columns ``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``;
    one row per row of ``docs``, NULL text as empty.
    """

    def run(batches):
        encoder, decoder = machines(ranks_path, pattern)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch["text"]:
                packed = encoder.packed(text.as_py())
                counts.append(len(packed) // 4)
                coded.append(hashlib.sha256(packed).hexdigest())
                back = decoder.text(np.frombuffer(packed, "<u4").tolist())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        encoder.rest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
