from __future__ import annotations

import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import bpe
from footfall.llm.queries import PATTERN, RANKS, op5_bpe
from tests.llm.frames import awkward, documents, noise

MACHINES = bpe.machines(RANKS, PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
)


def ids(text):
    packed = MACHINES[0].packed(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert MACHINES[1].text(ids(text)) == text


@pytest.mark.parametrize("limit", [0, 50, 10**6])
def test_deterministic_steps_and_simulation_agree(limit):
    machine = bpe.Transducer(bpe.read_ranks(RANKS), limit)
    for text in noise("abcdetion é漢=-0", 400, 30) + ["a" * 999, "=-" * 500, " " * 777]:
        if text:
            assert machine.encode(text.encode()) == LIBRARY._encode_single_piece(text)


def test_simulation_goes_on_behind_agreed_tokens():
    machine = bpe.Transducer(bpe.read_ranks(RANKS), 300)
    begun = []
    simulate = machine._simulate
    machine._simulate = lambda piece, out: begun.append(len(out)) or simulate(piece, out)
    for text in noise("abcdetion", 400, 40):
        if text:
            assert machine.encode(text.encode()) == LIBRARY._encode_single_piece(text)
    assert max(begun) > 1


def test_beginnings_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(bpe, "START_LIMIT", 20)
    machine = bpe.Transducer(bpe.read_ranks(RANKS), 0)
    for text in noise("abcdetion é漢=-0", 400, 30):
        if text:
            assert machine.encode(text.encode()) == LIBRARY._encode_single_piece(text)
            assert len(machine.longest) <= 20
    assert machine.longest


def test_words_are_cut_alike_with_and_without_a_pattern():
    for text in noise("ab  \n\t\x1c\x85 \u3000'\u200b", 5000, 9) + noise("ab \n", 3000, 9):
        assert MACHINES[0].words(text) == MACHINES[0].between(text), repr(text)


def test_spaces_between_words():
    for text in noise("ab  \n\t\x1c 　'st,", 3000, 12):
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_decoder_replaces_bad_bytes():
    decoder = bpe.Decoder({i: bytes([i]) for i in range(256)})
    for raw in (b"\xe2\x82", b"\xff\xe2\x82\xacx", b"\xed\xa0\x80", b"\xf0\x9f\x98a", b"\xc3\xa9"):
        assert "".join(decoder.stream(list(raw))) == raw.decode(errors="replace")


def test_other_ranks():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "m", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={}
    )
    encoder, _ = bpe.machines(path, PATTERN)
    for text in noise("abtionß еи漢字 é'", 800, 25):
        packed = encoder.packed(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(text)


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = bpe.encode(frame, RANKS, PATTERN)
    back = bpe.decode(rows, RANKS, PATTERN).collect()
    assert sorted(r.text for r in back) == sorted(r.text or "" for r in frame.collect())
    assert bpe.digests(frame, RANKS, PATTERN).count() == 11
    assert bpe.digests(awkward(spark, []), RANKS, PATTERN).count() == 0


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    for r in op5_bpe(spark, sf_dir).collect():
        want = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        packed = struct.pack(f"<{len(want)}I", *want)
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
