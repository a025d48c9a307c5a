from __future__ import annotations

import json
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from footfall.llm import packing
from footfall.llm.byte_level import ByteLevel
from footfall.llm.packing import Piece, SumOfSquares
from footfall.llm.queries import BYTES, WORDS, op12_packing
from tests.llm.frames import AWKWARD, awkward, documents, noise

LIBRARY = Tokenizer.from_file(BYTES)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def slow_choice(counts, length, size):
    """Least sum of squares over all levels, by adding it up."""
    best = None
    for level in range(size - length, -1, -1):
        if level == 0 or counts.get(level, 0) > 0:
            after = dict(counts)
            if level:
                after[level] -= 1
            if level + length < size:
                after[level + length] = after.get(level + length, 0) + 1
            cost = sum(n * n for n in after.values())
            if best is None or cost < best[0]:
                best = (cost, level)
    return best[1]


def test_levels_are_chosen_by_the_sum_of_squares():
    rnd, packer, counts = random.Random(3), SumOfSquares(32, 10**9), {}
    for _ in range(500):
        length = rnd.randint(1, 31)
        level = packer.choose(length)
        assert level == slow_choice(counts, length, 32)
        list(packer.put(Piece(0, 0, np.zeros(length, np.uint32), length)))
        counts = {h: int(n) for h, n in enumerate(packer.levels) if n}


@pytest.mark.parametrize("most_open", [1, 3, 1024])
def test_every_id_is_packed_once_whatever_the_limit(most_open):
    rnd, packer = random.Random(4), SumOfSquares(64, most_open)
    docs = [np.arange(rnd.choice([1, 40, 63, 64, 65, 300]), dtype=np.uint32) for _ in range(300)]
    done = []
    for i, doc in enumerate(docs):
        done += packer.put(Piece(i, 0, doc, len(doc)))
        assert packer.open <= most_open + 1
    done += packer.finish()
    back = defaultdict(dict)
    for sequence in done:
        assert sequence.fill == sum(len(p.ids) for p in sequence.pieces)
        assert sequence.fill == 64 or sequence.fill.bit_count() == 1
        for p in sequence.pieces:
            assert p.start not in back[p.doc] and len(p.ids)
            back[p.doc][p.start] = p.ids
    for i, doc in enumerate(docs):
        assert np.array_equal(np.concatenate([back[i][s] for s in sorted(back[i])]), doc)


def read_back(rows):
    """Ids of every (doc, document length) from pieces, and the sequences' lengths."""
    places, texts = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id].append((r.start, bytes(r.ids)))
    lengths = []
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    return texts, lengths


def test_awkward_rows(spark):
    rows = packing.pack(awkward(spark), BYTES).collect()
    texts, lengths = read_back(rows)
    want = defaultdict(list)
    for doc, text in AWKWARD:
        want[doc].append(ids(text))
    for doc, found in texts.items():
        total = sum(len(part) // 4 for _, part in found)
        assert total == sum(map(len, want[doc]))
        if len(want[doc]) == 1:
            joined = b"".join(part for _, part in sorted(found))
            assert joined == struct.pack(f"<{total}I", *want[doc][0])
    assert all(n <= 2048 and (n == 2048 or n.bit_count() == 1) for n in lengths)
    assert packing.pack(awkward(spark, []), BYTES).count() == 0


def test_query(spark, sf_dir):
    rows = op12_packing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    assert {r.doc_id for r in rows} == set(texts)
    places, ends = defaultdict(list), defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        every = ids(texts[r.doc_id])
        part = every[r.start : r.start + r.length]
        assert r.start == ends[r.doc_id] and r.doc_tokens == len(every)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        ends[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert all(ends[d] == len(ids(t)) for d, t in texts.items())
    full = 0
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or at.bit_count() == 1
        full += at == 2048
    assert full >= sum(ends.values()) // 2048 - 8


def test_ids_are_the_librarys():
    plain = ByteLevel(BYTES, special=True)
    assert plain.ranks is not None
    texts = noise("abAB'sté \n\t\x1c\x85 ́.,!0１²Σ漢😀​", 1500, 30)
    texts += ["<|endoftext|>", "a<|endoftext|>b", "it's 'tis", "", "  ", "x" * 50_000]
    for text in texts:
        assert plain.ids(text).tolist() == ids(text)[:-1], repr(text)
    ordinary, library = ByteLevel(BYTES, special=False), Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert ordinary.ids(text).tolist() == want, repr(text)


def test_all_letters_are_split_alike():
    plain = ByteLevel(BYTES, special=False)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}a1{c}1 {c}.{c} {c}{c}\n{c} " for c in every[:0x3000] + every[0x3000::23]]
    library = plain.library().encode_batch(texts, add_special_tokens=False)
    assert all(plain.ids(t).tolist() == e.ids for t, e in zip(texts, library))


def test_other_files_go_to_the_library(tmp_path):
    other = ByteLevel(WORDS, special=True)
    assert other.ranks is None
    library = Tokenizer.from_file(WORDS)
    assert other.ids("A b").tolist() == library.encode("A b", add_special_tokens=False).ids
    spec = json.loads(open(BYTES).read())
    spec["pre_tokenizer"]["add_prefix_space"] = True
    changed = tmp_path / "t.json"
    changed.write_text(json.dumps(spec))
    assert ByteLevel(str(changed), special=True).ranks is None
