from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from footfall.llm import align
from footfall.llm.align import Aligner, Fragment
from footfall.llm.queries import BYTES, PIECES, op11_align
from tests.llm.frames import AWKWARD, awkward, documents, noise

A = Tokenizer.from_file(BYTES)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LETTERS = Aligner(BYTES, PIECES)
ZERO = (0, 0, 0, "")


def spans(text):
    """Both token sequences with the bytes of each token, or None."""
    if not text:
        return None
    full = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    byte = {v: k for k, v in align_bytes().items()}
    a_bytes = [bytes(byte[ch] for ch in A.id_to_token(i)) for i in a]
    b_bytes = []
    for i in b:
        piece = B.id_to_piece(i)
        b_bytes.append(
            bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()
        )
    if b"".join(a_bytes) != full or b"".join(b_bytes) != full:
        return None
    return list(zip(a, a_bytes)), list(zip(b, b_bytes))


def align_bytes():
    from footfall.llm.byte_level import byte_letters

    return byte_letters()


def by_hand(text):
    """Groups as lists of ids, walking both sequences byte by byte."""
    both = spans(text)
    if both is None:
        return []
    (a, b), groups = both, []
    i = j = x = y = 0
    left, right = [], []
    while i < len(a) or j < len(b):
        if x <= y:
            left.append(a[i][0])
            x += len(a[i][1])
            i += 1
        else:
            right.append(b[j][0])
            y += len(b[j][1])
            j += 1
        if x == y:
            groups.append((left, right))
            left, right = [], []
    return groups


def said(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def figures(text):
    groups = by_hand(text)
    return (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
            said(groups))


def one(text, chunk):
    """A text cut into ranges of ``chunk`` bytes and put together from the left."""
    data = b" " + text.encode()
    parts = [LETTERS.ranges(data, k, chunk) for k in "ab"]
    a_at = b_at = 0
    made = []
    for a, b in zip(*parts):
        made.append(LETTERS.fragment(a, a_at, b, b_at))
        a_at, b_at = a_at + len(a), b_at + len(b)
    return made


def folded(made, order):
    made = list(made)
    while len(made) > 1:
        i = order.randrange(len(made) - 1)
        made[i : i + 2] = [LETTERS.join(made[i], made[i + 1])]
    return LETTERS.finish(made[0])


TEXTS = [
    *noise("ab cdé\n.,漢😀'st 12\t", 150, 200),
    *noise("the of and in, re.\n", 60, 300),
    "a  b   c    d", " ", "  ", "\n\n", "x" * 400, "<s>a</s><unk> <|endoftext|>", "ﬁ ½ é",
    "1.2.3 it's we'll  \n  end ", "no▁tokens", "tab\tand\x00nul", "漢字漢字 漢字",
]


@pytest.mark.parametrize("chunk", [3, 17, 64, 1 << 16])
def test_ranges_give_what_whole_texts_give(chunk):
    order = random.Random(1)
    for text in filter(None, TEXTS):
        made = one(text, chunk)
        for _ in range(2):  # in any order of brackets
            got = folded(made, order)
            assert (got.n_a, got.n_b, got.groups, got.text.decode()) == figures(text), repr(text)


def test_nothing_is_neutral():
    for text in ("some words here", "x"):
        (f,) = one(text, 1 << 16)
        for joined in (LETTERS.join(Fragment(), f), LETTERS.join(f, Fragment())):
            done = LETTERS.finish(joined)
            assert (done.groups, done.text) == (LETTERS.finish(f).groups, LETTERS.finish(f).text)


@pytest.mark.parametrize("chunk", [40, 1 << 16])
def test_awkward_rows(spark, chunk):
    rows = [*AWKWARD, (10, "no▁tokens " * 9), (11, "a few words, more than a range of them\n" * 9)]
    frame = awkward(spark, rows)
    want = sorted((d, *figures(t)) for d, t in rows if d is not None)
    got = align.align(frame, BYTES, PIECES, chunk).where("doc_id IS NOT NULL").collect()
    assert sorted(map(tuple, got)) == want
    counted = align.link_counts(frame, BYTES, PIECES, chunk)
    assert sorted(map(tuple, counted.collect()), key=repr) == links_by_hand(rows)
    empty = awkward(spark, [])
    assert align.align(empty, BYTES, PIECES, chunk).count() == 0
    assert align.link_counts(empty, BYTES, PIECES, chunk).count() == 0


def links_by_hand(rows):
    made = [(d, by_hand(t)) for d, t in rows]
    pairs = Counter((a[-1], b[-1]) for _, groups in made for a, b in groups)
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = []
    for doc, groups in made:
        links = [(a[-1], b[-1]) for a, b in groups]
        n_best = sum(pairs[x] == best[x[1]] for x in links)
        digest = hashlib.sha256(said(groups).encode()).hexdigest() if groups else ""
        out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups),
                    len(groups), len(links), n_best, sum(pairs[x] for x in links), digest))
    return sorted(out, key=repr)


def test_blocks_do_not_show(spark):
    rows = [(i, t) for i, t in enumerate(noise("the of and in, re.\n", 120, 200))]
    frame = awkward(spark, rows).repartition(3)
    counted = align.link_counts(frame, BYTES, PIECES, chunk=100, block_links=500)
    assert sorted(map(tuple, counted.collect()), key=repr) == links_by_hand(rows)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = op11_align(spark, sf_dir).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == links_by_hand(rows)
