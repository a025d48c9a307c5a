from __future__ import annotations

import json
import struct
import zlib
from pathlib import Path

import pyarrow.parquet as pq
from tokenizers import Tokenizer

from footfall.llm import token_store
from footfall.llm.queries import BYTES, WORDS, op9_token_store
from tests.llm.frames import awkward, documents, noise

LIBRARY = Tokenizer.from_file(WORDS)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def packed(values):
    return struct.pack(f"<{len(values)}i", *values)


def test_words_one_by_one_equal_the_library():
    encoder = token_store.WordEncoder(WORDS, 1)
    texts = noise("abcAB'stélÉ 　\n\t\x1c\x85 ́.,!0１２Σς漢😀", 2000, 40)
    texts += ["<|endoftext|>", "a<|endoftext|>b", "it's 'tis", "", "  ", "Σ ς"]
    for text, found in zip(texts, encoder.packed(texts)):
        assert found == packed(ids(text)), repr(text)


def test_letters_of_all_scripts_equal_the_library():
    encoder = token_store.WordEncoder(WORDS, 1)
    assert encoder.plain
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}a1{c}1 {c}.{c} {c}{c}\n{c} 's'{c}A" for c in every[:0x3000] + every[0x3000::23]]
    library = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert all(encoder.text(t) == packed(e.ids) for t, e in zip(texts, library))


def test_other_files_go_to_the_library(tmp_path):
    texts = ["A b's 12", "<|endoftext|>", "ß É"]
    spec = json.loads(Path(WORDS).read_text())
    del spec["normalizer"]["normalizers"][2]
    (tmp_path / "cased.json").write_text(json.dumps(spec))
    for path in (str(tmp_path / "cased.json"), BYTES):
        encoder, library = token_store.WordEncoder(path, 1), Tokenizer.from_file(path)
        assert not encoder.plain
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [encoder.text(t) for t in texts] == list(map(packed, want))


def test_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    token_store.write(frame, f"{tmp_path}/t", WORDS)
    got = token_store.digests(spark, f"{tmp_path}/t").collect()
    assert sum(r.n_tokens for r in got) == sum(len(ids(r.text)) for r in frame.collect())
    assert len(got) == 11 and len({r.start for r in got}) == 11
    token_store.write(awkward(spark, []), f"{tmp_path}/none", WORDS)
    assert token_store.digests(spark, f"{tmp_path}/none").count() == 0


def test_layout_and_selective_reads(spark, sf_dir, tmp_path):
    docs = documents(spark, sf_dir)
    token_store.write(docs, f"{tmp_path}/t", WORDS)
    files = sorted(Path(f"{tmp_path}/t").glob("*.parquet"))
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(4)
    assert column.physical_type == "INT32" and column.has_offset_index
    plan = token_store.metadata(spark, f"{tmp_path}/t")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    few = {r.doc_id: r.ids for r in token_store.tokens(spark, f"{tmp_path}/t", 5, 9).collect()}
    texts = {r.doc_id: r.text for r in docs.where("doc_id between 5 and 9").collect()}
    assert few == {i: ids(t) for i, t in texts.items()}


def test_query(spark, sf_dir):
    start = 0
    rows = {r.doc_id: r for r in op9_token_store(spark, sf_dir).collect()}
    for doc in documents(spark, sf_dir).orderBy("doc_id").collect():
        want, got = ids(doc.text), rows[doc.doc_id]
        assert (got.start, got.n_tokens) == (start, len(want))
        assert got.ids_crc32 == zlib.crc32(packed(want))
        start += len(want)


def test_stretches_between_spaces_equal_the_library():
    encoder = token_store.WordEncoder(WORDS, 1)
    assert encoder.by_spaces
    texts = noise("abC's1.,\n \t\x1c\x85\xa0\u2003\u3000", 3000, 30) + ["", " ", "\n", " a", "a\n\nb "]
    for text in texts:
        assert encoder.text(text) == packed(ids(text)[:-1]), repr(text)
    assert "" in encoder.known and any("," in part and "a" in part for part in encoder.known)


def test_stretches_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_WORDS", 30)
    encoder = token_store.WordEncoder(WORDS, 1)
    for text in noise("abc's1., \n", 2000, 40):
        assert encoder.text(text) == packed(ids(text)[:-1]), repr(text)
        assert len(encoder.known) <= 60


def test_ids_are_read_once_for_digests(spark, sf_dir, tmp_path):
    token_store.write(documents(spark, sf_dir), f"{tmp_path}/t", WORDS)
    plan = token_store.digests(spark, f"{tmp_path}/t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
