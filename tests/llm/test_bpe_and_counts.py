"""Token counts and token files against the tokenizers library itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import bpe, token_counts, token_files
from tidewater.llm.queries import BPE, PIECES, tokenizer_path

ODD = [None, "", " ", "\n\n", "word", "don't,.. it's!! a b 　 c\x1cd é. É, ñ's  \n\n  x ", "foo<|endoftext|>bar, <|endoftext|>.x", "漢字 かな 🎉🎉", "a" * 5000, "ab, cd. " * 3000]
COUNTS = "doc_id long, text string, n_tokens string, ID int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(BPE))


def ids_by_library(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def all_ids(encoder, texts):
    out = [[] for _ in texts]
    for a, b, ids, counts, _ in encoder.ids_of(pa.array(texts, pa.string())):
        ends = np.cumsum(counts)
        for row, low, high in zip(range(a, b), ends - counts, ends):
            out[row] += ids[low:high].tolist()
    return out


@pytest.mark.parametrize("slice_bytes", [64, 1000, 4 << 20])
def test_ids_of_whole_texts(library, monkeypatch, slice_bytes):
    monkeypatch.setattr(bpe, "SLICE_BYTES", slice_bytes)
    encoder = bpe.ChunkEncoder(tokenizer_path(BPE))
    want = [ids_by_library(library, x) for x in ODD]
    assert all_ids(encoder, ODD) == want
    assert encoder.lengths_of(pa.array(ODD, pa.string())).tolist() == [len(x) for x in want]


def test_memo_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_CHUNKS", 50)
    encoder = bpe.ChunkEncoder(tokenizer_path(BPE))
    for k in range(5):
        texts = [f"w{k}x{i} and" for i in range(40)]
        assert all_ids(encoder, texts) == [ids_by_library(library, x) for x in texts]
        assert len(encoder.place) <= 50 + 90


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aé'.,!<|> \n\t1　s")), max_size=40), max_size=6))
def test_cuts_never_change_the_ids(texts):
    library = Tokenizer.from_file(tokenizer_path(BPE))
    assert all_ids(bpe.encoder(tokenizer_path(BPE), True), texts) == [ids_by_library(library, x) for x in texts]


def test_counts_of_odd_rows(spark, library):
    rows = [(i, x, "clash", 1) for i, x in enumerate(ODD)] + [(None, "null id", None, None), (4, "word", None, 1), (4, "word", None, 1)]
    got = token_counts.token_counts(spark.createDataFrame(rows, COUNTS), tokenizer_path(BPE), limit=10)
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n := len(ids_by_library(library, r[1])), n > 10) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_counts_of_an_empty_table_and_of_pieces(spark):
    import sentencepiece

    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(empty, tokenizer_path(BPE)).collect() == []
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, tokenizer_path(PIECES)).collect()}
    assert got == {i: len(model.encode(x or "")) for i, x in enumerate(ODD)}


def test_files_hold_every_document_in_order(spark, library):
    rows = [(7 * i % 10 if i < 10 else 100 + i, ODD[i % len(ODD)], "x") for i in range(25)] + [(None, "null id", "x"), (3, "tie", "x"), (3, "tie", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one shard holds so few rows
    try:
        manifest = token_files.write_ids(docs, tokenizer_path(BPE))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    shards = manifest.collect()
    assert {r.width for r in shards} == {2} and len(shards) > 1
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_ids(manifest).collect())
    assert [r[1] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    left = {}
    for doc_id, text, _ in rows:
        left.setdefault(doc_id, []).append(ids_by_library(library, text) + [token_files.END_ID])
    for start, doc_id, n, crc in got:
        assert start == at
        at += n
        ids = next(x for x in left[doc_id] if len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc)
        left[doc_id].remove(ids)
    assert not any(left.values())


def test_files_of_an_empty_table(spark):
    manifest = token_files.write_ids(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path(BPE))
    assert manifest.collect() == [] and token_files.read_ids(manifest).collect() == []
