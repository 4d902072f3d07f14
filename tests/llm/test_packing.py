from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PythonException, SparkRuntimeException
from tokenizers import Tokenizer

from tidemark.llm import catalog, packing
from tidemark.llm.encoders import Encoder, encoder

ODD = [
    "", " ", "a", " a", "a ", "a  b", "\n", "a\nb", "a \nb", "a\n b", "a\n\n\nb", "a\tb", "x y", "don't we'll 's 't",
    "Σας ΟΔΟΣ ς", "İstanbul", "b́ éà", "日本語 テスト", "<|endoftext|> a<|endoftext|>", "12,000.50 a_b __x__ !!! (x)",
    "\x1c a\x85b", "café ÀÉ ß ÿ × ÷ ª", "a\r\nb", "😀😀 x", "“quoted” — dash…", "'s", "a's,", "x²y", "word!!!'s",
]


def ids_of(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_words_give_the_tokenizers_ids(name, spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    encoder = Encoder(public_tokenizers.path(name))
    for text, ids in zip(texts, ids_of(name, texts), strict=True):
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes(), text[:40]


def check_packed(rows, documents, capacity=1024):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(documents)
    for doc, ids in documents.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        assert all(r.length == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            own = ids[at : at + r.length]
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(np.array(own, "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_query_packs_all_documents_tightly(spark, sf_dir):
    rows = catalog.op1_sum_of_squares_packing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    encoded = ids_of("byte_bpe_50k.json", [r.text or "" for r in docs])
    documents = {r.doc_id: [*ids, 2] for r, ids in zip(docs, encoded, strict=True)}
    sequences = check_packed(rows, documents)
    assert sequences <= 1.03 * sum(map(len, documents.values())) / 1024 + 1


def test_null_empty_long_and_repeated_documents(docs_of):
    path = public_tokenizers.path("byte_bpe_50k.json")
    long = "one two three " * 1500
    docs = docs_of((1, None), (2, ""), (3, long), (4, "x"), (4, "x"), (None, "y"))
    rows = packing.packed_documents(docs, path, 2).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in rows if r.doc_id in (1, 2)) == [(1, 0, 1), (2, 0, 1)]
    assert len([r for r in rows if r.doc_id == 4]) == 2 and len([r for r in rows if r.doc_id is None]) == 1
    whole = [i for r in sorted((r for r in rows if r.doc_id == 3), key=lambda r: r.piece) for i in r.ids]
    assert whole == ids_of("byte_bpe_50k.json", [long])[0] + [2]


def test_empty_table_gives_no_rows(empty_docs):
    assert packing.packed_documents(empty_docs, public_tokenizers.path("byte_bpe_50k.json"), 2).collect() == []


def test_pack_keeps_other_columns_and_refuses_unfit_lengths(spark):
    schema = "doc_id long, length long, _group int, offset string"
    rows = packing.pack(spark.createDataFrame([(1, 600, 9, "o"), (2, 424, 8, "o"), (3, 1024, 7, "o")], schema)).collect()
    assert {(r.doc_id, r._group) for r in rows} == {(1, 9), (2, 8), (3, 7)}
    assert len({r.sequence_id for r in rows}) == 2
    with pytest.raises((SparkRuntimeException, PythonException)):
        packing.pack(spark.createDataFrame([(1, 1025, 0, "o")], schema)).collect()


def test_several_groups_are_packed_by_themselves(spark):
    pieces = spark.range(2000).selectExpr("id AS doc_id", "1 + id * 7919 % 1023 AS length")
    rows = packing.pack(pieces, group=500).collect()
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    assert len(rows) == 2000 and max(ends.values()) <= 1024
    assert {i >> 32 for i in ends} == {0, 1, 2, 3}


def test_the_rule_against_a_plain_account_of_squares():
    """Every first-pass choice leaves the smallest sum of squares."""
    lengths = np.sort(np.random.default_rng(1).integers(1, 32, 200))[::-1]
    gaps, where = packing._placed(lengths, 32, squares=True)
    left = {}
    for size, one in zip(lengths.tolist(), where.tolist(), strict=True):
        def squares(after):
            counts = np.bincount([g for g in after.values() if g > 0], minlength=33)
            return int((counts**2).sum())

        options = [squares({**left, k: g - size}) for k, g in left.items() if g >= size]
        options.append(squares({**left, -1: 32 - size}))
        left[one] = left.get(one, 32) - size
        assert squares(left) == min(options)
    assert [left[k] for k in sorted(left)] == gaps.tolist()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_control_strings_get_the_librarys_ids(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    texts = [*ODD, "a<|endoftext|> b", "<|startoftext|>x <|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "a  <|endoftext|>\n b"]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder(public_tokenizers.path(name)).encode(text) == np.array(ids, "<u4").tobytes(), text


def test_documents_with_control_strings_are_packed_with_the_librarys_ids(docs_of):
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "a<|endoftext|> b"
    ids = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]
    rows = packing.packed_documents(docs_of((1, text)), path, end_id=2, with_ids=False).collect()
    assert [(r.start, r.length, r.ids_crc32) for r in rows] == [(0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]
