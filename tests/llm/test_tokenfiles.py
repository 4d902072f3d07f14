from __future__ import annotations

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tidemark.llm import catalog, tokenfiles
from tidemark.session import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_query_equals_the_tokenizer_in_document_order(spark, sf_dir):
    rows = {r.doc_id: r for r in catalog.op7_token_files(spark, sf_dir).collect()}
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    tokenizer = Tokenizer.from_file(PATH)
    at = 0
    for doc, found in zip(docs, tokenizer.encode_batch([d.text or "" for d in docs], add_special_tokens=False), strict=True):
        ids = np.array([*found.ids, 1], "<u4")
        r = rows[doc.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_are_ordered_encoded_and_indexed(spark, sf_dir):
    path = new_folder(spark, "tokens")
    tokenfiles.write_tokens(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), path, PATH, 1, row_group_bytes=64 << 10, page_bytes=8 << 10
    )
    last = -1
    rows = tokenfiles.read_tokens(spark, path).orderBy("part", "start_in_part").collect()
    for r in rows:
        assert r.doc_id > last and r.n_tokens == len(r.ids)
        last = r.doc_id
    file = pq.ParquetFile(max(glob.glob(path.removeprefix("file:") + "/*.parquet")))
    chunk = {c.path_in_schema.split(".")[0]: c for c in map(file.metadata.row_group(0).column, range(5))}
    assert "DELTA_BINARY_PACKED" in chunk["doc_id"].encodings and "DELTA_BINARY_PACKED" in chunk["start_in_part"].encodings
    assert any("DICTIONARY" in e for e in chunk["ids"].encodings)
    assert chunk["doc_id"].has_offset_index and chunk["doc_id"].has_column_index
    assert file.metadata.num_row_groups > 1
    one = tokenfiles.read_tokens(spark, path).filter("doc_id = 7").select("n_tokens")
    plan = one._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan


def test_null_empty_and_repeated_rows(spark, docs_of, empty_docs):
    path = new_folder(spark, "tokens")
    tokenfiles.write_tokens(docs_of((5, "b a"), (None, "a"), (3, None), (5, "b a"), (4, "")), path, PATH, 1)
    rows = tokenfiles.read_index(spark, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 2), (3, 2, 1), (4, 3, 1), (5, 4, 3), (5, 7, 3)]
    path = new_folder(spark, "tokens")
    tokenfiles.write_tokens(empty_docs, path, PATH, 1)
    assert tokenfiles.read_index(spark, path).collect() == []
