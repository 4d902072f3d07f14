from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tidemark.llm import catalog, nbest

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the cat", "a  b", "é😀x", "hello, wor", "ab\ncd", "  ", " x ", "日本", "1,000.5!", "naïve"]


@pytest.fixture(scope="module")
def tool():
    return nbest.Segmenter(PATH, 4)


def every_way(lattice, text):
    """All segmentations of a string with their scores, best first."""
    pieces, out = {k: v for k, v in lattice.known.items() if v}, []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, ids))
        for end in range(at + 1, len(text) + 1):
            found = pieces.get(text[at:end])
            if found:
                go(end, score + found[0], ids + found[1])
            elif end == at + 1:
                go(end, score + lattice.unknown, ids + b"".join(lattice.raw_bytes[b] for b in text[at].encode()))

    go(0, 0.0, b"")
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", TEXTS)
def test_best_paths_equal_brute_force(tool, text):
    ways, found = every_way(tool.lattice, tool.normalize(text)), tool.encode(text)
    assert [score for score, _ in found] == [score for score, _ in ways[:4]]
    assert len({ids for _, ids in found}) == len(found)
    assert all((score, ids) in ways for score, ids in found)
    assert all(tool.decode(ids) == text for _, ids in found)


def test_search_alone_equals_cut_and_brute_force(tool):
    text = "▁segmenting"
    ways = every_way(tool.lattice, text)
    for n in (1, 2, 7, 30):
        assert [s for s, _ in tool.lattice.search(text, n)] == [s for s, _ in ways[:n]]
        assert [s for s, _ in tool.lattice.cut(text, n)] == [s for s, _ in ways[:n]]


def test_decoding_agrees_with_the_library(tool, spark, sf_dir):
    model = SentencePieceProcessor(model_file=PATH)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect():
        ids = model.encode(r.text)
        assert tool.decode(np.array(ids, "<u4").tobytes()) == r.text
        for _, own in tool.encode(r.text):
            assert model.decode(np.frombuffer(own, "<u4").tolist()) == r.text


def test_query_ranks_and_round_trips(spark, sf_dir):
    rows = catalog.op9_nbest_pieces(spark, sf_dir).collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r["rank"])):
        by_doc.setdefault(r.doc_id, []).append(r)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert set(by_doc) == {d.doc_id for d in docs}
    single, model = nbest.Segmenter(PATH, 1), SentencePieceProcessor(model_file=PATH)
    score = {i: model.get_score(i) for i in range(model.get_piece_size())}
    for d in docs:
        own = by_doc[d.doc_id]
        assert all(r.round_trip for r in own) and [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [r.score for r in own] == sorted((r.score for r in own), reverse=True)
        assert len({r.ids_crc32 for r in own}) == len(own)
        best, ids = single.encode(d.text)[0]
        assert (own[0].score, own[0].ids_crc32) == (best, zlib.crc32(ids))
        taken = model.encode(d.text)  # the library merges by rank; no cut scores better than the best path
        if all(not model.is_byte(i) for i in taken):
            assert own[0].score >= sum(score[i] for i in taken) - 1e-6


def test_null_empty_long_and_repeated_texts(docs_of, empty_docs):
    long = "aaaa " * 30_000 + "b" * 3000
    rows = nbest.segmentations(docs_of((1, None), (2, ""), (3, long), (4, "x"), (4, "x"), (None, "y ▁")), PATH).collect()
    assert [(r["rank"], r.score, r.n_pieces, r.ids, r.round_trip) for r in rows if r.doc_id in (1, 2)] == [(1, 0.0, 0, [], True)] * 2
    assert [r["rank"] for r in rows if r.doc_id == 3] == [1, 2, 3] and all(r.round_trip for r in rows if r.doc_id in (3, 4))
    assert len({tuple(r.ids) for r in rows if r.doc_id == 3}) == 3
    assert not any(r.round_trip for r in rows if r.doc_id is None)
    assert nbest.segmentations(empty_docs, PATH).collect() == []


def test_best_and_its_loss_equal_the_search(tool):
    rng = np.random.default_rng(4)
    texts = ["▁", "é", "😀", "▁segmenting", "日本語", "aaaaaaaaaaaa", "x퟿"]
    texts += ["".join(rng.choice(list("▁abdeinorst,.é日"), rng.integers(1, 14))) for _ in range(400)]
    for text in texts:
        (score, ids), *more = tool.lattice.search(text, 2)
        best = tool.lattice.best(text)
        assert best[0] == ids and best[1] == pytest.approx(score)
        assert best[2] == (pytest.approx(score - more[0][0], abs=1e-9) if more else np.inf)
    assert tool.lattice.parts_of_many(texts) == [tool.lattice.parts(text) for text in texts]
    for size in {len(text) for text in texts}:
        alike = [text for text in texts if len(text) == size]
        assert tool.lattice.best_of_many(alike) == [tool.lattice.best(text) for text in alike]


def test_learnt_words_equal_words_met_alone(tool, monkeypatch):
    rng = np.random.default_rng(5)
    words = {"▁" + "".join(rng.choice(list("abdeinorst,.é日"), rng.integers(1, 9))) for _ in range(700)}
    monkeypatch.setattr(nbest, "MANY", 2)
    monkeypatch.setattr(nbest, "REMEMBERED", 300)
    learnt, alone = nbest._Words(tool.lattice), nbest._Words(tool.lattice)
    learnt.learn(words)
    learnt.learn(set())
    assert {w: learnt[w] for w in words} == {w: alone[w] for w in words}
    assert len(alone) <= 300 and len(alone.older) <= 300
