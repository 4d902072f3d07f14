"""Corpus preparation, count tables and the sampler."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators.topics import corpus, counts, gibbs
from tidemark.plans import topics as plans
from tidemark.session import new_folder, store


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")


def test_tokens_and_edge_trim(spark):
    df = docs(spark, "'The  cat sat'", "'one'", "", " two\twords ")
    plain = {(r.doc_id, r.pos): r.word for r in corpus.lda_tokens(df).collect()}
    assert plain == {(0, 0): "'the", (0, 1): "cat", (0, 2): "sat'", (1, 0): "'one'", (3, 0): "two", (3, 1): "words"}
    trimmed = {(r.doc_id, r.pos): r.word for r in corpus.lda_tokens(df, edge_trim=True).collect()}
    # a document of one word loses its first character only
    assert trimmed == {(0, 0): "the", (0, 1): "cat", (0, 2): "sat", (1, 0): "one'", (3, 0): "wo", (3, 1): "word"}


def test_vocabulary_needs_five_documents(spark):
    df = docs(spark, *["common rare rare" if i < 4 else "common" for i in range(5)])
    vocab = corpus.vocabulary(corpus.lda_words(df))
    assert [(r.word, r.doc_freq) for r in vocab.collect()] == [("common", 5)]


def test_numbered_vocabulary_and_corpus(spark):
    df = docs(spark, *["b x the c x"] * 5)
    vocab = corpus.numbered_vocabulary(corpus.lda_words(df))
    assert {r.word: r.word_id for r in vocab.collect()} == {"b": 0, "c": 1, "x": 2}
    long = corpus.corpus_long(corpus.lda_tokens(df), vocab)
    assert long.count() == 20 and long.filter("word = 'the'").count() == 0
    assert {r.word: (r.instances, r.docs) for r in corpus.word_instances(long, vocab).collect()} == {
        "x": (10, 5), "b": (5, 5), "c": (5, 5)
    }


@pytest.mark.parametrize("target", ["aa", "ab", "a", "a.b", "\\E"])
def test_substring_positions(spark, target):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab.\\E") for _ in range(rng.randrange(30))) for _ in range(60)]
    got = {(r.doc_id, r.pos) for r in corpus.substring_positions(docs(spark, *texts), target).collect()}
    assert got == {(i, j) for i, t in enumerate(texts) for j in range(len(t)) if t.startswith(target, j)}


def test_ln_gamma(spark):
    values = [0.001, 0.01, 0.5, 1.0, 2.0, 9.99, 170.0, 1e4, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for row in df.select("x", counts.ln_gamma(F.col("x")).alias("y")).collect():
        assert row.y == pytest.approx(math.lgamma(row.x), rel=1e-12, abs=1e-11)


@pytest.fixture(scope="module")
def themed(spark):
    """Documents of two themes with disjoint words."""
    rng = random.Random(3)
    themes = [[f"{theme}{i}" for i in range(8)] for theme in ("sea", "hill")]
    texts = [" ".join(rng.choice(themes[d % 2]) for _ in range(30)) for d in range(40)]
    df = docs(spark, *texts)
    vocab = corpus.numbered_vocabulary(corpus.lda_words(df))
    return store(corpus.corpus_long(corpus.lda_tokens(df), vocab), "themed"), vocab


def test_sync_equals_a_recount(spark, themed):
    before = corpus.assign_parts(themed[0], 3).withColumn("topic", F.pmod(F.col("pos"), F.lit(4)).cast("int"))
    after = before.withColumn("topic", F.pmod(F.col("pos") + F.col("doc_id"), F.lit(4)).cast("int"))
    synced = counts.lda_sync_counts(counts.word_topic_counts(before), counts.part_changes(before, after))
    assert counts.check_counts(after, synced).count() == 0
    assert counts.check_counts(before, synced).count() > 0


def test_phi_and_theta_are_distributions(spark, themed):
    state = corpus.assign_parts(themed[0], 3).withColumn("topic", F.pmod(F.col("pos"), F.lit(2)).cast("int"))
    size = themed[1].count()
    phi = counts.lda_phi(counts.word_topic_counts(state), 4, size)  # two of the four topics are empty
    assert phi.count() == 4 * size
    for row in phi.groupBy("topic").agg(F.sum("p").alias("s")).collect():
        assert row.s == pytest.approx(1.0)
    theta = counts.lda_theta(counts.doc_topic_counts(state), 4)
    assert theta.count() == 40 * 4
    for row in theta.groupBy("doc_id").agg(F.sum("p").alias("s")).collect():
        assert row.s == pytest.approx(1.0)


@pytest.mark.parametrize("n", [1, 3, 6, 20])
def test_top_words_equal_the_ranking_of_all_cells(spark, n):
    rng = np.random.default_rng(n)
    table = rng.integers(0, 3, (12, 5)) * rng.integers(0, 2, (12, 5))
    table[:, 3] = 0  # a topic without words, and one with two
    table[:, 4] = [4, 0, 0, 4] + [0] * 8
    rows = [(w, k, int(v)) for (w, k), v in np.ndenumerate(table) if v]
    words = spark.createDataFrame([(w, f"w{w:02d}") for w in range(12)], "word_id LONG, word STRING")
    phi = (table + counts.BETA) / (table.sum(axis=0) + 12 * counts.BETA)
    expected = {
        (k, r, f"w{w:02d}", round(float(phi[w, k]), 12))
        for k in range(5) for r, w in enumerate(sorted(range(12), key=lambda w: (-table[w, k], w))[:n], 1)
    }
    top = counts.topic_top_words(spark.createDataFrame(rows, gibbs.COUNTS), words, 5, 12, n=n)
    assert {(r.topic, r.rank, r.word, round(r.p, 12)) for r in top.collect()} == expected
    plan = top._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_loglik_against_the_formula(spark, themed):
    topics, beta = 4, 0.01
    state = corpus.assign_parts(themed[0], 3).withColumn("topic", F.pmod(F.col("pos"), F.lit(3)).cast("int"))
    size = themed[1].count()
    table = np.zeros((size, topics))
    for r in counts.word_topic_counts(state).collect():
        table[r.word_id, r.topic] = r.n
    expected = topics * (math.lgamma(size * beta) - size * math.lgamma(beta))
    expected -= sum(math.lgamma(n + size * beta) for n in table.sum(axis=0))
    expected += sum(math.lgamma(n + beta) for n in table.ravel())
    got = counts.lda_loglik(counts.word_topic_counts(state), topics, size).first().loglik
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("parts, iters", [(1, 20), (3, 5)])
def test_sampler_finds_the_themes(spark, themed, parts, iters):
    long, vocab = themed
    size = vocab.count()
    state, word_topic, logliks = gibbs.fit_lda(long, size, k=2, iters=iters, parts=parts, alpha=0.5, seed=5)
    assert state.count() == long.count()
    assert counts.check_counts(state, word_topic).count() == 0
    assert state.filter(~F.col("topic").between(0, 1)).count() == 0
    whole = logliks.filter("phase = 'after' and iter > 0").groupBy("iter").agg(F.sum("loglik").alias("v")).orderBy("iter")
    values = [r.v for r in whole.collect()]
    assert len(values) == iters and values[-1] >= values[0]
    if parts > 1:  # parts start from their own labels, so a short run need not agree on the themes
        return
    top = counts.topic_top_words(word_topic, vocab, 2, size, n=8).collect()
    by_topic = {t: {r.word.rstrip("0123456789") for r in top if r.topic == t} for t in (0, 1)}
    assert sorted(map(tuple, by_topic.values())) == [("hill",), ("sea",)]
    labels = themed[0].select("doc_id").distinct().withColumn(
        "entity", F.when(F.col("doc_id") % 2 == 0, "sea").otherwise("hill")
    )
    by_entity = counts.doc_label_join(counts.doc_topic_counts(state), labels)
    leading = counts.entity_topics(by_entity, counts.topic_top_words(word_topic, vocab, 2, size, n=3), 2).collect()
    assert all(r.word.startswith(r.entity) for r in leading) and len(leading) == 6


def test_sampler_repeats_exactly(spark, themed):
    runs = [
        {tuple(r) for r in gibbs.fit_lda(themed[0], 16, k=3, iters=2, parts=3, seed=9)[0].collect()} for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_a_stopped_fit_goes_on_where_it_was(spark, themed):
    """Two steps, then a call for four: the same as four at once, and no doubled rows."""
    folder = new_folder(spark, "lda")
    gibbs.fit_lda(themed[0], 16, k=3, iters=2, parts=3, seed=9, folder=folder)
    later = gibbs.fit_lda(themed[0], 16, k=3, iters=4, parts=3, seed=9, folder=folder)
    again = gibbs.fit_lda(themed[0], 16, k=3, iters=4, parts=3, seed=9, folder=folder)
    whole = gibbs.fit_lda(themed[0], 16, k=3, iters=4, parts=3, seed=9)
    for one, two, three in zip(later, again, whole):
        rows = [sorted(map(tuple, df.select(three.columns).collect())) for df in (one, two, three)]
        assert rows[0] == rows[1] == rows[2]


def test_parts_follow_the_corpus_size():
    assert gibbs.parts_needed(0) == 1
    assert gibbs.parts_needed(1_000_001, 500_000) == 3


def streamed(docs, budget):
    """State rows of a first pass and a sweep over documents that come in batches of at most ``budget`` words."""
    def batches():
        held, words = [], 0
        for number, (ids, topics) in enumerate(docs):
            held.append((number, ids, topics))
            words += len(ids)
            if words >= budget:
                yield held
                held, words = [], 0
        if held:
            yield held

    for held in batches():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in held], pa.int64()), pa.array([list(range(len(w))) for _, w, _ in held], pa.list_(pa.int32())),
                pa.array([w for _, w, _ in held], pa.list_(pa.int64())), pa.array([t for _, _, t in held], pa.list_(pa.int32())),
                pa.nulls(len(held), pa.list_(pa.int64())),
            ],
            names=["doc_id", "places", "words", "topics", "n"],
        )


@pytest.mark.parametrize("fresh", [True, False])
def test_a_part_that_streams_equals_the_part_at_once(fresh, monkeypatch):
    rng = np.random.default_rng(2)
    docs = [(rng.integers(0, 40, n).tolist(), rng.integers(0, 5, n).tolist()) for n in rng.integers(1, 60, 300)]
    monkeypatch.setattr(gibbs, "CHUNK_WORDS", 500)

    def run(budget):
        part = gibbs.Part(5, 40, 0.1, 0.01, np.random.default_rng(7))
        if not fresh:
            table = np.zeros((40, 5), dtype=np.int64)
            for words, topics in docs:
                np.add.at(table, (words, topics), 1)
            word, topic = np.nonzero(table)
            part.take_counts(word, topic, table[word, topic])
            part.take_counts(np.full(5, -1), np.arange(5), table.sum(axis=0))
        rows = pa.Table.from_batches(list(gibbs.swept(streamed(docs, budget), 0, part, fresh))).to_pylist()
        return [r for r in rows if r["kind"] == gibbs.WORDS], [r for r in rows if r["kind"] != gibbs.WORDS]

    whole, pieces = run(10**9), run(37)
    assert whole == pieces and len(whole[0]) == len(docs)
    # the reported changes lead from the counts before to a recount
    change = next(r for r in whole[1] if r["kind"] == gibbs.CHANGE)
    after, before = np.zeros((40, 5), dtype=np.int64), np.zeros((40, 5), dtype=np.int64)
    for (words, topics), row in zip(docs, whole[0], strict=True):
        np.add.at(after, (words, row["topics"]), 1)
        if not fresh:
            np.add.at(before, (words, topics), 1)
    np.add.at(before, (change["words"], change["topics"]), change["places"])
    assert (after == before).all()


def test_a_part_of_ten_times_the_memory_goes_through(monkeypatch):
    """What a first pass holds at once stays under a tenth of what streams through it."""
    monkeypatch.setattr(gibbs, "CHUNK_WORDS", 1 << 14)
    rng = np.random.default_rng(3)
    docs = ((rng.integers(0, 500, 400).tolist(), [0] * 400) for _ in range(4000))
    part = gibbs.Part(10, 500, 0.1, 0.01, np.random.default_rng(1))
    tracemalloc.start()
    passed = sum(b.nbytes for b in gibbs.swept(streamed(docs, 1 << 12), 0, part, True))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert part.totals.sum() == 4000 * 400 and passed > 10 * most


def test_a_sweep_of_a_stored_state_moves_counts_only(spark, themed):
    folder = new_folder(spark, "lda")
    gibbs.fit_lda(themed[0], 16, k=3, iters=1, parts=6, seed=1, folder=folder)
    tasks = gibbs.tasks_for(spark, 6)
    state, word_topic = gibbs._state_of(spark, folder, 1, tasks), gibbs._counts_of(spark, folder, 1)
    again = gibbs.lda_gibbs_sweep(state, word_topic, gibbs.part_words(state), 6, 3, 16, 2, tasks=tasks)
    plan = again._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.rindex("Bucketed: true, DataFilters: [], Format: Parquet")].splitlines()
    indents = [len(line) - len(line.lstrip(" :+-")) for line in above]
    depth, path = indents[-1], []
    for line, indent in zip(reversed(above[:-1]), reversed(indents[:-1])):
        if indent < depth:
            depth = indent
            path.append(line)
    assert any("Union" in line for line in path) and not any("Exchange" in line for line in path)
    spark.sql(f"DROP TABLE {gibbs._table(folder, 1)}")


def test_a_part_gets_its_counts_in_a_fixed_number_of_rows(spark, monkeypatch):
    """A row per word made Arrow go over all earlier rows of a batch again for each of them."""

    def counting(*_):
        def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches))
            held = table.filter(table["n"].is_valid())
            words, times, topics, n = (gibbs._flat(held[c]) for c in ("words", "places", "topics", "n"))
            assert times.sum() == len(n) == len(topics)
            seen = [held.num_rows, int((words >= 0).sum()), int(n.sum())]
            lists = {"words": pa.array([seen], pa.list_(pa.int64()))}
            yield gibbs._rows(gibbs.CHANGE, key[0].as_py(), 1, **lists)

        return run

    monkeypatch.setattr(gibbs, "_task", counting)
    long = spark.range(3000).selectExpr("id % 10 AS doc_id", "CAST(id AS INT) AS pos", "id % 1000 AS word_id", "CAST(id % 7 AS INT) AS topic")
    long = corpus.assign_parts(long, 2)
    docs = gibbs.packed(long)
    swept = gibbs.lda_gibbs_sweep(docs, counts.word_topic_counts(long), gibbs.part_words(docs), 2, 7, 1000, 1)
    rows = {r.part: r.words for r in swept.collect()}
    assert sorted(rows) == [0, 1]
    # the counts of its 500 words, three of each, and the totals of all words
    assert all(given <= gibbs.COUNT_ROWS and own == 500 and total == 1500 + 3000 for given, own, total in rows.values())


def test_changes_of_parts_move_once(spark):
    """Words before and after meet in one exchange; counts of their own for each made a second one and a map more a task."""
    long = spark.range(400).selectExpr("id % 10 AS doc_id", "id % 2 AS part", "id % 20 AS word_id", "CAST(id % 7 AS INT) AS topic")
    later = long.withColumn("topic", F.when(F.col("word_id") < 3, 0).otherwise(F.col("topic")))
    changes = counts.part_changes(long, later)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    rows = [r for r in changes.collect()]
    assert all(r.word_id < 3 and r.n and (r.n > 0) == (r.topic == 0) for r in rows)
    moved = long.filter("word_id < 3 and topic <> 0").count()
    assert sum(r.n for r in rows if r.n > 0) == moved == -sum(r.n for r in rows if r.n < 0)


def test_tasks_do_not_grow_with_the_parts(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [gibbs.tasks_for(spark, parts) for parts in (1, 2, 10**6)] == [1, 8, 4 * cores]


def test_a_long_fit_rises_and_ends_when_it_has_settled(spark, themed):
    long, vocab = themed
    size = vocab.count()
    state, word_topic, logliks = gibbs.fit_lda(long, size, k=2, iters=100, parts=2, alpha=0.5, seed=4)
    assert counts.check_counts(state, word_topic).count() == 0 and state.count() == long.count()
    rows = logliks.filter("phase = 'after' and iter > 0").groupBy("iter").agg(F.sum("loglik").alias("v")).orderBy("iter").collect()
    values = [r.v for r in rows]
    assert [r.iter for r in rows] == list(range(1, 101))
    assert np.mean(values[-10:]) > np.mean(values[:10])
    early = gibbs.fit_lda(long, size, k=2, iters=100, parts=2, alpha=0.5, seed=4, tolerance=0.5)
    assert early[2].agg(F.max("iter")).first()[0] == 1 and early[0].count() == long.count()
    first = [tuple(r) for r in logliks.filter("iter <= 1").orderBy("iter", "part", "phase").collect()]
    assert [tuple(r) for r in early[2].orderBy("iter", "part", "phase").collect()] == first


def test_changed_counts_come_in_short_rows():
    """Readers hold thousands of rows at once; a row with all changes of a part took the heap with a few hundred parts a task."""
    rng = np.random.default_rng(1)
    docs = [(rng.integers(0, 3000, 200).tolist(), [0] * 200) for _ in range(40)]
    part = gibbs.Part(10, 3000, 0.1, 0.01, np.random.default_rng(1))
    rows = pa.Table.from_batches(list(gibbs.swept(streamed(docs, 10**9), 0, part, True))).to_pylist()
    changes = [r for r in rows if r["kind"] == gibbs.CHANGE]
    assert sum(sum(r["places"]) for r in changes) == 40 * 200
    assert sum(len(r["words"]) for r in changes) > 2 * 1024 and max(len(r["words"]) for r in changes) <= 1024


def pack_batches(parts, table, topics, rows):
    """What a pack gets: its counts, then the documents of its parts in batches of so many."""
    held = [(w, t, int(n)) for (w, t), n in np.ndenumerate(table) if n]
    words = sorted({w for w, _, _ in held})
    given = [(w, [(t, n) for v, t, n in held if v == w]) for w in reversed(words)] + [(-1, list(enumerate(table.sum(axis=0).tolist())))]
    kinds = {"part": pa.int32(), "doc_id": pa.int64(), "places": pa.list_(pa.int32()), "words": pa.list_(pa.int64()), "topics": pa.list_(pa.int32()), "n": pa.list_(pa.int64())}
    lines = [
        (None, None, [len(c) for _, c in some], [w for w, _ in some], [t for _, c in some for t, _ in c], [n for _, c in some for _, n in c])
        for some in (given[::2], given[1::2])
    ] + [(p, d, list(range(len(w))), w, t, None) for p, docs in parts for d, (w, t) in enumerate(docs)]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines), kinds.values())], names=list(kinds))
    return [whole.slice(at, rows) for at in range(0, whole.num_rows, rows)]


@pytest.mark.parametrize("chunk, rows", [(10**6, 10**6), (10**6, 3), (700, 5), (100, 4)])
def test_parts_of_a_pack_see_their_own_words_and_changes(chunk, rows, monkeypatch):
    """Side by side or streaming alone, a part starts from the global counts of its words and reports what it changed."""
    monkeypatch.setattr(gibbs, "CHUNK_WORDS", chunk)
    rng, topics, size = np.random.default_rng(5), 4, 60
    parts = [
        (p, [(rng.integers(3 * p, 3 * p + 25, n).tolist(), rng.integers(0, topics, n).tolist()) for n in rng.integers(1, 40, 12)])
        for p in (2, 5, 6, 11)
    ]
    table = np.zeros((size, topics), dtype=np.int64)
    for words, drawn in (d for _, docs in parts for d in docs):
        np.add.at(table, (words, drawn), 1)
    run = gibbs._task(False, topics, size, 0.1, 0.01, 3, 1)
    out = pa.Table.from_batches(list(run((pa.scalar(0),), iter(pack_batches(parts, table, topics, rows))))).to_pylist()
    lgamma, mass, totals = math.lgamma, size * 0.01, table.sum(axis=0)
    for number, docs in parts:
        mine = [r for r in out if r["part"] == number]
        drawn = [r for r in mine if r["kind"] == gibbs.WORDS]
        assert [(r["doc_id"], r["words"]) for r in drawn] == [(d, words) for d, (words, _) in enumerate(docs)]
        now = table.copy()
        for (words, old), row in zip(docs, drawn):
            np.subtract.at(now, (words, old), 1)
            np.add.at(now, (words, row["topics"]), 1)
        change = np.zeros_like(table)
        for r in mine:
            if r["kind"] == gibbs.CHANGE:
                np.add.at(change, (r["words"], r["topics"]), r["places"])
        assert change.any() and (change == now - table).all()
        used = sorted({w for words, _ in docs for w in words})
        for kind, counted in ((gibbs.BEFORE, table), (gibbs.AFTER, now)):
            expected = topics * (lgamma(mass) - len(used) * lgamma(0.01)) + sum(lgamma(n + 0.01) for n in counted[used].ravel())
            expected -= sum(lgamma(n + mass) for n in counted.sum(axis=0))
            assert [r["loglik"] for r in mine if r["kind"] == kind] == pytest.approx([expected])
    assert sum(r["kind"] == gibbs.AFTER for r in out) == len(parts)


def test_parts_share_what_is_sent_to_their_pack(spark, monkeypatch):
    """The counts of a word went to each part that has it: nearly a row for every other word of the corpus."""
    monkeypatch.setattr(gibbs, "LEAST_PACKS", 2)
    long = spark.range(6000).selectExpr("id % 60 AS doc_id", "CAST(id AS INT) AS pos", "id % 50 AS word_id", "CAST(id % 7 AS INT) AS topic")
    long = corpus.assign_parts(long, 40)
    docs, held = gibbs.packed(long), counts.word_topic_counts(long)
    assert [gibbs.packs_for(n) for n in (1, 2, 40, 10**6)] == [1, 2, 2, 31250]
    assert gibbs.part_words(gibbs.in_packs(docs, 40)).count() <= 2 * 50 < gibbs.part_words(docs).count()
    # the words come by part or by pack, with the same result
    states = [gibbs.lda_gibbs_sweep(docs, held, gibbs.part_words(d), 40, 7, 50, 1) for d in (docs, gibbs.in_packs(docs, 40))]
    rows = [sorted((r.part, r.doc_id, r.words, r.topics) for r in gibbs.documents(s).collect()) for s in states]
    assert rows[0] == rows[1] and len(rows[0]) == 60
    for state in states:
        synced = counts.lda_sync_counts(held, gibbs.reported_changes(state))
        assert counts.check_counts(gibbs.assignments(state), synced).count() == 0


@pytest.mark.parametrize("topics", [True, False])
def test_packed_documents_equal_gathered_lists(spark, topics):
    rng = random.Random(1)
    pick = lambda *values: rng.choice([None, *values])
    rows = [(pick(0, 1), pick(*range(6), -5, 2**60), pick(*range(30)), pick(*range(10)), pick(*range(4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "part INT, doc_id LONG, pos INT, word_id LONG, topic INT")
    df = df if topics else df.drop("topic")
    lists = df.groupBy("part", "doc_id").agg(F.sort_array(F.collect_list(F.struct(*df.columns[2:]))).alias("w"))
    lists = lists.select("part", "doc_id", "w.pos", "w.word_id", F.col("w.topic") if topics else F.lit(None).alias("topic"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # documents go on in the next batch
    try:
        got = gibbs.packed(df).select("part", "doc_id", "places", "words", "topics").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, lists.collect())))
    assert "collect_list" not in gibbs.packed(df)._jdf.queryExecution().toString()


def test_the_registered_fit_runs_all_iterations(spark, tmp_path, monkeypatch):
    """Three of a hundred left little of the work."""
    texts = [(d, " ".join(f"{'sea' if d % 2 else 'hill'}{(d * 7 + i) % 8}" for i in range(30))) for d in range(12)]
    spark.createDataFrame(texts, "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    asked, fit = [], gibbs.fit_lda

    def short(corpus, vocab_size, k, iters, *rest, **more):
        asked.append(iters)
        return fit(corpus, vocab_size, k, 1, *rest, **more)

    monkeypatch.setattr(gibbs, "fit_lda", short)
    rows = plans.fit_lda(spark, str(tmp_path)).collect()
    assert asked == [100] and [(r.part, r.n, r.counts_off) for r in rows] == [(0, 360, 0)]
