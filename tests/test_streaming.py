"""Streams give what the same lines give as a batch."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import posts as ps
from tidemark.operators import sentiment as st
from tidemark.plans import streams
from tidemark.session import new_folder
from tidemark.sources import readers
from tidemark.streaming import jobs

DICTIONARY = {"general": ["gopdebate"], "candidates": {"gop": {"bush": ["bush"], "rand": ["rand"], "cruz": ["cruz"]}}}


@pytest.fixture(scope="module")
def terms(spark):
    return readers.flatten_terms(spark.createDataFrame([(json.dumps(DICTIONARY),)], "value STRING"))


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("good", 8.0), ("bad", 2.0)], "word STRING, score DOUBLE")


def line(number, second, text):
    return json.dumps(
        {
            "id": number, "created_at": f"Wed Sep 16 20:{second // 60:02d}:{second % 60:02d} +0000 2015", "lang": "en",
            "text": text, "user": {"screen_name": "u"}, "entities": {"hashtags": [], "urls": []},
        }
    )


@pytest.fixture(scope="module")
def folder(spark):
    """Six files whose posts share intervals across files, and a damaged line."""
    texts = ["bush good", "rand bad good", "bush bad", "gopdebate", "rand nothing", "bush good good"]
    lines = [(i, line(i, (i * 17) % 150, texts[i % 6])) for i in range(60)] + [(60, "{broken")]
    path = new_folder(spark, "lines")
    df = spark.createDataFrame(lines, "n INT, value STRING")
    df.repartitionByRange(6, F.hash("n")).select("value").write.text(path)
    return path


def test_stream_equals_batch(spark, terms, lexicon, folder):
    out = new_folder(spark, "out")
    query = jobs.fan_out(jobs.replay_stream(spark, folder), terms, lexicon, out).trigger(availableNow=True).start()
    assert jobs.run_bounded(query, minutes=5, poll_seconds=0.2)
    assert len({p.batchId for p in query.recentProgress if p.numInputRows}) == 6

    good, dead = ps.decode_posts(spark.read.text(folder))
    tagged = ps.project_fields(ps.eligible_posts(good, terms), terms)
    assert {r.id for r in jobs.read_posts(spark, out).collect()} == {r.id for r in tagged.collect()}
    assert [r.value for r in jobs.read_dead(spark, out).collect()] == [r.value for r in dead.collect()]

    def rows(df):
        return sorted(
            tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.fillna("").fillna(-1).collect()
        )

    batch = st.entity_summary(tagged, lexicon, terms)
    live = jobs.read_summary(spark, out, terms).select(batch.columns)
    assert rows(live) == rows(batch)
    assert live.filter("first_term = 'cruz'").agg(F.sum("num_posts")).first()[0] == 0


def test_windowed_counts(spark, terms, folder):
    """Appended are the intervals that end at the latest time less the delay, or before."""
    raw, path = jobs.replay_stream(spark, folder, 6), new_folder(spark, "counts")
    counts = jobs.stream_counts(jobs.tagged_stream(raw, terms), 30, "5 seconds")
    jobs.append_counts(counts, path).trigger(availableNow=True).start().awaitTermination()
    tagged = jobs.tagged_stream(spark.read.text(folder), terms)
    last = tagged.agg(F.max(F.unix_timestamp("timestamp"))).first()[0]
    batch = {tuple(r) for r in st.count_by_entity(tagged).collect()}
    closed = {r for r in batch if r[0] + 30 <= last - 5}
    assert {tuple(r) for r in spark.read.schema(counts.schema).parquet(path).collect()} == closed and closed != batch


def test_repeated_posts_are_dropped_within_the_watermark(spark):
    path = new_folder(spark, "repeats")
    spark.createDataFrame([("1",), ("1",), ("2",)], "value STRING").repartition(1).write.text(path)
    raw = jobs.replay_stream(spark, path).withColumn("ts", F.timestamp_seconds(F.lit(100))).withWatermark("ts", "1 minute")
    query = (
        ps.dedupe_posts(raw, ["value"]).writeStream.format("memory").queryName("repeats")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.value for r in spark.table("repeats").collect()) == ["1", "2"]


def test_bounded_run_stops_an_endless_query(spark, folder):
    query = jobs.replay_stream(spark, folder).writeStream.format("noop").start()
    assert jobs.run_bounded(query, minutes=0.05, poll_seconds=0.5) is False
    assert not query.isActive


def started(raw, out, broken=None):
    def write(batch, number):
        if number == broken:
            raise ConnectionError
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start()


def test_replayed_batches_are_bounded_by_posts(spark, folder):
    """Six files of about ten posts as batches of four; a stream that broke goes on where it was."""
    out, cut = new_folder(spark, "bounded"), new_folder(spark, "cut")
    with pytest.raises(StreamingQueryException):
        started(jobs.replay_stream(spark, folder, posts_per_batch=4, folder=cut), out, broken=3).awaitTermination()
    started(jobs.replay_stream(spark, folder, posts_per_batch=4, folder=cut), out).awaitTermination()
    rows = spark.read.parquet(out)
    sizes = sorted(r["count"] for r in rows.groupBy("batch_id").count().collect())
    assert sizes == [1, *[4] * 15]
    lines = sorted(r.value for r in spark.read.text(folder).collect())
    assert sorted(r.value for r in rows.select("value").collect()) == lines


def lane_of(spark, folder, cut, lane, lanes):
    return jobs.replay_stream(spark, folder, posts_per_batch=4, folder=cut, lane=lane, lanes=lanes)


def rows_of_lanes(spark, out):
    return spark.read.option("basePath", out).parquet(f"{out}/lane=*[0-9]")  # not the checkpoints beside them


def test_lanes_share_the_batches(spark, folder):
    """Streams side by side, of which two break, hold each batch once; a lane without a batch ends by itself."""
    out, cut = new_folder(spark, "lanes"), new_folder(spark, "cut")

    def run(broken, lanes=20):
        broken = {1: broken, 7: broken}
        jobs.finish_all([started(lane_of(spark, folder, cut, i, lanes), f"{out}/lane={i}", broken.get(i)) for i in range(lanes)])

    with pytest.raises(StreamingQueryException):
        run(broken=0)
    run(broken=None)
    rows = rows_of_lanes(spark, out)
    sizes = {(r.lane, r.batch_id): r["count"] for r in rows.groupBy("lane", "batch_id").count().collect()}
    assert sizes == {(i, 0): 4 if i < 15 else 1 for i in range(16)}  # 61 lines
    assert sorted(r.value for r in rows.select("value").collect()) == sorted(r.value for r in spark.read.text(folder).collect())


def test_lanes_take_every_kth_batch_and_go_on(spark, folder):
    out, cut = new_folder(spark, "lanes"), new_folder(spark, "cut")
    for broken in (3, None):
        try:
            jobs.finish_all([started(lane_of(spark, folder, cut, i, 3), f"{out}/lane={i}", broken) for i in range(3)])
        except StreamingQueryException:
            assert broken
    rows = rows_of_lanes(spark, out)
    sizes = sorted((r.lane, r["count"]) for r in rows.groupBy("lane", "batch_id").count().collect())
    assert sizes == [(0, 1), *[(0, 4)] * 5, *[(1, 4)] * 5, *[(2, 4)] * 5]
    assert sorted(r.value for r in rows.select("value").collect()) == sorted(r.value for r in spark.read.text(folder).collect())
    for lanes in (1, 4):
        with pytest.raises(ValueError):
            lane_of(spark, folder, cut, 0, lanes)
    with pytest.raises(ValueError):
        jobs.replay_stream(spark, folder, lanes=2)
    with pytest.raises(ValueError):
        lane_of(spark, folder, cut, 3, 3)


def test_lanes_follow_the_number_of_batches(spark, folder):
    assert jobs.lanes_for(spark, folder, 4) == 1
    assert jobs.lanes_for(spark, folder, 1) == 61 // jobs.LANE_BATCHES
    many = new_folder(spark, "many")
    spark.range(10 * jobs.MAX_LANES * jobs.LANE_BATCHES).select(F.col("id").cast("string")).write.text(many)
    assert jobs.lanes_for(spark, many, 1) == jobs.MAX_LANES


def test_many_batches_of_the_query_run_in_lanes(spark, monkeypatch):
    """A thousand posts in batches of ten are four streams; each breaks and goes on, and no batch is lost or doubled."""
    monkeypatch.setattr(streams, "PER_BATCH", 10)
    lines, lanes = new_folder(spark, "lines"), []
    spark.range(1003).select(F.col("id").cast("string")).write.text(lines)
    monkeypatch.setattr(streams, "post_files", lambda *_: lines)
    replay = jobs.replay_stream
    monkeypatch.setattr(jobs, "replay_stream", lambda *a, **k: lanes.append(k["lane"]) or replay(*a, **k))
    assert sorted(map(tuple, streams.replay_stream(spark, "").collect())) == [(3, 1), (10, 100)]
    assert lanes == [0, 1, 2, 3] * 2


def test_an_empty_folder_replays_nothing(spark):
    path, out = new_folder(spark, "empty"), new_folder(spark, "bounded")
    spark.createDataFrame([], "value STRING").write.text(path)
    assert jobs.run_bounded(started(jobs.replay_stream(spark, path, posts_per_batch=4), out), minutes=5, batches=2)


def test_compacted_summaries_stay_the_same_and_few(spark, terms, lexicon, folder):
    out, plain = new_folder(spark, "out"), new_folder(spark, "out")
    for path, every in ((out, 2), (plain, 10**6)):
        raw = jobs.replay_stream(spark, folder, posts_per_batch=7)
        jobs.fan_out(raw, terms, lexicon, path, compact_every=every).trigger(availableNow=True).start().awaitTermination()

    def rows(path):
        return sorted(str(r) for r in jobs.read_summary(spark, path, terms).collect())

    assert rows(out) == rows(plain)
    bases, batches = jobs._summary_folders(spark, out)
    assert bases == [5, 7] and batches == [6, 7, 8]
    assert jobs._summary_folders(spark, plain) == ([], list(range(9)))
    jobs.compact_summary(spark, out, 7)  # a batch that is tried again makes the same base
    assert rows(out) == rows(plain)
    late = spark.read.parquet(f"{out}/summary/batch_id=8")
    late.write.parquet(f"{out}/summary/batch_id=9")  # more posts of intervals long closed still count
    more = jobs.read_summary(spark, out, terms).agg(F.sum("num_posts")).first()[0]
    assert more == jobs.read_summary(spark, plain, terms).agg(F.sum("num_posts")).first()[0] + late.agg(F.sum("num_posts")).first()[0]


def test_audit_holds_writes_against_tables(spark, terms, lexicon, folder):
    out = new_folder(spark, "out")
    raw = jobs.replay_stream(spark, folder, files_per_trigger=2)
    jobs.fan_out(raw, terms, lexicon, out).trigger(availableNow=True).start().awaitTermination()
    rows = {r.sink: tuple(r)[1:] for r in jobs.read_audit(spark, out).collect()}
    assert set(rows) == {"posts", "summary", "dead"} and rows["dead"] == (1, 1, 1, 1)
    assert all(r[:2] == r[2:] and r[0] > 0 for r in rows.values())
    jobs.read_posts(spark, out).limit(1).write.parquet(f"{out}/posts/batch_id=99")  # a row no write saw
    rows = {r.sink: tuple(r)[1:] for r in jobs.read_audit(spark, out).collect()}
    assert rows["posts"][0] + 1 == rows["posts"][2]


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        jobs.stream_posts(spark, "pigeon")
