"""Decoding, filters, tagging, projections."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import times as tm
from tidemark.operators import mentions
from tidemark.operators import posts as ps
from tidemark.sources import readers, writers

DICTIONARY = {
    "general": ["gopdebate"],
    "candidates": {"gop": {"bush": ["bush", "jeb"], "rand": ["rand", "randpaul"]}, "democrat": {"clinton": ["hillary"]}},
}


@pytest.fixture(scope="module")
def terms(spark):
    return readers.flatten_terms(spark.createDataFrame([(json.dumps(DICTIONARY),)], "value STRING"))


def post(**changes):
    base = {
        "id": 2**40, "created_at": "Wed Sep 16 20:00:31 +0000 2015", "lang": "en", "text": "go #jeb ☃ and hillary",
        "user": {"screen_name": "u", "location": "x", "lang": "en"}, "geo": None,
        "entities": {"hashtags": [{"text": "jebé"}], "urls": []},
    }
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v != "absent"})


def raw(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


def test_damaged_lines_are_dead_letters(spark):
    lines = ["{broken", "[1, 2]", "", None, "nonsense", post()[:-1], '{"id": "not a number"}']
    good, dead = ps.decode_posts(raw(spark, post(), *lines))
    assert good.count() == 1
    assert {r.value for r in dead.collect()} == set(lines)


def test_an_object_under_a_presence_key_counts_as_present(spark):
    good, _ = ps.decode_posts(raw(spark, '{"delete": {"status": {"id": 1}}}', post(retweeted_status=None)))
    rows = {r.id: r for r in good.collect()}
    assert rows[None].delete is not None
    assert rows[2**40].retweeted_status is None


def test_eligible_posts(spark, terms):
    media = {"hashtags": [], "urls": [], "media": [{"url": "u"}]}
    cases = {
        post(id=1): True,
        post(id=2, lang="fr"): False,
        post(id=3, lang="absent"): False,
        post(id=4, retweeted_status={"id": 1}): False,
        post(id=5, entities={"hashtags": [], "urls": [{"url": "u"}]}): False,
        post(id=6, entities=media): False,
        post(id=7, text="nobody here"): False,
        post(id=8, text=""): False,
        post(id=9, entities="absent"): False,
        post(id=10, limit={"track": 1}): False,
        post(id=11, text="GopDebate now"): True,
    }
    good, dead = ps.decode_posts(raw(spark, *cases))
    assert dead.count() == 0
    kept = {r.id for r in ps.eligible_posts(good, terms).collect()}
    assert kept == {json.loads(line)["id"] for line, keep in cases.items() if keep}
    without_limit_check = {r.id for r in ps.eligible_posts(good, terms, check_limit=False).collect()}
    assert without_limit_check == kept | {10}


def test_media_without_url(spark):
    def with_media(number, *media):
        return post(id=number, entities={"hashtags": [], "urls": [], "media": list(media)})

    good, _ = ps.decode_posts(raw(spark, with_media(1, {"url": "u"}), with_media(2, {}), with_media(3, {}, {"url": "u"}), post(id=4)))
    assert {r.id for r in ps.eligible_media_without_url(good).collect()} == {2, 4}


def test_geo_variants(spark):
    nowhere = {"screen_name": "u", "lang": "en"}
    good, _ = ps.decode_posts(
        raw(
            spark, post(id=1, text="The Debate"), post(id=2, user=nowhere), post(id=3, user=nowhere, geo={"lat": 1}),
            post(id=4, user={"screen_name": "u", "location": "", "lang": "en"}, text="debate"),
        )
    )
    assert {r.id for r in ps.eligible_geo(good).collect()} == {1, 3, 4}
    assert {r.id for r in ps.eligible_geo(good, "debate").collect()} == {1}


def test_project_fields(spark, terms):
    good, _ = ps.decode_posts(raw(spark, post(), post(id=5, text="gopdebate")))
    rows = {r.id: r for r in ps.project_fields(good, terms, "gop").collect()}
    row = rows[2**40]
    assert row.timestamp == "2015-09-16 20:00:31"
    assert row.batchtime == 1442433630
    assert row.text == "go #jeb  and hillary"
    assert row.hashtags == ["jeb"]
    # only the party's entities are named; the other party's mention is no hit
    assert (row.first_term, row.search_terms, row.multiple_terms) == ("bush", ["bush"], False)
    assert rows[5].search_terms == ["general"]
    everyone = {r.id: r for r in ps.project_fields(good, terms).collect()}[2**40]
    assert (everyone.search_terms, everyone.multiple_terms) == (["bush", "clinton"], True)


def test_processing_time_interval(spark, terms):
    good, _ = ps.decode_posts(raw(spark, post()))
    row = ps.project_fields(good, terms, batch_ts=F.timestamp_seconds(F.lit(95))).first()
    assert row.batchtime == 90


def test_unknown_party_is_an_error(spark, terms):
    with pytest.raises(ValueError):
        ps.tag_entities(raw(spark, "x").withColumnRenamed("value", "text"), terms, "dem")


def test_joined_tagging_equals_the_patterns(spark, monkeypatch):
    rng = random.Random(7)
    dictionary = {
        "general": ["ab"],
        "candidates": {"p": {"one": ["a", "b b"], "two": ["AB", "a@b"], "three": ["bab", "Ba"], "four": ["#b"]}},
    }
    terms = readers.flatten_terms(spark.createDataFrame([(json.dumps(dictionary),)], "value STRING"))
    texts = ["".join(rng.choice("aAbB #@.é\n\u212a") for _ in range(rng.randrange(12))) for _ in range(300)]
    posts = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING")

    def rows():
        return {r.id: r.search_terms for r in ps.tag_entities(posts, terms).collect()}

    by_pattern = rows()
    monkeypatch.setattr(ps, "MAX_PATTERN_TERMS", 0)
    assert rows() == by_pattern
    monkeypatch.setattr(mentions, "MAX_TERM_CHARS", 0)
    assert rows() == by_pattern
    assert len({tuple(v) for v in by_pattern.values()}) > 5


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_large_dictionaries_give_the_same_on_repeated_ids(spark, terms, monkeypatch, mode):
    """One id with several texts and repeated rows: a row is judged by its own text, either way."""
    texts = ["jeb is here", "hillary there", "hillary there", "nothing", "", None, "x jeb #bernie @hillary"]
    df = spark.createDataFrame([(1, t, [] if t is None else ["rubio"]) for t in texts], "id LONG, text STRING, hashtags ARRAY<STRING>")

    def results():
        both = [ps.tag_entities(df, terms, mode=mode), ps.tag_entities(df, terms, mode=mode, include_hashtags=True)]
        marks = ps.entity_indicators(df, terms, mode=mode)
        return [
            sorted((str(r.text), r.search_terms) for r in tagged.collect()) for tagged in both
        ] + [sorted(map(str, marks.collect())), sorted(str(r.text) for r in eligible().collect())]

    def eligible():
        empty = "CAST(NULL AS STRING)"
        whole = df.selectExpr(
            "*", f"{empty} AS delete", f"{empty} AS retweeted_status", "'en' AS lang", f"{empty} AS limit",
            "named_struct('urls', array(), 'media', CAST(NULL AS ARRAY<STRING>)) AS entities",
        )
        return ps.eligible_posts(whole, terms, mode)

    written_out = results()
    monkeypatch.setattr(ps, "MAX_PATTERN_TERMS", 0)
    assert results() == written_out
    monkeypatch.setattr(mentions, "MAX_TERM_CHARS", 0)
    assert results() == written_out


def test_fifty_thousand_terms_equal_the_guard_by_hand(spark, monkeypatch):
    """Half of the terms have a blank; automaton, join and a plain search agree, and the automaton shuffles nothing."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 6))) for _ in range(4000)]
    found = {(rng.choice(words).upper() if i % 2 else f"{rng.choice(words)} {rng.choice(words)}") + str(i) for i in range(50_000)}
    found = sorted(found | set(words[:300]) | {f"{a} {b}" for a, b in zip(words[300:600], words[600:900])})
    rows = [("p", f"e{i % 400}", i % 400, t, i) for i, t in enumerate(found)]
    terms = spark.createDataFrame(rows, "party STRING, entity STRING, entity_pos INT, term STRING, term_pos INT")
    texts = [rng.choice(" #@.").join(rng.choices([*words[:900], *found], k=12)) for _ in range(200)]
    texts += [None, "", found[7], f"x{found[7]}", f"#{found[9]}s"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING")

    def lower(text):
        return text.encode().lower().decode()

    owners = {}
    for _, entity, at, term, _ in rows:
        owners.setdefault(lower(term), set()).add((at, entity))
    longest = max(map(len, found))

    def by_hand(text):
        text, hits = lower(text or ""), set()
        for start in (i for i in range(len(text)) if i == 0 or text[i - 1] in " \t\n\x0b\f\r#@"):
            for n in range(1, longest + 1):
                hits |= owners.get(text[start : start + n], set()) if start + n <= len(text) else set()
        return [e for _, e in sorted(hits)] or ["general"]

    expected = {i: by_hand(t) for i, t in enumerate(texts)}
    tagged = ps.tag_entities(posts, terms)
    assert {r.id: r.search_terms for r in tagged.collect()} == expected
    assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(mentions, "MAX_TERM_CHARS", 0)
    assert {r.id: r.search_terms for r in ps.tag_entities(posts, terms).collect()} == expected
    assert sum(len(v) > 1 for v in expected.values()) > 100


def test_callers_columns_may_have_any_name(spark, terms, monkeypatch):
    df = spark.createDataFrame([("jeb", 1, 2, 3, 4, 5)], "text STRING, _hit_0 INT, _hits INT, _text_key INT, _opening_key INT, _terms INT")
    for patterns, chars in ((64, 10**6), (0, 10**6), (0, 0)):
        monkeypatch.setattr(ps, "MAX_PATTERN_TERMS", patterns)
        monkeypatch.setattr(mentions, "MAX_TERM_CHARS", chars)
        assert tuple(ps.tag_entities(df, terms).first()) == ("jeb", 1, 2, 3, 4, 5, ["bush"])
    assert tuple(ps.entity_from_prefix(df, terms).first()) == ("jeb", 1, 2, 3, 4, 5, "bush")


def test_hashtags_are_searched_on_request(spark, terms):
    df = spark.createDataFrame([("nothing", ["randpaul"])], "text STRING, hashtags ARRAY<STRING>")
    assert ps.tag_entities(df, terms).first().search_terms == ["general"]
    assert ps.tag_entities(df, terms, include_hashtags=True).first().search_terms == ["rand"]


def test_entity_from_prefix(spark, terms):
    texts = {
        "first jebediah then hillary": "bush",
        "hillary and jeb": "clinton",
        "brand new": "general",          # 'rand' must be the whole word
        "for rand": "rand",
        "thejeb": "bush",                # suffixes and whole words count
        "x" * 199 + " jeb": "general",   # past the opening characters
        "": "general",
    }
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = {r.text: r.entity for r in ps.entity_from_prefix(df, terms).collect()}
    assert got == texts


def test_entity_from_prefix_with_fifty_thousand_terms(spark):
    rng = random.Random(5)
    found = list({"".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(52_000)} - set("abcdefghij"))
    found = [t for t in found if len(t) > 4] + ["ab", "cde", "fghi"]
    rows = [("p", f"e{i % 300}", i % 300, t.upper(), i) for i, t in enumerate(found)]
    terms = spark.createDataFrame(rows, "party STRING, entity STRING, entity_pos INT, term STRING, term_pos INT")
    texts = [" ".join("".join(rng.choices("abcdefghijk", k=rng.randint(1, 12))) for _ in range(8)) for _ in range(150)]
    texts += ["", None, "kkk kkkab kcdek", found[3], f"x{found[3]}", "fghi FGHI"]
    exact = ("fghi", found[3])
    rank = {t: (i % 300, i) for i, t in enumerate(found)}

    def by_hand(text):
        for word in (text or "").lower().split():
            parts = {word[i:j] for i in range(len(word)) for j in range(i + 1, len(word) + 1)}
            held = [rank[p] for p in parts if p in rank and (p not in exact or p == word)]
            if held:
                return f"e{min(held)[0]}"
        return "general"

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    tagged = ps.entity_from_prefix(docs, terms, chars=None, exact=exact)
    assert {r.doc_id: r.entity for r in tagged.collect()} == {i: by_hand(t) for i, t in enumerate(texts)}
    plan = tagged._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_term_dimension(spark, terms):
    rows = {(r.party, r.entity, r.entity_pos, r.term, r.term_pos) for r in terms.collect()}
    assert ("gop", "rand", 1, "randpaul", 1) in rows
    assert ("democrat", "clinton", 2, "hillary", 0) in rows
    assert ("general", "general", -1, "gopdebate", 0) in rows
    assert len(rows) == 6


def test_typed_rows_and_melt(spark):
    df = spark.createDataFrame(
        [(7, "2015-09-16 20:00:31", "30", None, "té", ["a", "b"], "x", ["x", "y"], True)],
        "id INT, timestamp STRING, batchtime STRING, username STRING, text STRING, hashtags ARRAY<STRING>, "
        "first_term STRING, search_terms ARRAY<STRING>, multiple_terms BOOLEAN",
    )
    typed = ps.typed_rows(df)
    assert dict(typed.dtypes)["id"] == "bigint" and dict(typed.dtypes)["batchtime"] == "bigint"
    assert "batchtime" not in ps.typed_rows(df, with_batchtime=False).columns
    melted = {r.name: r.value for r in writers.eav_melt(typed, "id").collect()}
    assert melted["hashtags"] == "a,b" and melted["multiple_terms"] == "True"
    assert melted["username"] == "" and melted["text"] == "t"


def test_duplicates_are_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id INT, text STRING")
    assert ps.dedupe_posts(df).count() == 2
    assert ps.dedupe_posts(df, ["id"]).count() == 1


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame(
        [("Sun Nov 01 05:59:59 +0000 2015",), ("Sun Nov 01 06:00:00 +0000 2015",), ("bad",)], "c STRING"
    )
    ts = tm.parse_created_at(F.col("c"))
    columns = [
        F.unix_seconds(ts).alias("epoch"), tm.wall_text(tm.to_local(ts)).alias("local"),
        tm.wall_text(tm.utc_wall_clock(ts)).alias("utc"), tm.floor_interval(ts).alias("floor"),
        F.unix_seconds(tm.utc_instant(F.expr("timestamp_ntz'2015-03-08 02:30:00'"))).alias("ntz"),
    ]
    seen = []
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.append([tuple(r) for r in df.select(*columns).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0][:3] == (1446357599, "2015-11-01 01:59:59", "2015-11-01 05:59:59")
    assert seen[0][1][1] == "2015-11-01 01:00:00"  # the clock went back
    assert seen[0][2][0] is None


def test_joined_tagging_searches_a_text_once(spark):
    """The words of a text are found once, not again for each length that terms have."""
    texts = spark.createDataFrame([("a", "jeb and #RandPaul"), ("b", "a bushel"), ("c", None), ("d", "xjeb")], "key string, text string")
    rows = [("bush", 0, "bush"), ("bush", 0, "jeb"), ("rand", 1, "rand"), ("rand", 1, "randpaul")]
    found = mentions.term_mentions(texts, spark.createDataFrame(rows, "entity string, entity_pos int, term string"))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.key, r.entity) for r in found.collect()) == [("a", "bush"), ("a", "rand"), ("b", "bush")]
