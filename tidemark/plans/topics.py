"""Topic modelling. The deterministic half runs on a fixed assignment that SQL can replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.topics import corpus, counts, gibbs
from tidemark.plans import sample
from tidemark.plans.filtering import ENTITY_DOCS, documents_with_entity
from tidemark.plans.registry import fixed, fixed_sql, query
from tidemark.session import store

K = 10
PARTS = 16  # of the fixed assignments
PER_PART = 100_000  # words of a part where the corpus decides their number
ALPHA, BETA = counts.ALPHA, counts.BETA


def documents(spark, sf_dir):
    return sample.documents(spark, sf_dir).select("doc_id", "text")


def tokens(spark, sf_dir):
    return corpus.lda_tokens(documents(spark, sf_dir))


def corpus_and_words(spark, sf_dir):
    """The long corpus and its numbered vocabulary, each computed once."""
    words = corpus.numbered_vocabulary(corpus.lda_words(documents(spark, sf_dir)))
    return corpus.corpus_long(tokens(spark, sf_dir), words), words


TOKENS = """split_docs AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '') AS words
  FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos, len(words) AS n FROM split_docs)"""
STOP, SERIAL_STOP = (
    ", ".join("'" + w.replace("'", "''") + "'" for w in words) for words in (corpus.STOPWORDS, corpus.SERIAL_STOPWORDS)
)
CORPUS = f"""{TOKENS},
vocab AS (SELECT word, count(DISTINCT doc_id) AS doc_freq FROM tokens WHERE word NOT IN ({STOP})
          GROUP BY word HAVING count(DISTINCT doc_id) >= {corpus.MIN_DF}),
words AS (SELECT word, doc_freq, row_number() OVER (ORDER BY word COLLATE C) - 1 AS word_id FROM vocab),
corpus AS (SELECT doc_id, pos, word_id, word FROM tokens JOIN words USING (word))""".replace(" COLLATE C", "")


@query(f"""WITH {TOKENS}, trimmed AS (SELECT doc_id, pos, CASE WHEN pos = 0 THEN substr(word, 2)
  WHEN pos = n - 1 THEN left(word, length(word) - 1) ELSE word END AS word FROM tokens)
SELECT 'plain' AS kind, word, count(*) AS n, CAST(sum(pos) AS BIGINT) AS places, count(DISTINCT doc_id) AS docs FROM tokens GROUP BY ALL
UNION ALL SELECT 'trimmed', word, count(*), CAST(sum(pos) AS BIGINT), count(DISTINCT doc_id) FROM trimmed GROUP BY ALL""")
def lda_tokens(spark, sf_dir):
    docs = documents(spark, sf_dir)
    both = corpus.lda_tokens(docs).withColumn("kind", F.lit("plain")).unionByName(
        corpus.lda_tokens(docs, edge_trim=True).withColumn("kind", F.lit("trimmed"))
    )
    return both.groupBy("kind", "word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("places"), F.count_distinct("doc_id").alias("docs")
    )


@query(f"""WITH {TOKENS}, df AS (SELECT word, count(DISTINCT doc_id) AS doc_freq FROM tokens GROUP BY word)
SELECT {corpus.MIN_DF} AS least, word, doc_freq FROM df WHERE doc_freq >= {corpus.MIN_DF}
UNION ALL SELECT 0, word, doc_freq FROM df""")
def vocabulary(spark, sf_dir):
    """Words under the usual document threshold, and all of them as in the runs per entity."""
    docs = corpus.lda_words(documents(spark, sf_dir))
    kept = [corpus.vocabulary(docs, least).select(F.lit(least).alias("least"), "*") for least in (corpus.MIN_DF, 0)]
    return kept[0].unionByName(kept[1])


@query(f"""WITH {TOKENS} SELECT 'inline' AS kind, word, count(*) AS n FROM tokens WHERE word NOT IN ({STOP}) GROUP BY ALL
UNION ALL SELECT 'serial', word, count(*) FROM tokens WHERE word NOT IN ({SERIAL_STOP}) GROUP BY ALL
UNION ALL SELECT 'table', word, count(*) FROM tokens WHERE word NOT IN (
  SELECT word FROM tokens GROUP BY word HAVING count(*) > 100) GROUP BY ALL""")
def drop_stopwords(spark, sf_dir):
    words = tokens(spark, sf_dir)
    frequent = words.groupBy("word").count().filter(F.col("count") > 100).select("word")
    kinds = {
        "inline": corpus.drop_stopwords(words), "serial": corpus.drop_stopwords(words, corpus.SERIAL_STOPWORDS),
        "table": corpus.drop_stopwords(words, frequent),
    }
    out = [df.groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(k)) for k, df in kinds.items()]
    return reduce(DataFrame.unionByName, out)


@query(f"""WITH {CORPUS} SELECT word_id, word, count(*) AS instances, count(DISTINCT doc_id) AS docs
FROM corpus GROUP BY ALL""")
def corpus_long(spark, sf_dir):
    return corpus.word_instances(*corpus_and_words(spark, sf_dir))


@query(f"WITH {TOKENS} SELECT CAST(doc_id % {PARTS} AS INT) AS part, count(*) AS n, count(DISTINCT doc_id) AS docs FROM tokens GROUP BY ALL")
def assign_parts(spark, sf_dir):
    dealt = corpus.assign_parts(tokens(spark, sf_dir), PARTS)
    return dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


# ---------------------------------------------------------------- fixed assignments


def topic_of(doc_factor: int, pos_factor: int):
    return F.pmod(F.col("doc_id") * doc_factor + F.col("pos") * pos_factor, F.lit(K)).cast("int")


def fixed_state(spark, sf_dir):
    """The corpus under a topic that follows from document and position; (state, words)."""
    long, words = corpus_and_words(spark, sf_dir)
    state = corpus.assign_parts(long, PARTS).withColumn("topic", topic_of(31, 7))
    return store(state, "assignment"), words


STATE = f"""{CORPUS}, state AS (
  SELECT *, CAST(doc_id % {PARTS} AS INT) AS part, CAST((doc_id * 31 + pos * 7) % {K} AS INT) AS topic FROM corpus),
v AS (SELECT count(*) AS size FROM words),
nwk AS (SELECT word_id, topic, count(*) AS n FROM state GROUP BY ALL),
nk AS (SELECT topic, count(*) AS n FROM state GROUP BY ALL),
ks AS (SELECT CAST(range AS INT) AS topic FROM range({K}))"""


@query(f"""WITH {CORPUS} SELECT word_id, CAST((doc_id * 17 + pos * 3) % {K} AS INT) AS topic, count(*) AS n
FROM corpus GROUP BY ALL""")
def lda_sync_counts(spark, sf_dir):
    before, _ = fixed_state(spark, sf_dir)
    after = before.withColumn("topic", topic_of(17, 3))
    changes = counts.part_changes(before, after)
    return counts.lda_sync_counts(counts.word_topic_counts(before), changes)


@query(f"""WITH {STATE}, nd AS (SELECT doc_id, count(*) AS n FROM state GROUP BY ALL),
ndk AS (SELECT doc_id, topic, count(*) AS n FROM state GROUP BY ALL)
SELECT 'phi' AS kind, ks.topic, words.word_id AS key,
  {fixed_sql(f'(coalesce(nwk.n, 0) + {BETA}::DOUBLE) / (coalesce(nk.n, 0) + v.size * {BETA}::DOUBLE)', 8)} AS p
FROM v, words, ks LEFT JOIN nwk ON nwk.word_id = words.word_id AND nwk.topic = ks.topic LEFT JOIN nk ON nk.topic = ks.topic
UNION ALL
SELECT 'theta', ks.topic, nd.doc_id,
  {fixed_sql(f'(coalesce(ndk.n, 0) + {ALPHA}::DOUBLE) / (nd.n + {K} * {ALPHA}::DOUBLE)', 8)}
FROM nd, ks LEFT JOIN ndk ON ndk.doc_id = nd.doc_id AND ndk.topic = ks.topic""")
def lda_phi_theta(spark, sf_dir):
    state, words = fixed_state(spark, sf_dir)
    phi = counts.lda_phi(counts.word_topic_counts(state), K, words.count())
    theta = counts.lda_theta(counts.doc_topic_counts(state), K)
    return (
        phi.select(F.lit("phi").alias("kind"), "topic", F.col("word_id").alias("key"), fixed("p", 8).alias("p"))
        .unionByName(
            theta.select(F.lit("theta").alias("kind"), "topic", F.col("doc_id").alias("key"), fixed("p", 8).alias("p"))
        )
    )


@query(f"""WITH {STATE}, local_wk AS (SELECT part, word_id, topic, count(*) AS n FROM state GROUP BY ALL),
local_k AS (SELECT part, topic, sum(n) AS n FROM local_wk GROUP BY ALL),
filled AS (SELECT part, sum(lgamma(n + {BETA}::DOUBLE)) AS s, count(*) AS cells FROM local_wk GROUP BY ALL),
spread AS (SELECT p.part, sum(lgamma(coalesce(n, 0) + v.size * {BETA}::DOUBLE)) AS s
           FROM v, (SELECT DISTINCT part FROM state) p, ks
           LEFT JOIN local_k l ON l.part = p.part AND l.topic = ks.topic GROUP BY ALL),
whole AS (SELECT (SELECT sum(lgamma(n + {BETA}::DOUBLE)) FROM nwk) AS f, (SELECT count(*) FROM nwk) AS cells,
          (SELECT sum(lgamma(coalesce(n, 0) + v.size * {BETA}::DOUBLE)) FROM v, ks LEFT JOIN nk USING (topic)) AS s)
SELECT part, {fixed_sql(f'''{K} * (lgamma(v.size * {BETA}::DOUBLE) - v.size * lgamma({BETA}::DOUBLE)) - spread.s + filled.s
       + (v.size * {K} - cells) * lgamma({BETA}::DOUBLE)''', 3)} AS loglik
FROM v, filled JOIN spread USING (part)
UNION ALL
SELECT -1, {fixed_sql(f'''{K} * (lgamma(v.size * {BETA}::DOUBLE) - v.size * lgamma({BETA}::DOUBLE)) - s + f
       + (v.size * {K} - cells) * lgamma({BETA}::DOUBLE)''', 3)} FROM v, whole""")
def lda_loglik(spark, sf_dir):
    state, words = fixed_state(spark, sf_dir)
    size = words.count()
    by_part = counts.lda_loglik(counts.word_topic_counts(state, "part"), K, size, BETA, "part")
    whole = counts.lda_loglik(counts.word_topic_counts(state), K, size).withColumn("part", F.lit(-1))
    return by_part.unionByName(whole).select("part", fixed("loglik", 3).alias("loglik"))


PHI = f"""{STATE}, phi AS (
  SELECT nwk.topic, word, word_id, (nwk.n + {BETA}::DOUBLE) / (nk.n + v.size * {BETA}::DOUBLE) AS p
  FROM v, nwk JOIN nk USING (topic) JOIN words USING (word_id)),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY p DESC, word_id) AS INT) AS rank FROM phi
        QUALIFY rank <= 10)"""


def top_words(state, words):
    return counts.topic_top_words(store(counts.word_topic_counts(state), "counts"), words, K, words.count())


@query(f"WITH {PHI} SELECT topic, rank, word, {fixed_sql('p', 8)} AS p FROM top")
def topic_top_words(spark, sf_dir):
    state, words = fixed_state(spark, sf_dir)
    return top_words(state, words).withColumn("p", fixed("p", 8))


ENTITY_COUNTS = """nek AS (SELECT entity_whole AS entity, topic, count(*) AS n FROM state JOIN entity_docs USING (doc_id) GROUP BY ALL)"""


@query(f"WITH {STATE}, {ENTITY_DOCS}, {ENTITY_COUNTS} SELECT entity, topic, n FROM nek")
def doc_label_join(spark, sf_dir):
    state, _ = fixed_state(spark, sf_dir)
    labels = documents_with_entity(spark, sf_dir, chars=None).select("doc_id", "entity")
    return counts.doc_label_join(counts.doc_topic_counts(state), labels)


@query(f"""WITH {PHI}, {ENTITY_DOCS}, {ENTITY_COUNTS},
theta AS (SELECT entity, topic, (n + {ALPHA}::DOUBLE) / (sum(n) OVER (PARTITION BY entity) + {K} * {ALPHA}::DOUBLE) AS p FROM nek),
lead_topic AS (SELECT entity, topic, p FROM theta QUALIFY row_number() OVER (PARTITION BY entity ORDER BY p DESC, topic) = 1)
SELECT entity, topic, {fixed_sql('lead_topic.p', 8)} AS share, rank, word FROM lead_topic JOIN top USING (topic)""")
def entity_topics(spark, sf_dir):
    state, words = fixed_state(spark, sf_dir)
    labels = documents_with_entity(spark, sf_dir, chars=None).select("doc_id", "entity")
    by_entity = counts.doc_label_join(counts.doc_topic_counts(state), labels)
    return counts.entity_topics(by_entity, top_words(state, words), K).withColumn("share", fixed("share", 8))


@query(f"""WITH {STATE}, damaged AS (SELECT word_id, topic, n + 1 AS n FROM nwk WHERE topic = 3)
SELECT d.word_id, d.topic, d.n, nwk.n AS recounted FROM damaged d JOIN nwk USING (word_id, topic)""")
def check_counts(spark, sf_dir):
    """Counts with one topic put off by one: exactly that topic's rows are reported."""
    state, _ = fixed_state(spark, sf_dir)
    off = F.when(F.col("topic") == 3, F.col("n") + 1).otherwise(F.col("n"))
    return counts.check_counts(state, counts.word_topic_counts(state).withColumn("n", off))


@query(f"WITH {TOKENS} SELECT doc_id, CAST(pos AS INT) AS pos FROM tokens WHERE word = 'rewh'")
def token_positions(spark, sf_dir):
    return corpus.token_positions(tokens(spark, sf_dir), "rewh")


@query("""WITH offs AS (SELECT doc_id, text, unnest(range(1, length(text) + 1)) AS i FROM documents WHERE contains(text, 'thth'))
SELECT doc_id, i - 1 AS pos FROM offs WHERE substr(text, i, 4) = 'thth'""")
def substring_positions(spark, sf_dir):
    return corpus.substring_positions(documents(spark, sf_dir), "thth")


# ---------------------------------------------------------------- sampling

PARTS_SQL = f"parts AS (SELECT CAST(greatest(1, ceil(count(*) / {PER_PART}.0)) AS BIGINT) AS size FROM corpus)"
DEALT = f"{CORPUS}, {PARTS_SQL}, dealt AS (SELECT *, CAST(doc_id % (SELECT size FROM parts) AS INT) AS part FROM corpus)"
SWEPT = """SELECT part, count(*) AS n, count(DISTINCT doc_id) AS docs, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS lost,
  {change} AS change, true AS moved, CAST(0 AS BIGINT) AS counts_off FROM dealt GROUP BY ALL"""


def parts_of(long) -> int:
    return gibbs.parts_needed(long.count(), PER_PART)


def account(before, state, reported, counts_before):
    """What a pass over the parts did, part by part.

    Words and documents; topics out of range; words that are not where they were in the
    packed documents ``before``; the sum of the reported changes; whether these say that at
    least one topic in ten moved; and, for all parts, counts that differ between the state
    and the old counts with the changes put in.
    """
    old = before.select("part", "doc_id", F.struct("places", "words").alias("was"))
    new = gibbs.documents(state).select("part", "doc_id", F.struct("places", "words").alias("now"), "topics")
    both = new.join(old, ["part", "doc_id"], "full")
    size = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in ("now.words", "was.words")])
    same = F.coalesce((F.col("now") == F.col("was")) & (F.size("topics") == F.size("was.words")), F.lit(False))
    outside = (F.array_min("topics") < 0) | (F.array_max("topics") >= K)
    by_part = both.groupBy("part").agg(
        F.sum(F.coalesce(F.size("now.words"), F.lit(0)).cast("long")).alias("n"), F.count("now").alias("docs"),
        F.count_if(outside).alias("misplaced"), F.sum(F.when(same, 0).otherwise(size).cast("long")).alias("lost"),
    )
    changes = reported.groupBy("part").agg(F.sum("n").alias("change"), F.sum(F.abs("n")).alias("_by"))
    off = counts.check_counts(gibbs.assignments(state), counts.lda_sync_counts(counts_before, reported))
    off = off.agg(F.count(F.lit(1)).alias("counts_off"))
    joined = by_part.join(changes, "part", "left").withColumn("counts_off", off.scalar())
    # a word that moves changes two counts by one
    moved = F.coalesce(F.col("_by") * 5 > F.col("n"), F.lit(False))
    return joined.select("part", "n", "docs", "misplaced", "lost", F.coalesce("change", F.lit(0).cast("long")).alias("change"), moved.alias("moved"), "counts_off")


@query(f"WITH {DEALT} {SWEPT.format(change='count(*)')}")
def lda_init(spark, sf_dir):
    """First topics: every change is an addition, so they sum to the words of a part."""
    long, words = corpus_and_words(spark, sf_dir)
    long = store(long.drop("word"), "corpus")
    parts = parts_of(long)
    docs = store(gibbs.packed(corpus.assign_parts(long, parts)), "packed")
    state = store(gibbs.lda_init(docs, parts, K, words.count(), seed=1), "state")
    nothing = spark.createDataFrame([], gibbs.COUNTS)
    return account(docs, state, gibbs.reported_changes(state), nothing)


@query(f"WITH {DEALT} {SWEPT.format(change='CAST(0 AS BIGINT)')}")
def lda_gibbs_sweep(spark, sf_dir):
    """One sweep from a fixed assignment."""
    long, words = corpus_and_words(spark, sf_dir)
    long = store(long.drop("word"), "corpus")
    parts = parts_of(long)
    before = corpus.assign_parts(long, parts).withColumn("topic", topic_of(31, 7))
    docs = store(gibbs.packed(before), "packed")
    old, in_part = store(counts.word_topic_counts(before), "counts"), store(gibbs.part_words(gibbs.in_packs(docs, parts)), "part-words")
    swept = gibbs.lda_gibbs_sweep(docs, old, in_part, parts, K, words.count(), step=1, seed=1)
    swept = store(swept, "state")
    return account(docs, swept, gibbs.reported_changes(swept), old)


ITERATIONS = 3  # of the fit whose stored rows ``sink_loglik`` shows


@query(f"""WITH {DEALT} SELECT part, count(*) AS n, true AS rises, CAST(0 AS BIGINT) AS counts_off FROM dealt GROUP BY ALL""")
def fit_lda(spark, sf_dir):
    """A full run; per part its words and whether its log-likelihood rose, and counts that a recount contradicts."""
    long, words = corpus_and_words(spark, sf_dir)
    long = store(long.drop("word"), "corpus")
    state, word_topic, logliks = gibbs.fit_lda(long, words.count(), K, gibbs.ITERATIONS, parts_of(long), seed=1)
    ends = logliks.filter(F.col("iter") > 0).groupBy("part").agg(  # the first assignment saw local counts only
        F.min_by("loglik", F.struct("iter", F.col("phase") == "after")).alias("first"),
        F.max_by("loglik", F.struct("iter", F.col("phase") == "after")).alias("last"),
    )
    off = counts.check_counts(state, word_topic).agg(F.count(F.lit(1)).alias("n")).scalar()
    sizes = state.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(ends, "part").select(
        "part", "n", (F.col("last") > F.col("first")).alias("rises"), off.alias("counts_off")
    )


@query(f"""WITH {DEALT}, held AS (SELECT DISTINCT part FROM dealt)
SELECT CAST(i AS INT) AS iter, part, phase, true AS finite
FROM range({ITERATIONS + 1}) a(i), held, (VALUES ('before'), ('after')) c(phase)
WHERE i > 0 OR phase = 'after'""")
def sink_loglik(spark, sf_dir):
    """The stored log-likelihood rows of a fit, one per iteration, part and phase, all finite and negative."""
    long, words = corpus_and_words(spark, sf_dir)
    long = store(long.drop("word"), "corpus")
    _, _, logliks = gibbs.fit_lda(long, words.count(), K, ITERATIONS, parts_of(long), seed=2)
    finite = F.col("loglik").between(F.lit(-1e300), F.lit(0.0))
    return logliks.select("iter", "part", "phase", finite.alias("finite"))
