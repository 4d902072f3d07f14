"""Line deduplication by a log-template tree, in DataFrame operations only.

A line's place in the tree is fixed: its number of tokens, then its leading tokens. Tokens
with a digit are variable fields from the start, but a line that is mostly fields is
content: its fields stay as they are and it forms a leaf alone. The lines of a leaf are held against the
most frequent of them; those that agree with it in most places share its template, the
others against the most frequent among themselves, and so on until none is left. Templates, and runs of
adjacent lines, that recur across documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.names import spare
from tidemark.session import store

DEPTH = 3
ALIKE = 70
REDUNDANT = 24
SEEDS = 4
HEADS = 256  # of a leaf, judged in one round at most; what is left of it waits for the next
HEAD_TOKENS = 1 << 20
FIELD = "<*>"
_SPACES = " \t\r\f\x0b"


def _count(body: Column) -> Column:
    blanks = F.octet_length(body) - F.octet_length(F.replace(body, F.lit(" "), F.lit("")))
    return F.when(body == "", 0).otherwise(blanks + 1)


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with its tokens as one string (``body``), their number, and ``odd`` where it may have a digit.

    Tokens are joined by single blanks; those with a digit are a field, unless they are more than half. Most lines
    have single blanks and no digit; one test spares them the replacements. Each step is a column of its own:
    inside one expression, what stands under a condition would be worked out again wherever it is used.
    """
    rows = docs.select("doc", "row", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.select("doc", "row", "pos", F.btrim("line", F.lit(_SPACES)).alias("bare"))
    rows = rows.withColumn("odd", F.col("bare").rlike("[0-9\t\r\f\x0b]") | F.contains("bare", F.lit("  ")))
    single = F.regexp_replace("bare", f"[{_SPACES}]+", " ")
    rows = rows.withColumn("single", F.when(F.col("odd"), single).otherwise(F.col("bare")))
    # only a token's start is tried, and nothing in it twice
    masked = F.regexp_replace("single", "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)
    rows = rows.withColumn("masked", F.when(F.col("odd"), masked).otherwise(F.col("single")))
    rows = rows.withColumn("n", _count(F.col("masked")))
    fields = F.octet_length("masked") - F.octet_length(F.replace(F.col("masked"), F.lit(FIELD), F.lit(FIELD[1:])))
    body = F.when(F.col("odd") & (2 * fields > F.col("n")), F.col("single")).otherwise(F.col("masked"))
    return rows.select("doc", "row", "pos", body.alias("body"), "n", "odd")


def _leaf(depth: int) -> Column:
    """Lines above ``depth`` and lines that are mostly fields (only these have a digit left) are leaves alone."""
    alone = (F.col("n") < depth) | (F.col("odd") & F.col("body").rlike("[0-9]"))
    return F.xxhash64("n", F.when(alone, F.col("body")).otherwise(F.substring_index("body", " ", depth)), alone)


def _partnered(rest: DataFrame, depth: int, alike: int) -> DataFrame:
    """Lines that may be alike to another line of their leaf: those that share a block of places with one.

    Lines alike differ in ``n * (100 - alike) / 100`` places at most. Cut into one block more than that, the places
    behind the leading tokens leave one block equal, so a line that shares none is alike to no other.
    """
    tokens = rest.select("leaf", "line", F.split("body", " ").alias("tokens"))
    places = F.size("tokens") - F.lit(depth)
    blocks = F.greatest(F.floor(F.size("tokens") * (100 - alike) / 100), F.lit(0)) + 1

    def block(i: Column) -> Column:
        start = F.floor(i * places / blocks)
        return F.xxhash64(i, F.slice("tokens", (start + depth + 1).cast("int"), (F.floor((i + 1) * places / blocks) - start).cast("int")))

    cut = tokens.select("leaf", "line", F.explode_outer(F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), block)).alias("block"))
    cut = store(cut, "leaf-blocks")
    held = cut.groupBy("leaf", "block").agg(F.min("line").alias("least"), F.max("line").alias("most"))
    shared = cut.join(held.filter("least < most").select("leaf", "block"), ["leaf", "block"], "left_semi")
    return rest.join(shared.select("leaf", "line").distinct(), ["leaf", "line"], "left_semi")


def _alike(a: Column, b: Column, alike: int) -> Column:
    """Whether two arrays of tokens, of one length, agree in ``alike`` percent of their places or more."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return 100 * same >= alike * F.size(a)


def _seeded(variants: DataFrame, depth: int, alike: int, seeds: int) -> DataFrame:
    """Lines that came to a seed of their leaf, the seed included: ``leaf``, ``line``, ``template``.

    The lines of a leaf are taken by their documents, most first, ties to the larger hash. A line that agrees with no
    seed before it in ``alike`` percent of its places or more is a seed itself; the others go to the first seed
    they agree with. A round judges the first lines of what is left of each leaf, ``seeds`` of them and more in
    later rounds, and then all others against the seeds among them; rounds go on until no line is left that
    may be alike to another. Lines alike to none are left out.
    """
    first = Window.partitionBy("leaf").orderBy(F.desc("docs"), F.desc(F.md5("body")), F.desc("line"))
    no_seed = F.array().cast("array<struct<line:bigint,tokens:array<string>>>")
    settled, rest = None, variants
    while True:
        rest = store(_partnered(rest, depth, alike), "leaf-rest")
        if settled is not None and rest.isEmpty():
            return settled
        # the first limit is one that Spark also applies before it brings a leaf together; the other bounds a leaf's row
        heads = rest.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= seeds)
        heads = heads.filter((F.col("at") == 1) | (F.col("at") * _count(F.col("body")) <= HEAD_TOKENS))
        heads = heads.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("at", "line", F.split("body", " ").alias("tokens")))).alias("heads"))
        grown = F.aggregate(
            "heads",
            no_seed,
            lambda got, x: F.when(F.exists(got, lambda s: _alike(s["tokens"], x["tokens"], alike)), got).otherwise(
                F.array_append(got, F.struct(x["line"].alias("line"), x["tokens"].alias("tokens")))
            ),
        )
        grown = store(heads.select("leaf", grown.alias("grown")), "leaf-seeds")
        # a column of its own, used twice: inside the lambda the line would be cut again for every seed
        near = rest.withColumn("tokens", F.split("body", " ")).join(grown, "leaf")
        found = F.filter("grown", lambda s: (F.size("tokens") == F.size(s["tokens"])) & _alike(s["tokens"], F.col("tokens"), alike))
        near = near.select("leaf", "line", F.get(found, F.lit(0))["line"].alias("template")).filter("template is not null")
        near = store(near, "leaf-lines")
        settled = near if settled is None else settled.unionByName(near)
        rest = rest.join(near, ["leaf", "line"], "left_anti")
        seeds = max(seeds, min(4 * seeds, HEADS))


def _templates(lines: DataFrame, placed: DataFrame, depth: int, alike: int, seeds: int) -> DataFrame:
    """Every kind of line with its template, the documents that hold the template, and the first of them.

    Columns ``leaf``, ``line``, ``template``, ``docs``, ``first``. Texts are read a second time for the lines of leaves
    that hold several kinds; repeats of a line go before lines meet by leaf, so a crowded leaf is a matter of kinds.
    """
    seen = placed.select("leaf", "line", "doc").distinct()
    kinds = store(seen.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first")), "line-kinds")
    crowded = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("leaf")
    several = store(kinds.join(crowded, "leaf").select("leaf", "line", "docs"), "crowded-leaves")
    # keys that cannot be null spare the join a null test, for which Spark would parse every line again
    bodies = lines.select(F.coalesce(_leaf(depth), F.lit(0)).alias("leaf"), F.xxhash64("body").alias("line"), "body")
    # few lines are in such leaves: the others go before texts are dealt out, and repeats are found by hashing, without a sort
    variants = bodies.join(several, ["leaf", "line"]).groupBy("leaf", "line", "body").agg(F.max("docs").alias("docs"))
    settled = _seeded(store(variants, "leaf-bodies"), depth, alike, seeds)
    several_lines = settled.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    merged = store(settled.join(several_lines, ["leaf", "template"]), "merged-lines")
    counted = (
        placed.join(merged, ["leaf", "line"])
        .select("leaf", "template", "doc")
        .distinct()
        .groupBy("leaf", "template")
        .agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first"))
    )
    alone = kinds.join(merged, ["leaf", "line"], "left_anti").select("leaf", "line", F.col("line").alias("template"), "docs", "first")
    return alone.unionByName(merged.join(counted, ["leaf", "template"]).select(alone.columns))


def _windows(flags: str, redundant: int) -> Column:
    """From each line below the mark on, the fewest lines of recurring templates that reach it together.

    ``flags`` holds no lines without tokens. Every window has the first and last position and a hash of its templates.
    """

    def window(line: Column, i: Column) -> Column:
        ahead = F.slice(flags, i + 1, F.lit(redundant))
        zero = F.struct(
            F.lit(0).alias("tokens"), F.lit(True).alias("again"), F.lit(False).alias("below"), F.lit(0).alias("last"),
            F.lit(0).cast("long").alias("run"),
        )
        run = F.aggregate(
            ahead,
            zero,
            lambda got, x: F.when((got.tokens >= redundant) | ~got.again, got).otherwise(
                F.struct(
                    (got.tokens + x.n).alias("tokens"), x.mark.isNotNull().alias("again"), (got.below | x.below).alias("below"),
                    x.pos.alias("last"), F.xxhash64(got.run, x.mark).alias("run"),
                )
            ),
        )
        whole = F.struct(line.pos.alias("first"), run.alias("run"))
        return F.when((line.n < redundant) & line.mark.isNotNull(), whole)

    found = F.transform(flags, window)
    return F.filter(
        found, lambda w: w.isNotNull() & (w.run.tokens >= redundant) & w.run.again & w.run.below & (w.run.last > w.first)
    )


def drop_recurring(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    alike: int = ALIKE,
    redundant: int = REDUNDANT,
    seeds: int = SEEDS,
) -> DataFrame:
    """All columns of ``docs`` with recurring lines taken out of ``text``, and ``n_lines`` and ``n_dropped``.

    A template recurs where the documents beyond its first hold at least ``redundant``
    tokens of it (lines that are mostly fields have a common template only where their
    fields are equal too), that is ``(documents - 1) * tokens``: a passage of fifty words in two
    documents does, a line of three words from nine documents on, one of a single word from 25 on.
    Adjacent lines are also judged together: from a line on, the fewest lines that have ``redundant``
    tokens recur where a second document holds lines of the same templates in a row, whatever
    empty lines stand between. What recurs is dropped everywhere but in the document with the
    smallest id, which keeps it, so no text is lost altogether. A leaf gathers its lines around as
    many lines as it takes, ``seeds`` of them in the first round and more in later ones (the number does not change
    the result); a line alike to no other recurs only as it is.
    Counts are over all documents; a document counts once for a template, however often
    it repeats the line.

    Lines end at line feeds; tokens are separated by blanks, tabs and the like. A kept line
    stays as it is, also where it is empty. Null texts stay null, with no lines. Rows of
    one id are one document; a row with a null id is a document of its own text that comes
    before all others. Repeated rows all come out. An empty table gives no rows. The new
    columns replace any of their name.
    """
    docs = docs.drop("n_lines", "n_dropped")
    doc_key, row_key, gone_key, parts_key = spare(docs, "_doc", "_row", "_gone", "_parts")
    row = F.xxhash64(F.col(key), F.col(text))
    alone = F.lit(-1).cast("long") - F.xxhash64(F.col(text)).bitwiseAND(F.lit((1 << 63) - 1))
    keyed = docs.withColumns({doc_key: F.coalesce(F.col(key).cast("long"), alone), row_key: row})
    bare = keyed.filter(F.col(text).isNotNull()).select(
        F.col(doc_key).alias("doc"), F.col(row_key).alias("row"), F.col(text).alias("text")
    )
    lines = _lines(bare)
    placed = lines.select("doc", "row", "pos", "n", _leaf(depth).alias("leaf"), F.xxhash64("body").alias("line"))
    placed = store(placed, "line-places").filter("n > 0")
    twice = _templates(lines, placed, depth, alike, seeds).filter("docs > 1")
    # stored, so that the join deals out both sides itself and can split a line that very many documents hold
    twice = store(twice.select("leaf", "line", F.xxhash64("leaf", "template").alias("mark"), "docs", "first"), "recurring")
    enough = (F.col("docs") - 1) * F.col("n") >= redundant
    judged = placed.join(twice, ["leaf", "line"], "left").select(
        "doc", "row", "pos", "n", "mark",
        F.coalesce(~enough, F.lit(False)).alias("below"),
        F.coalesce(enough & (F.col("doc") != F.col("first")), F.lit(False)).alias("gone"),
    )
    flags = judged.groupBy("doc", "row").agg(F.sort_array(F.collect_set(F.struct("pos", "n", "mark", "below", "gone"))).alias("flags"))
    flags = store(flags.filter(F.exists("flags", lambda x: x.gone | x.below)), "line-flags")
    windows = flags.filter(F.exists("flags", lambda x: x.below)).select(
        "doc", "row", F.explode_outer(_windows("flags", redundant)).alias("w")
    )
    windows = windows.filter("w is not null").select("doc", "row", "w.first", "w.run.last", "w.run.run")
    windows = store(windows, "line-windows")
    runs = windows.select("run", "doc").distinct().groupBy("run").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("least"))
    runs = store(runs.filter("docs > 1").select("run", "least"), "recurring-runs")
    spans = windows.join(runs, "run").filter("doc <> least").groupBy("doc", "row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    covered = F.flatten(F.transform("spans", lambda w: F.sequence(w["first"], w["last"])))
    single = F.filter("flags", lambda x: x.gone).getField("pos")
    gone = F.array_union(single, F.coalesce(F.array_intersect("flags.pos", covered), F.array().cast("array<int>")))
    hit = flags.join(spans, ["doc", "row"], "left").select(
        F.col("doc").alias(doc_key), F.col("row").alias(row_key), gone.alias(gone_key)
    )
    joined = keyed.join(hit.filter(F.size(gone_key) > 0).hint("shuffle_hash"), [doc_key, row_key], "left")
    # a column of its own, used several times: inside the lambda the text would be cut again for every line
    joined = joined.withColumn(parts_key, F.split(F.col(text), "\n"))
    parts = F.col(parts_key)
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone_key))
    kept = F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    return joined.select(
        *[F.when(F.col(gone_key).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text else c for c in docs.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone_key), F.lit(0)).cast("long").alias("n_dropped"),
    )


_BLANK = "[ \\t\\r\\f\\x0B]"
_WORD = "[^ \\t\\r\\f\\x0B]*"

def _rounds(seeds: int) -> str:
    """The rounds of a leaf: its seed, what is alike to it, and what is left."""
    return ", ".join(
        f"""seed{i} AS MATERIALIZED (
  SELECT leaf, body AS seed FROM rest{i}
  QUALIFY count(*) OVER (PARTITION BY leaf) > 1 AND row_number() OVER (PARTITION BY leaf ORDER BY docs DESC, md5(body) DESC) = 1
), near{i} AS MATERIALIZED (
  SELECT leaf, body, seed FROM rest{i} JOIN seed{i} USING (leaf)
  WHERE 100 * len(list_filter(list_zip(string_split(body, ' '), string_split(seed, ' ')), lambda x: x[1] = x[2])) >= {ALIKE} * n
), rest{i + 1} AS MATERIALIZED (SELECT * FROM rest{i} ANTI JOIN near{i} USING (leaf, body))"""
        for i in range(seeds)
    )


SQL = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), bare AS (
  SELECT doc_id, pos, line,
         regexp_replace(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_BLANK}+', ' ', 'g') AS bare FROM lines
), masked AS (
  SELECT *, regexp_replace(bare, '{_WORD}[0-9]{_WORD}', '{FIELD}', 'g') AS masked,
         CASE WHEN bare = '' THEN 0 ELSE len(string_split(bare, ' ')) END AS n
  FROM bare
), bodies AS (
  SELECT doc_id, pos, line, n,
         CASE WHEN 2 * (strlen(masked) - strlen(replace(masked, '{FIELD}', '{FIELD[1:]}'))) > n THEN bare ELSE masked END AS body
  FROM masked
), placed AS MATERIALIZED (
  SELECT *, CASE WHEN n < {DEPTH} OR regexp_matches(body, '[0-9]') THEN '= ' || body
                 ELSE n || ' ' || array_to_string(string_split(body, ' ')[1:{DEPTH}], ' ') END AS leaf
  FROM bodies
), kinds AS MATERIALIZED (
  SELECT leaf, body, any_value(n) AS n, count(DISTINCT doc_id) AS docs FROM placed WHERE n > 0 GROUP BY leaf, body
), rest0 AS (SELECT leaf, body, n, docs FROM kinds), {_rounds(SEEDS)}, named AS MATERIALIZED (
  {" UNION ALL ".join(f"SELECT leaf, body, seed AS template FROM near{i}" for i in range(SEEDS))}
  UNION ALL SELECT leaf, body, body FROM rest{SEEDS}
), twice AS (
  SELECT leaf, template, min(doc_id) AS first, count(DISTINCT doc_id) AS docs, min(n) AS n
  FROM placed JOIN named USING (leaf, body) GROUP BY leaf, template HAVING count(DISTINCT doc_id) > 1
), judged AS MATERIALIZED (
  SELECT p.doc_id, p.pos, p.line, p.n, md5(t.leaf || chr(10) || t.template) AS mark,
         coalesce((t.docs - 1) * t.n >= {REDUNDANT} AND p.doc_id <> t.first, false) AS gone
  FROM placed p LEFT JOIN named USING (leaf, body) LEFT JOIN twice t ON t.leaf = named.leaf AND t.template = named.template
), solid AS MATERIALIZED (
  SELECT doc_id, pos, n, mark, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM judged WHERE n > 0
), ahead AS (
  SELECT doc_id, r, unnest(range(r, r + {REDUNDANT})) AS e FROM solid WHERE mark IS NOT NULL AND n < {REDUNDANT}
), summed AS (
  SELECT a.doc_id, a.r, a.e, s.n, s.mark, sum(s.n) OVER (PARTITION BY a.doc_id, a.r ORDER BY a.e) AS upto
  FROM ahead a JOIN solid s ON s.doc_id = a.doc_id AND s.r = a.e
), windows AS MATERIALIZED (
  SELECT doc_id, r, max(e) AS e, string_agg(mark, ' ' ORDER BY e) AS run
  FROM summed WHERE upto - n < {REDUNDANT} GROUP BY doc_id, r HAVING sum(n) >= {REDUNDANT} AND bool_and(mark IS NOT NULL)
), runs AS (
  SELECT run, min(doc_id) AS first FROM windows GROUP BY run HAVING count(DISTINCT doc_id) > 1
), covered AS (
  SELECT DISTINCT doc_id, r FROM (
    SELECT doc_id, unnest(range(r, e + 1)) AS r FROM windows JOIN runs USING (run) WHERE doc_id <> runs.first)
), ended AS (
  SELECT j.doc_id, j.pos, j.line, j.gone OR c.r IS NOT NULL AS gone
  FROM judged j LEFT JOIN solid s ON s.doc_id = j.doc_id AND s.pos = j.pos
  LEFT JOIN covered c ON c.doc_id = s.doc_id AND c.r = s.r
), kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
  FROM ended GROUP BY doc_id
)
SELECT d.doc_id, k.text, d.lang, d.source, d.n_chars,
       CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)"""
