"""Near-duplicate documents by min-max hashing, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import mixed, slices, stream_of, utf8_view
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets
from tidemark.session import store

WIDTH = 5
PERMUTATIONS = 30
BAND = 3
CHUNK = 256
MEMBERS = 64
WHOLE = 1024
DEVIATIONS = 4
COLUMNS = 1 << 14
SLICE = 1 << 20  # bytes of text at a time: shingles take about fifty bytes of memory a byte, which workers keep
_FEATURES = "n_shingles long, d1 long, d2 long, bands array<long>"


def signatures(
    sets: np.ndarray, ends: np.ndarray, permutations: int = PERMUTATIONS
) -> np.ndarray:
    """Minimum and maximum of every non-empty set under each permutation, one row per set.

    The two extremes of one pass serve as two signature values, so ``2 * permutations``
    values cost ``permutations`` hash evaluations per shingle.
    """
    begins = ends[:-1][np.diff(ends) > 0]
    out = np.empty((len(begins), 2 * permutations), dtype=np.uint64)
    if not len(begins):
        return out
    factors, shifts = stream_of(3, permutations) | np.uint64(1), stream_of(5, permutations)
    for k in range(permutations):
        moved = sets * factors[k] + shifts[k]
        moved ^= moved >> np.uint64(29)
        out[:, 2 * k] = np.minimum.reduceat(moved, begins)
        out[:, 2 * k + 1] = np.maximum.reduceat(moved, begins)
    return out


def band_keys(values: np.ndarray, band: int = BAND) -> np.ndarray:
    """One hash per band of ``band`` signature values; the band's number is part of it."""
    rows, width = values.shape
    bands = width // band
    parts = values[:, : bands * band].reshape(rows, bands, band) * (stream_of(7, band) | np.uint64(1))
    return mixed(parts.sum(axis=2, dtype=np.uint64) + stream_of(13, bands))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: set size, a 128-bit digest of the set, and band keys.

    A null text counts as empty: size 0, no bands. ``mark`` tells rows of one id apart
    by their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, at = utf8_view(batch.column("text"))
            sets, ends = shingle_sets(data, at, width)
            sizes = np.diff(ends)
            full = sizes > 0
            values = signatures(sets, ends)
            keys = band_keys(values)
            digests = np.zeros((2, len(sizes)), dtype=np.uint64)
            if len(sets):
                begins = ends[:-1][full]
                digests[0, full] = np.add.reduceat(mixed(sets), begins)
                digests[1, full] = np.add.reduceat(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), begins)
            at_bands = np.concatenate([[0], np.cumsum(full * keys.shape[1])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(sizes),
                    pa.array(digests[0].view(np.int64)),
                    pa.array(digests[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at_bands), pa.array(keys.reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "mark", "n_shingles", "d1", "d2", "bands"],
            )

    return _texts(docs, key, text).mapInArrow(run, f"doc_id long, mark long, {_FEATURES}")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole).alias("mark"), whole.alias("text"))


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int, width: int = WIDTH) -> DataFrame:
    """The pairs (``a``, ``b``, with their marks) whose whole sets reach ``percent``, with ``a`` the centre of a group.

    Only documents named in a pair are looked up. A centre's members are dealt into groups
    of about ``MEMBERS``; each group streams past its centre's set, so a task holds one set
    at a time.
    """
    group = [F.col("a").alias("g"), F.col("a_mark").alias("g_mark"), "salt"]
    groups = pairs.groupBy("a", "a_mark").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("n"))
    dealt = pairs.join(store(groups, "groups"), ["a", "a_mark"])
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("b", "b_mark"), F.col("n")))
    centres = dealt.select(F.col("a").alias("doc_id"), F.col("a_mark").alias("mark"), *group, F.lit(0).alias("part")).distinct()
    members = dealt.select(F.col("b").alias("doc_id"), F.col("b_mark").alias("mark"), *group, F.lit(1).alias("part"))
    wanted = centres.unionByName(members)
    rows = _texts(docs, key, text).join(wanted.hint("shuffle_hash"), ["doc_id", "mark"])
    rows = rows.repartition("g", "g_mark", "salt").sortWithinPartitions("g", "g_mark", "salt", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, centre = None, np.empty(0, np.uint64)
        for batch in slices(batches, "text", SLICE):
            data, at = utf8_view(batch.column("text"))
            sets, ends = shingle_sets(data, at, width)
            good = []
            columns = [batch.column(name).to_pylist() for name in ("g", "g_mark", "salt", "part")]
            for row, (*tag, part) in enumerate(zip(*columns, strict=True)):
                own = sets[ends[row] : ends[row + 1]]
                if part == 0:
                    held, centre = tag, own.copy()
                elif held == tag:
                    both = len(np.intersect1d(centre, own, assume_unique=True))
                    if 100 * both >= percent * (len(centre) + len(own) - both):
                        good.append(row)
            found = batch.select(["g", "g_mark", "doc_id", "mark"]).take(pa.array(good, pa.int64()))
            yield found.rename_columns(["a", "a_mark", "b", "b_mark"])

    wanted = ["g", "g_mark", "salt", "part", "doc_id", "mark", "text"]
    return rows.select(*wanted).mapInArrow(run, "a long, a_mark long, b long, b_mark long")


def _joined(links: DataFrame) -> DataFrame:
    """Per linked document (``rep``, ``mark``) the smallest one it is joined with: ``component``, ``component_mark``.

    A document is its id and the mark of its text, so texts that share an id are nodes of their own.
    """
    ends = [F.struct(F.col(end).alias("id"), F.col(f"{end}_mark").alias("mark")).alias(end) for end in ("a", "b")]
    return components(links.select(*ends)).select(
        F.col("node.id").alias("rep"),
        F.col("node.mark").alias("mark"),
        F.col("component.id").alias("component"),
        F.col("component.mark").alias("component_mark"),
    )


def _below(values: np.ndarray, halvings: int) -> np.ndarray:
    """The sorted hashes below a bound that is halved so many times; all of them under the whole one."""
    return values[: np.searchsorted(values, np.uint64(1 << (64 - halvings)))] if halvings else values


def _sketches(rows: DataFrame, width: int) -> DataFrame:
    """Hashes of the shingles of documents that are given with their text.

    A set of up to ``WHOLE`` shingles is kept whole. From larger ones only hashes below a
    bound are kept, which halves with each doubling of the size (``halvings`` times), so
    that sets of like size are sampled alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets, ends = shingle_sets(*utf8_view(batch.column("text")), width)
            spread = mixed(sets)
            halvings = np.ceil(np.log2(np.maximum(np.diff(ends), 1) / WHOLE)).clip(0).astype(np.int32)
            kept = []
            for low, high, times in zip(ends[:-1], ends[1:], halvings, strict=True):
                own = np.sort(spread[low:high])
                kept.append(_below(own, int(times)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(halvings), pa.array(kept, pa.binary())],
                names=["doc_id", "mark", "halvings", "sketch"],
            )

    return rows.mapInArrow(run, "doc_id long, mark long, halvings int, sketch binary")


def _shared(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Number of common values of every set of the one list with every set of the other."""
    every = first + second
    sizes = [len(x) for x in every]
    _, column, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), sizes)
    common = times > 1
    place = np.cumsum(common) - 1
    owner, column = owner[common[column]], place[column[common[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(first), len(second)), dtype=np.float32)
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        here = np.zeros((len(every), COLUMNS), dtype=np.float32)
        here[owner[a:b], column[a:b] - low] = 1
        out += here[: len(first)] @ here[len(first) :].T
    return out


def _alike(group: pd.DataFrame, percent: int) -> pd.DataFrame | None:
    """Pairs of a chunk pair that lie in different components and reach ``percent``.

    Where both sets are whole the similarity is that of the sets, and of the pairs found only those
    are returned that join components not yet joined here. Sampled sets count as reaching
    the mark up to ``DEVIATIONS`` standard errors below it, and all such pairs are returned.
    """
    doc, mark, size, own, halvings = (group[c].to_numpy() for c in ("doc_id", "mark", "n_shingles", "own", "halvings"))
    component = group.groupby(["component", "component_mark"]).ngroup().to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["sketch"]]
    low, high = group["low"].iloc[0], group["high"].iloc[0]
    first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
    if not len(first) or not len(second):
        return None
    pairs = []
    for times in np.unique(halvings[np.concatenate([first, second])]).tolist():
        left = first[np.isin(halvings[first], (times - 1, times))]
        right = second[np.isin(halvings[second], (times - 1, times))]
        if not len(left) or not len(right):
            continue
        cut = {x: _below(sets[x], times) for x in {*left.tolist(), *right.tolist()}}
        both = _shared([cut[x] for x in left.tolist()], [cut[x] for x in right.tolist()])
        counts = {x: len(v) for x, v in cut.items()}
        total = np.array([counts[x] for x in left.tolist()])[:, None] + [counts[x] for x in right.tolist()] - both
        slack = 0 if times == 0 else DEVIATIONS * np.sqrt(0.1875 / np.maximum(total, 1))
        good = both + 1e-3 >= (percent / 100 - slack) * total
        good &= component[left][:, None] != component[right][None, :]
        good &= np.maximum(halvings[left][:, None], halvings[right][None, :]) == times
        smaller, larger = np.minimum(size[left][:, None], size[right]), np.maximum(size[left][:, None], size[right])
        good &= 100 * smaller >= percent * larger
        if low == high:
            good &= left[:, None] < right[None, :]
        i, j = np.nonzero(good)
        pairs += zip(left[i].tolist(), right[j].tolist(), [times] * len(i), strict=True)
    joined = {c: c for c in set(component.tolist())}

    def root(c: int) -> int:
        while joined[c] != c:
            joined[c] = joined[joined[c]]
            c = joined[c]
        return c

    out = []
    for i, j, times in pairs:
        one, other = root(component[i]), root(component[j])
        if times or one != other:
            out.append((i, j) if doc[i] <= doc[j] else (j, i))
        if not times:
            joined[one] = other
    if not out:
        return None
    i, j = np.array(out).T
    return pd.DataFrame({"a": doc[i], "a_mark": mark[i], "b": doc[j], "b_mark": mark[j]})


def _within_buckets(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs to confirm across the components that one bucket still holds.

    ``rows`` has key, m (size of the bucket), doc_id, mark, n_shingles, component and its
    mark, halvings and sketch. Buckets are cut into chunks, and every two chunks meet once, so a task
    holds two chunks whatever the size of the bucket.
    """
    parts = F.ceil(F.col("m") / CHUNK).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("doc_id", "mark"), "parts").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(
        {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
    )
    met = met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            tags = held[["key", "low", "high"]].to_numpy()
            begins = np.concatenate([[0], np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1])
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                if (pairs := _alike(held.iloc[begin:end], percent)) is not None:
                    yield pairs
            held = held.iloc[begins[-1] :].reset_index(drop=True)
        if held is not None and len(held) and (pairs := _alike(held, percent)) is not None:
            yield pairs

    wanted = ["key", "low", "high", "own", "doc_id", "mark", "n_shingles", "component", "component_mark", "halvings", "sketch"]
    return (
        met.select(*wanted)
        .mapInPandas(run, "a long, a_mark long, b long, b_mark long")
        .dropDuplicates(["a", "a_mark", "b", "b_mark"])
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, width: int = WIDTH
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of ``percent`` or more.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over
    links), ``kept`` (the id is the component's), ``mark`` (a hash of the text) and
    ``chosen`` (of the component's rows with that id, those of its first text). Steps:

    1. one pass over the texts takes min-max signatures, band keys and set digests;
    2. documents with equal sets form a class; only its smallest id goes on;
    3. in every bucket of a band all documents are confirmed against the smallest one;
    4. where a bucket still holds several components, pairs across them are compared
       inside tasks, two chunks at a time: exactly up to ``WHOLE`` shingles, above that on
       a sample of the hashes; what links components is confirmed too;
    5. links and classes give the components.

    With 20 bands of three values a pair at 0.75 exactly is missed with probability
    0.00002. In step 4 pairs of larger sets are left out where the sample puts them more
    than four standard errors below the mark. Nothing else is estimated: a link always
    rests on the whole sets.

    Null or empty texts and texts without words have size 0 and link with nothing. Rows
    with one id and different texts are documents of their own, told apart by ``mark``,
    from the search to the components: one of them may link where the other does not, and
    of two that link only one is ``chosen``. Exact repeats of a row come out as often as
    they go in and are chosen alike. A null id is a document of its own text whose
    component is the smallest id of its class, or null. Other columns are ignored. An
    empty table gives no rows.
    """
    rows = store(features(docs, key, text, width), "minmax")
    digest = ["n_shingles", "d1", "d2"]
    classes = rows.filter("n_shingles > 0").groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.min_by("mark", "doc_id").alias("mark"))
    # stored, so that a class is known by one and the same of several texts under its smallest id
    classes = store(classes, "classes")
    heads = classes.select(F.col("rep").alias("doc_id"), "mark", *digest)
    heads = rows.join(heads, ["doc_id", "mark", *digest], "left_semi").dropDuplicates(["doc_id", "mark"])
    members = heads.select("doc_id", "mark", "n_shingles", F.explode("bands").alias("key"))
    buckets = (
        members.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("m"),
            F.min("doc_id").alias("centre"),
            F.min_by("mark", "doc_id").alias("centre_mark"),
            F.min_by("n_shingles", "doc_id").alias("centre_size"),
        )
        .filter("m > 1")
    )
    # stored, so that the join deals out both sides itself and can split a bucket with very many documents
    placed = store(members.join(store(buckets, "bucket-sizes"), "key"), "buckets")
    alike = 100 * F.least("n_shingles", "centre_size") >= percent * F.greatest("n_shingles", "centre_size")
    spokes = (
        placed.filter(alike & ((F.col("doc_id") != F.col("centre")) | (F.col("mark") != F.col("centre_mark"))))
        .select(
            F.col("centre").alias("a"),
            F.col("centre_mark").alias("a_mark"),
            F.col("doc_id").alias("b"),
            F.col("mark").alias("b_mark"),
        )
        .dropDuplicates(["a", "a_mark", "b", "b_mark"])
    )
    links = store(confirmed(store(spokes, "spokes"), docs, key, text, percent, width), "links")
    reached = _joined(links)

    named = placed.filter("m > 2").join(reached.withColumnRenamed("rep", "doc_id"), ["doc_id", "mark"], "left")
    named = named.withColumns(
        {"component": F.coalesce("component", "doc_id"), "component_mark": F.coalesce("component_mark", "mark")}
    )
    several = [F.min(c) != F.max(c) for c in ("component", "component_mark")]
    open_keys = named.groupBy("key").agg((several[0] | several[1]).alias("open")).filter("open").select("key")
    left = named.join(open_keys, "key", "left_semi")
    left = left.select("key", "m", "doc_id", "mark", "n_shingles", "component", "component_mark")
    left = store(left, "open-buckets")
    asked = left.select("doc_id", "mark").distinct().hint("shuffle_hash")
    seen = _texts(docs, key, text).join(asked, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    left = left.join(store(_sketches(seen, width), "sketches"), ["doc_id", "mark"])
    more = store(_within_buckets(left, percent), "inner-pairs")
    if not more.isEmpty():
        links = store(links.unionByName(confirmed(more, docs, key, text, percent, width)), "links")
        reached = _joined(links)

    grouped = classes.join(reached, ["rep", "mark"], "left").select(
        *digest,
        F.coalesce("component", "rep").alias("component"),
        F.coalesce("component_mark", "mark").alias("component_mark"),
    )
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    chosen = F.col("kept") & ((F.col("n_shingles") == 0) | F.col("mark").eqNullSafe(F.col("component_mark")))
    return (
        rows.select("doc_id", "mark", *digest)
        .join(grouped, digest, "left")
        .withColumn("component_id", component)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept", "mark", chosen.alias("chosen"))
    )
