"""Quality scores by positive-unlabelled learning with a non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, utf8_view
from tidemark.llm.names import spare
from tidemark.llm.style import WIDTH, style
from tidemark.session import store

FOLDS = 5
RIDGE = 0.3
SLACK = 0.05
PASSES = 25
STEPS = (1.0, 0.5, 0.25, 0.125, 0.03125)
LIMIT = 8.0
THRESHOLD = 0.3
SLICE = 1 << 20  # bytes of text whose style is measured at a time
POSITIVE, UNLABELLED, OTHER = 1, 0, -1


@dataclass
class Model:
    """A linear score of the style numbers; without weights every score is the prior."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def inputs(self, raw: np.ndarray) -> np.ndarray:
        scaled = np.clip((raw.astype(np.float64) - self.mean) * self.scale, -LIMIT, LIMIT)
        return np.hstack([scaled, np.ones((len(raw), 1))])

    def scores(self, raw: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(raw), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.inputs(raw) @ self.weights, -30, 30)))


def held_out(key: Column, folds: int = FOLDS) -> Column:
    """Whether the crc32 of the id as text is divisible by ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def styled(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the style numbers ``x`` of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            numbers = style(*utf8_view(batch.column("text")))
            ends = pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * WIDTH)
            lists = pa.ListArray.from_arrays(ends, pa.array(numbers.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<float>")


def trained_rows(rows: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS) -> DataFrame:
    """Add ``held_out`` and ``role``: trusted positive, unlabelled, or other.

    Labels count only outside the held-out fold; a document labelled there is other, and
    so is one labelled 0. Of several labels of one id the smallest counts.
    """
    given = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
        .filter("doc_id is not null and y is not null")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    marked = rows.join(given, "doc_id", "left").withColumn("held_out", held_out(F.col("doc_id"), folds))
    role = F.when(F.col("y").isNull(), UNLABELLED).when((F.col("y") == 1) & ~F.col("held_out"), POSITIVE)
    return marked.withColumn("role", role.otherwise(OTHER)).drop("y")


def class_prior(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS) -> float:
    """Share of positives, estimated from the labels outside the held-out fold; 0.5 without any."""
    seen = labels.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds))
    share = seen.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0]
    return 0.5 if share is None else float(np.clip(share, 0.02, 0.98))


def _summed(rows: DataFrame, measure) -> np.ndarray:
    """Sum over all rows of the vector that ``measure(x, role)`` gives for a batch.

    A task adds up its batches; the sums of tasks are added by Spark, place by place, so
    what the driver receives has the size of one vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                raw = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
                part = measure(raw, batch.column("role").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], names=["place", "value"])

    parts = rows.select("x", "role").mapInArrow(run, "place int, value double")
    sums = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").toPandas()
    return sums["value"].to_numpy()


def fit(rows: DataFrame, prior: float, ridge: float = RIDGE, passes: int = PASSES) -> Model:
    """Minimise the non-negative risk over all trusted positives and all unlabelled rows.

    With the logistic loss the unbiased risk, positives at the prior's weight plus
    unlabelled as negatives less the positives among them, is convex in the weights, so
    Newton steps are taken, each from one pass over the stored rows. A second pass tries
    several step lengths; only those count that keep the estimated risk of negatives from
    falling further below zero than ``SLACK``, which is where fitting noise begins, and
    the fit ends when none lowers the risk. Without positives or without unlabelled rows there is nothing to fit
    and the score is the prior. A number that never varies is left out.
    """

    def moments(raw: np.ndarray, role: np.ndarray) -> np.ndarray:
        raw = raw[role != OTHER].astype(np.float64)
        return np.concatenate(
            [[(role == POSITIVE).sum(), (role == UNLABELLED).sum()], raw.sum(axis=0), (raw**2).sum(axis=0)]
        )

    sums = _summed(rows, moments)
    if not len(sums) or not sums[0] or not sums[1]:
        return Model(prior)
    positives, unlabelled = sums[:2]
    mean = sums[2 : 2 + WIDTH] / (positives + unlabelled)
    deviation = np.sqrt(np.maximum(sums[2 + WIDTH :] / (positives + unlabelled) - mean**2, 0))
    scale = np.where(deviation > 1e-6, 1 / np.maximum(deviation, 1e-6), 0.0)
    model = Model(prior, mean, scale, np.zeros(WIDTH + 1))
    size = WIDTH + 1

    def slopes(raw: np.ndarray, role: np.ndarray) -> np.ndarray:
        x = model.inputs(raw)
        own, rest = x[role == POSITIVE], x[role == UNLABELLED]
        score = 1 / (1 + np.exp(-np.clip(rest @ model.weights, -30, 30)))
        bend = (rest * (score * (1 - score))[:, None]).T @ rest
        return np.concatenate([own.sum(axis=0), rest.T @ score, bend.reshape(-1)])

    def risks(raw: np.ndarray, role: np.ndarray) -> np.ndarray:
        x = model.inputs(raw)
        own, rest = x[role == POSITIVE] @ tries.T, x[role == UNLABELLED] @ tries.T
        return np.concatenate([np.logaddexp(0, -own).sum(0), np.logaddexp(0, own).sum(0), np.logaddexp(0, rest).sum(0)])

    for _ in range(passes):
        sums = _summed(rows, slopes)
        slope = -prior * sums[:size] / positives + sums[size : 2 * size] / unlabelled + ridge * model.weights
        bend = sums[2 * size :].reshape(size, size) / unlabelled + ridge * np.eye(size)
        step = np.linalg.solve(bend, slope)
        tries = np.vstack([model.weights, *[model.weights - length * step for length in STEPS]])
        plus, minus, other = np.split(_summed(rows, risks), 3)
        negative = other / unlabelled - prior * minus / positives
        risk = prior * plus / positives + np.maximum(negative, -SLACK) + ridge / 2 * (tries**2).sum(axis=1)
        allowed = (negative[1:] >= -SLACK) & (risk[1:] < risk[0] - 1e-6)
        if not allowed.any():
            break
        best = 1 + int(np.argmin(np.where(allowed, risk[1:], np.inf)))
        model.weights = tries[best]
    return model


def scored_rows(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` from stored style numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            score = model.scores(raw)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.select("doc_id", "held_out", "x").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Score all documents: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    Learned from the trusted positives outside the held-out fold, the documents without a
    label, and the class prior that the labels outside the fold suggest; see ``fit``. The
    inputs of a score are numbers about the whole text alone. Null and empty texts are
    scored like any other. Repeated rows and ids come out as often as they go in; a null
    id is never labelled. Other columns are ignored; an empty table gives no rows.
    """
    rows = store(trained_rows(styled(docs, key, text), labels, label), "styled")
    return scored_rows(rows, fit(rows, class_prior(docs, labels, label)))


def keep_good(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose score reaches ``threshold``.

    Texts are read twice, to fit and to score, so that none is shuffled or stored again.
    """
    rows = store(trained_rows(styled(docs, "doc_id", text), labels, label), "styled")
    model = fit(rows, class_prior(docs, labels, label))
    names, (whole,) = docs.columns, spare(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, whole, SLICE):
            good = model.scores(style(*utf8_view(batch.column(whole)))) >= threshold
            yield batch.select(names).filter(pa.array(good))

    return docs.withColumn(whole, F.coalesce(F.col(text), F.lit(""))).mapInArrow(run, docs.schema)
