"""Quality grades: ordinal cumulative-link regression over hashed text.

The chance that a text reaches grade k is ``sigmoid(w.x - theta_k)``: all grades share the weights ``w`` of hashed
tokens and token pairs, and the thresholds ``theta_1 < theta_2 < ...`` are strictly ordered. ``x`` is the share of each
feature among the text's features. Expected grade and tail probabilities follow from the same few numbers.

Fitting takes a bounded sample of rated rows (``Settings.sample``, the rows with the smallest hash
of their id, whatever the input's size); grading covers all rows and whole texts. Null and empty
texts have no features, so only the thresholds speak. Repeated ids are graded row by row;
several ratings of one id count as their maximum; null ratings and ratings of unknown ids are not used.
Without any ratings every text is accepted. Extra columns pass through, save those named like an
output column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.llm import hashed_text as H
from tidelane.llm.frames import labelled_sample, mapped


@dataclass(frozen=True)
class Settings:
    #: grades are 0 to ``grades - 1``
    grades: int = 3
    bits: int = 18
    #: most rated rows that the fit takes
    sample: int = 8_000
    epochs: int = 6
    batch: int = 32
    rate: float = 1.0
    l2: float = 1e-5
    #: least distance of thresholds
    gap: float = 0.01
    #: scale of the feature shares, so that usual scores are of the order of one
    scale: float = 20.0
    #: lowest grade that is accepted, and the least chance to reach it
    accepted: int = 1
    least: float = 0.5


@dataclass(frozen=True)
class Model:
    bits: int
    scale: float
    weights: np.ndarray
    thresholds: np.ndarray


def features(column: pa.Array, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature indexes with row offsets: lower-case tokens, runs of symbols among them, and pairs.
    All pairs of a token with itself are one feature, as what is repeated does not matter."""
    words, rows = H.token_hashes(column, H.SPLIT, lower=True)
    pairs, pair_rows = H.grams(words, rows, (1,))
    pairs[H.equal_neighbours(words, rows)] = 0
    shift = np.uint64(64 - bits)
    return [((h >> shift).astype(np.uint32), at) for h, at in ((words, rows), (pairs, pair_rows))]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def apart(thresholds: np.ndarray, gap: float) -> np.ndarray:
    """The thresholds, raised where they are not ``gap`` above the one before."""
    steps = gap * np.arange(len(thresholds))
    return np.maximum.accumulate(thresholds - steps) + steps


def fit_rows(examples: list[tuple[np.ndarray, np.ndarray, float]], settings: Settings) -> Model:
    """Mini-batch gradient steps with a rate per coordinate over (indexes, shares, grade), on the negative log likelihood of the
    cumulative-link model: a grade's chance is the difference of the chances to reach it and to reach the next one. With
    ``r_k`` the chance to reach grade ``k`` (1 for 0, and 0 beyond the last), its derivative by the score is
    ``r_g + r_(g+1) - 1`` for a row of grade ``g``. Thresholds stay apart by ``settings.gap`` at least."""
    levels = np.arange(1, settings.grades)
    weights, seen = np.zeros(1 << settings.bits), np.full(1 << settings.bits, 1e-8)
    if not examples:
        return Model(settings.bits, settings.scale, weights, np.full(len(levels), -35.0))
    grades = np.array([g for *_, g in examples])
    reached = np.clip([(grades >= k).mean() for k in levels], 1e-3, 1 - 1e-3)
    thresholds, seen_t = apart(-np.log(reached / (1 - reached)), settings.gap), np.full(len(levels), 1e-8)
    for _ in range(settings.epochs):
        for first in range(0, len(examples), settings.batch):
            part = examples[first : first + settings.batch]
            index = np.concatenate([i for i, *_ in part])
            share = np.concatenate([s for _, s, _ in part]) * settings.scale
            row = np.repeat(np.arange(len(part)), [len(i) for i, *_ in part])
            score = np.bincount(row, weights[index] * share, len(part))
            grade = np.clip(np.array([g for *_, g in part]).astype(int), 0, len(levels))
            reach = np.ones((len(part), len(levels) + 2))
            reach[:, 1:-1], reach[:, -1] = sigmoid(score[:, None] - thresholds), 0
            at = np.arange(len(part))
            here, beyond = reach[at, grade], reach[at, grade + 1]
            error = here + beyond - 1
            chance = np.maximum(here - beyond, 1e-12)
            by_threshold = np.zeros((len(part), len(levels) + 2))
            by_threshold[at, grade] = here * (1 - here) / chance
            by_threshold[at, grade + 1] -= beyond * (1 - beyond) / chance
            used, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, error[row] * share, len(used)) / len(part) + settings.l2 * weights[used]
            seen[used] += step * step
            weights[used] -= settings.rate * step / np.sqrt(seen[used])
            step = by_threshold.mean(0)[1:-1]
            seen_t += step * step
            thresholds = apart(thresholds - 0.1 * settings.rate * step / np.sqrt(seen_t), settings.gap)
    return Model(settings.bits, settings.scale, weights.astype(np.float32), thresholds)


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """``w.x`` per row."""
    out = np.empty(len(column))
    for first, last in H.batches(column):
        total, count = np.zeros(last - first), np.zeros(last - first)
        for index, rows in features(column.slice(first, last - first), model.bits):
            total += H.row_sums(model.weights[index], rows)
            count += np.diff(rows)
        out[first:last] = model.scale * total / np.maximum(count, 1)
    return out


def shares(column: pa.Array, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct feature indexes, share of each) per row."""
    out = []
    for first, last in H.batches(column):
        parts = features(column.slice(first, last - first), settings.bits)
        for i in range(last - first):
            found = np.concatenate([index[rows[i] : rows[i + 1]] for index, rows in parts])
            index, count = np.unique(found, return_counts=True)
            out.append((index, (count / max(len(found), 1)).astype(np.float32)))
    return out


def fit(sample: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "label") -> Model:
    """Fit on a bounded sample: columns ``_order`` (fixes the order of the rows), text and grade.
    One task runs the passes, as each step needs the weights of the one before."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in parts:
            found = shares(batch.column(text), settings)
            examples += [(*x, g) for x, g in zip(found, batch.column(label).to_pylist(), strict=True)]
        model = fit_rows(examples, settings)
        yield pa.RecordBatch.from_pydict(
            {"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.tolist()]},
            pa.schema([("weights", pa.binary()), ("thresholds", pa.list_(pa.float64()))]),
        )

    one = sample.select("_order", F.col(text), F.col(label).cast("double").alias(label))
    ordered = one.repartition(1).sortWithinPartitions("_order")
    row = ordered.mapInArrow(work, "weights binary, thresholds array<double>").first()
    if row is None:  # Spark runs no task where it knows that there are no rows
        return fit_rows([], settings)
    weights = np.frombuffer(bytes(row["weights"]), "<f4")
    return Model(settings.bits, settings.scale, weights, np.array(row["thresholds"]))


def quality_grades(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Add ``expected_grade``, ``tail`` (chance of the accepted grade or better) and ``accepted``."""

    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            reach = sigmoid(score_column(batch.column(text), model)[:, None] - model.thresholds)
            tail = reach[:, settings.accepted - 1]
            return [pa.array(reach.sum(1)), pa.array(tail), pa.array(tail >= settings.least)]

        return compute

    new = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType())]
    return mapped(docs, [*new, T.StructField("accepted", T.BooleanType())], start, text=text)


def grade(quality: Column, toxic: Column) -> Column:
    """Rating in three grades: 0 unfit, 1 fit but toxic, 2 fit. A missing mark of toxicity counts as none."""
    return F.when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) == 1, 1).when(quality.isNotNull(), 2)


def classify_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on the rated rows and grade all documents. All columns of ``docs`` are kept."""
    rated = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("label"))
    return quality_grades(docs, fit(labelled_sample(docs, rated, settings.sample), settings), settings)
