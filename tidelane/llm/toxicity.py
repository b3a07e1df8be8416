"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-case runs of letters and digits; a document's features are the distinct hashed words, word pairs
and pairs around skipped words. Per-coordinate rates and the L1 term leave most weights
at zero, so the model is a short list of (index, weight) that every task gets.

Fitting takes a bounded sample of labelled rows (``Settings.sample``, the rows with the smallest hash
of their id, whatever the input's size); scoring covers all rows and whole texts. Null and
empty texts have no features and get the score of the intercept. Repeated ids are scored row by row;
several labels of one id count as their maximum; null labels and labels of unknown ids are not used.
Without any labels the score is the prior, 0.1. Extra columns pass through, save those named like
an output column.
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
    bits: int = 18
    skips: tuple[int, ...] = (2, 3)
    #: most labelled rows that the fit takes
    sample: int = 12_000
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    #: strength of L1 for 12,000 rows; for fewer it falls with the root of their number, to ``least_l1``
    l1: float = 10.0
    least_l1: float = 2.0
    l2: float = 1.0
    threshold: float = 0.3
    #: value of a pair, where a word's is 1: single words are learned first
    pair: float = 0.5


@dataclass(frozen=True)
class Model:
    """The non-zero weights by feature index, and the intercept."""

    bits: int
    skips: tuple[int, ...]
    pair: float
    intercept: float
    index: np.ndarray
    weight: np.ndarray


def features(column: pa.Array, bits: int, skips: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature indexes with row offsets: words, pairs, and pairs with ``skip - 1`` words between.
    Words have the lower half of the indexes, pairs the upper one."""
    words, rows = H.token_hashes(column, H.SPLIT, lower=True)
    parts = [(words, rows), *(H.grams(words, rows, (gap,)) for gap in (1, *skips))]
    half = np.uint32(1 << (bits - 1))
    return [((h >> np.uint64(65 - bits)).astype(np.uint32) + half * (k > 0), at) for k, (h, at) in enumerate(parts)]


def values(index: np.ndarray, bits: int, pair: float) -> np.ndarray:
    return np.where(index >> (bits - 1), pair, 1.0)


def fit_rows(examples: list[tuple[np.ndarray, float]], settings: Settings) -> Model:
    """Run FTRL-proximal over (distinct feature indexes, label) in the given order."""
    size = 1 << settings.bits
    z, n = np.zeros(size), np.zeros(size)
    positive = sum(y for _, y in examples)
    b0 = float(np.log((positive + 1) / (len(examples) - positive + 9)))
    bias, bias_n = b0, 0.0
    a, b, l2 = settings.alpha, settings.beta, settings.l2
    l1 = min(settings.l1, max(settings.least_l1, settings.l1 * (len(examples) / 12_000) ** 0.5))
    for _ in range(settings.epochs):
        for index, y in examples:
            zi, root = z[index], np.sqrt(n[index])
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((b + root) / a + l2))
            x = values(index, settings.bits, settings.pair)
            error = 1 / (1 + np.exp(-np.clip(bias + (w * x).sum(), -35, 35))) - y
            g = error * x
            n[index] += g * g
            z[index] = zi + g - (np.sqrt(n[index]) - root) / a * w
            bias_n += error * error
            bias -= a * error / (b + bias_n**0.5)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((b + np.sqrt(n)) / a + l2))
    index = np.flatnonzero(w)
    return Model(settings.bits, settings.skips, settings.pair, float(bias), index.astype(np.uint32), w[index])


def score_column(column: pa.Array, model: Model, table: np.ndarray) -> np.ndarray:
    """Probability per row; ``table`` has the model's weight at each index."""
    out = np.empty(len(column))
    for first, last in H.batches(column):
        part = column.slice(first, last - first)
        keys = []
        for index, rows in features(part, model.bits, model.skips):
            hit = np.flatnonzero(table[index])
            row = np.searchsorted(rows, hit, "right") - 1
            keys.append((row.astype(np.int64) << model.bits) | index[hit])
        found = np.unique(np.concatenate(keys))
        index = found & ((1 << model.bits) - 1)
        weights = table[index] * values(index, model.bits, model.pair)
        out[first:last] = model.intercept + np.bincount(found >> model.bits, weights, last - first)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def distinct(column: pa.Array, settings: Settings) -> list[np.ndarray]:
    """The distinct feature indexes of each row."""
    out = []
    for first, last in H.batches(column):
        parts = features(column.slice(first, last - first), settings.bits, settings.skips)
        out += [
            np.unique(np.concatenate([index[rows[i] : rows[i + 1]] for index, rows in parts]))
            for i in range(last - first)
        ]
    return out


def fit(sample: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "label") -> Model:
    """Fit on a bounded sample: columns ``_order`` (fixes the order of the rows), text and label.
    One task runs the passes, as each step needs the weights of the one before."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in parts:
            examples += zip(distinct(batch.column(text), settings), batch.column(label).to_pylist(), strict=True)
        model = fit_rows(examples, settings)
        yield pa.RecordBatch.from_pydict(
            {"intercept": [model.intercept], "index": [model.index.tobytes()], "weight": [model.weight.tobytes()]},
            pa.schema([("intercept", pa.float64()), ("index", pa.binary()), ("weight", pa.binary())]),
        )

    one = sample.select("_order", F.col(text), F.col(label).cast("double").alias(label))
    ordered = one.repartition(1).sortWithinPartitions("_order")
    row = ordered.mapInArrow(work, "intercept double, index binary, weight binary").first()
    if row is None:  # Spark runs no task where it knows that there are no rows
        return fit_rows([], settings)
    return Model(
        settings.bits,
        settings.skips,
        settings.pair,
        row["intercept"],
        np.frombuffer(bytes(row["index"]), np.uint32),
        np.frombuffer(bytes(row["weight"]), np.float64),
    )


def toxicity_scores(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add the probability that a text is toxic."""

    def start():
        table = np.zeros(1 << model.bits)
        table[model.index] = model.weight
        return lambda batch: [pa.array(score_column(batch.column(text), model, table), pa.float64())]

    return mapped(docs, [T.StructField(to, T.DoubleType())], start, drop=[text], text=text)


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may use. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on the labelled rows that are not held out and score all documents.

    Returns the documents without their text, with ``held_out``, ``score`` and ``predicted``.
    """
    usable = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    model = fit(labelled_sample(docs, usable, settings.sample), settings)
    ids = docs.withColumn("held_out", held_out(F.col("doc_id")))
    scored = toxicity_scores(ids, model)
    return scored.withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))
