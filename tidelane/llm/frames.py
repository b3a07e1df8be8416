"""Small pieces that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.llm.hashed_text import batches


#: Rows of an Arrow batch at most. A batch is held whole on both sides, and rows hold texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``BATCH_ROWS`` if they are more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def mapped(
    df: DataFrame,
    new: list[T.StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    drop: Iterable[str] = (),
    text: str | None = None,
) -> DataFrame:
    """Add columns batch by batch. ``start()`` runs once per task and returns the function that
    gives the new columns of a batch. Columns in ``drop``, and those named like a new one, are
    not handed on. With ``text``, batches are cut in pieces of some megabytes of that column, so a task's
    memory depends on the longest text and not on the number of rows in a batch."""
    small_batches(df.sparkSession)
    out = {name.lower() for name in drop} | {field.name.lower() for field in new}
    fields = [f for f in df.schema.fields if f.name.lower() not in out]
    kept, names = [f.name for f in fields], [f.name for f in [*fields, *new]]

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for whole in parts:
            compute = compute or start()
            for first, last in batches(whole.column(text)) if text else [(0, whole.num_rows)]:
                batch = whole.slice(first, last - first)
                columns = [batch.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, *compute(batch)], names=names)

    return df.mapInArrow(work, T.StructType([*fields, *new]))


def packed(docs: DataFrame, without: Iterable[str] = (), **named: Column) -> DataFrame:
    """The caller's columns, but for those in ``without``, as one struct ``row``, and the named ones that an operator works on. Whatever
    helper columns it adds, none of the caller's can have their names."""
    gone = {name.lower() for name in without}
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in gone]
    pad = F.lit(0).alias("_" * (1 + max(map(len, docs.columns))))  # a struct needs a field
    return docs.select(F.struct(*kept, pad).alias("row"), *[c.alias(name) for name, c in named.items()])


def unpacked(out: DataFrame, docs: DataFrame, without: Iterable[str] = ()) -> list[Column]:
    """The columns that ``packed`` put away, as they came."""
    gone = {name.lower() for name in without}
    return [out["row"].getField(c).alias(c) for c in docs.columns if c.lower() not in gone]


def quoted(name: str) -> str:
    """A column's name as an expression, dots and all."""
    return f"`{name.replace('`', '``')}`"


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, text: str = "text") -> DataFrame:
    """Text and label of the ``most`` labelled documents with the smallest hash of their id.

    ``labels`` has ``doc_id`` and ``label``; several labels of an id count as their maximum. Of documents that
    share an id, the one with the smallest text counts, so the sample is bounded and the same in every run. The ids are broadcast: there are ``most`` at most.
    """
    one = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = one.withColumn("_order", F.xxhash64("doc_id")).orderBy("_order", "doc_id").limit(most)
    found = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("_order", "doc_id", "label").agg(F.min("text").alias("text"))


def runs(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal keys of a task whose rows are sorted by them."""
    held: pa.Table | None = None
    for batch in parts:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        columns = [held.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if len(held) else []
        first = 0
        for at in change:
            yield held.slice(first, at - first)
            first = at
        held = held.slice(first)
    if held is not None and len(held):
        yield held
