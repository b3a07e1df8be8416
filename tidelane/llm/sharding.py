"""Sharding by a keyed permutation of row numbers.

Rows are numbered globally in order of id, text digest and size, without gathering them. A Feistel network
permutes the numbers of the smallest power of four that holds them all, and walks on along its cycle while it lands
outside 0 .. n - 1, which makes it a permutation of exactly the row numbers. Place ``p`` goes to shard
``p mod shards`` at slot ``p div shards``, so shards differ by one row at most, slots have no gaps, and both can be
computed from a row's number alone; ``place_of`` inverts the permutation.

Null ids sort first and null texts count as empty. Rows equal in all columns are interchangeable.
An empty table gives an empty table. Extra columns pass through, save those named like an output column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.functions.running import running_sums
from tidelane.llm.frames import mapped, packed, quoted, unpacked

#: Multipliers of the round function; below 2**31, so products of half words stay below 2**62.
MULTIPLIERS = (0x5851F42D, 0x2C1B3C6D)
LOW = (1 << 31) - 1


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. n - 1; n at most 2**62."""

    n: int
    keys: tuple[int, ...] = (0x1F3D5B79, 0x2468ACE1, 0x13579BDF, 0x0FEDCBA9)

    @property
    def half(self) -> int:
        return max(1, ((max(self.n, 2) - 1).bit_length() + 1) // 2)

    def _round(self, right: np.ndarray, key: int) -> np.ndarray:
        f = (right * MULTIPLIERS[0] + key) & LOW
        f = ((f ^ (f >> 15)) * MULTIPLIERS[1]) & LOW
        return (f ^ (f >> 13)) & ((1 << self.half) - 1)

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, step, x: np.ndarray) -> np.ndarray:
        out = step(np.asarray(x, np.int64))
        outside = np.flatnonzero(out >= self.n)
        while len(outside):
            out[outside] = step(out[outside])
            outside = outside[out[outside] >= self.n]
        return out

    def place(self, number: np.ndarray) -> np.ndarray:
        return self._walk(self._once, number)

    def place_of(self, place: np.ndarray) -> np.ndarray:
        """The row numbers at the given places."""
        return self._walk(self._back, place)


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_digest(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def number_rows(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``row_number`` from 0 and ``n_rows``. Rows are dealt by ranges of ``order``, counted per range, and
    each range starts where the ones before it end."""
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = running_sums(rows.withColumn("_one", F.lit(1).cast("long")), {"_upto": "_one"}, order, slices)
    return counted.select(
        *rows.columns, (F.col("_upto") - 1).alias("row_number"), F.col("_upto_total").alias("n_rows")
    )


def feistel_shards(
    docs: DataFrame, shards: int = 16, keys: tuple[int, ...] = Permutation.keys, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns but the text, with ``size``, ``text_crc32``, ``row_number``, ``n_rows``, ``place``,
    ``shard`` and ``slot``."""
    new = ("size", "text_crc32", "row_number", "n_rows", "place", "shard", "slot")
    whole = F.col(quoted(text))
    rows = packed(docs, (*new, text), id=F.col(quoted(id)), size=text_size(whole), text_crc32=text_digest(whole))
    numbered = number_rows(rows, [F.col("id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()])

    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            if not batch.num_rows:
                return [pa.array([], pa.int64())]
            n = batch.column("n_rows")[0].as_py()  # the same in all rows
            return [pa.array(Permutation(n, keys).place(batch.column("row_number").to_numpy()))]

        return compute

    placed = mapped(numbered, [T.StructField("place", T.LongType())], start)
    return placed.select(
        *unpacked(placed, docs, (*new, text)),
        *new[:5],
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place DIV {shards}").alias("slot"),
    )
