"""Running totals and dense ranks over a whole table, without a one-task window.

The rows are cut in slices of the sort order. A window per slice gives the running total inside the slice; the
totals of the earlier slices, one row per slice, are broadcast and added. ``running_sums`` takes any order: it range-
partitions the rows and keeps the partition number, materialised, so it cannot change between two uses. ``ladder``
sorts by one number: its slices are a function of the number alone, so nothing is materialised and no job runs
before the result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.lineage import settle


#: Slices of ``running_sums``, and of ``ladder`` for each doubling of the value (so 51,200 at most for 38 digits).
SLICES, SLICES_PER_DOUBLING = 64, 256


def running_sums(
    df: DataFrame, measures: dict[str, str], order: list[Column], slices: int = SLICES
) -> DataFrame:
    """Add, per measure, ``<name>`` (total of this row and all before it in ``order``) and
    ``<name>_total`` (total of all rows). ``order`` must be total, ties are not merged.
    ``measures`` maps a new name to the column that is summed."""
    sliced = settle(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    return _climb(sliced, measures, order).select(
        *df.columns, *measures, *[f"{name}_total" for name in measures]
    )


def _climb(sliced: DataFrame, measures: dict[str, str], order: list[Column]) -> DataFrame:
    """Running and whole totals of rows whose ``_slice`` follows their order."""
    before = W.orderBy("_slice")
    everything = W.partitionBy()
    offsets = sliced.groupBy("_slice").agg(
        *[F.sum(column).alias(f"_sum_{name}") for name, column in measures.items()]
    ).select(
        "_slice",
        *[(F.sum(f"_sum_{name}").over(before) - F.col(f"_sum_{name}")).alias(f"_before_{name}") for name in measures],
        *[F.sum(f"_sum_{name}").over(everything).alias(f"{name}_total") for name in measures],
    )
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = sliced.select(
        "*", *[F.sum(column).over(inside).alias(f"_local_{name}") for name, column in measures.items()]
    )
    # at most one row per slice, hence the broadcast
    joined = local.join(F.broadcast(offsets), "_slice")
    return joined.select(
        *sliced.columns,
        *[(F.col(f"_local_{name}") + F.col(f"_before_{name}")).alias(name) for name in measures],
        *[F.col(f"{name}_total") for name in measures],
    )


def _slice_of(value: Column) -> Column:
    """A whole number that does not fall when the value rises."""
    x = value.cast("double")
    return (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * SLICES_PER_DOUBLING)).cast("long")


def ladder(df: DataFrame, value: str, descending: bool = True) -> DataFrame:
    """Add to each row of ``df`` the columns ``cumulative`` (total of ``value`` over all rows
    that sort before it or tie with it), ``grand_total`` and ``dense_rank``; null without a value.

    Works on the distinct values, so a value that many rows share is one row here.
    """
    side = -1 if descending else 1
    key = F.col(value).desc() if descending else F.col(value).asc()
    steps = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.sum(value).alias("_step"), F.lit(1).cast("long").alias("_one"))
        .withColumn("_slice", _slice_of(F.col(value)) * side)
    )
    climbed = _climb(steps, {"cumulative": "_step", "dense_rank": "_one"}, [key])
    rungs = climbed.select(value, "cumulative", F.col("cumulative_total").alias("grand_total"), "dense_rank")
    return df.join(rungs, value, "left").select(*df.columns, "cumulative", "grand_total", "dense_rank")
