"""The star schema and the result tables as Parquet folders under one root.

Wherever a root is taken, a folder, a published load or a draft does as well (see ``loads``): a root with loads answers with the
last one, and what is written to it is published as one more load when the whole call has succeeded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.functions.dates import month_key
from tidelane.sources.loads import Tables, tables_of, writing
from tidelane.star import ROLLUPS, Star, all_rollups, separate_rollups

MONTH = "order_year_month"
FACT, PRODUCTS, CUSTOMERS = "fact_orders", "dim_products", "dim_customers"
REJECTS, SUMS, KEYS = "rejected_lines", "rollups", "line_keys"


def by_month(fact: DataFrame) -> DataFrame:
    """The fact with its month, laid out for a write by month. The rebalance hint lets AQE
    split a month that holds many lines and join small pieces, so files have even size."""
    return fact.withColumn(MONTH, _month()).hint("rebalance", F.col(MONTH))


def _month() -> Column:
    return month_key(F.to_date("order_date"))


def write_star(star: Star, root: str | Tables, months: bool = True) -> None:
    """Replace the three tables; the fact is partitioned by order month. Without ``months`` its rows stay in the tasks that
    made them, in as many files, which spares the shuffle by month; the month is a column of it then."""
    with writing(star.fact.sparkSession, root) as tables:
        if months:
            tables.write(by_month(star.fact), FACT, MONTH)
        else:
            tables.write(star.fact.withColumn(MONTH, _month()), FACT)
        tables.write(star.products, PRODUCTS)
        tables.write(star.customers, CUSTOMERS)


def write_rollups(spark: SparkSession, root: str | Tables, apart: bool = False) -> None:
    """Replace the rollups, computed from one scan of the stored fact and split on the write; or ``apart``, from a scan for each, which
    shuffles far less where products have few lines a day."""
    with writing(spark, root) as tables:
        fact = read_star(spark, tables).fact
        tables.write(separate_rollups(fact) if apart else all_rollups(fact).hint("rebalance", F.col("rollup")), SUMS, "rollup")


def read_rollup(spark: SparkSession, root: str | Tables, name: str) -> DataFrame:
    keys, measures = ROLLUPS[name]
    stored = spark.read.parquet(f"{tables_of(spark, root).path(SUMS)}/rollup={name}")
    return stored.select(*keys, *[F.col(source).alias(m) for m, source in measures.items()])


def attach_rollups(spark: SparkSession, star: Star, root: str | Tables) -> Star:
    return star.with_rollups(*[read_rollup(spark, root, name) for name in ROLLUPS])


def _key_name(path: str) -> str:
    """Name of the catalog table over a folder of bucketed keys. Sessions share the folder; each names it for itself."""
    return f"default.tidelane_keys_{hashlib.md5(path.encode()).hexdigest()}"


def store_keys(tables: Tables, counted: DataFrame, buckets: int) -> None:
    """Write counted line keys (``order_item_id``, ``copies``) as sorted buckets."""
    tables.write_buckets(counted, KEYS, buckets, "order_item_id", _key_name)


def count_keys(fact: DataFrame, rejected: DataFrame) -> DataFrame:
    """Lines of the fact per key, and keys of rejected lines with none. Summed before the shuffle, so a key with very many
    copies is one row per task there."""
    kept = fact.select("order_item_id", F.lit(1).alias("n"))
    refused = rejected.where("order_item_id IS NOT NULL").select("order_item_id", F.lit(0).alias("n"))
    return kept.unionByName(refused).groupBy("order_item_id").agg(F.sum("n").alias("copies"))


def write_keys(spark: SparkSession, root: str | Tables, buckets: int | None = None) -> None:
    """Store the number of lines per key in sorted buckets (as many as shuffle partitions unless given). Audits of the key
    and appended lines read them without a shuffle."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with writing(spark, root) as tables:
        fact = read_star(spark, tables).fact
        rejected = tables.read(REJECTS) if tables.has(REJECTS) else fact.limit(0)
        store_keys(tables, count_keys(fact, rejected).repartition(buckets, "order_item_id"), buckets)


def read_keys(spark: SparkSession, root: str | Tables) -> DataFrame | None:
    """The stored line keys as a bucketed table; None where there are none."""
    tables = tables_of(spark, root)
    if not tables.has(KEYS):
        return None
    path, buckets = tables.bucketed_path(KEYS)
    name = _key_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (order_item_id BIGINT, copies BIGINT) USING parquet "
        f"CLUSTERED BY (order_item_id) SORTED BY (order_item_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def read_star(
    spark: SparkSession,
    root: str | Tables,
    rollups: bool = False,
    since: str | None = None,
    until: str | None = None,
    load: int | None = None,
) -> Star:
    """The stored star. ``since`` and ``until`` (YYYY-MM, inclusive) prune the months that are
    read; the rollups cover all months, so they go with the whole fact only. ``load`` picks an earlier load."""
    if rollups and (since or until):
        raise ValueError("the rollups hold no single months; read the star without them")
    tables = tables_of(spark, root, load)
    fact = tables.read(FACT)
    if since:
        fact = fact.where(F.col(MONTH) >= since)
    if until:
        fact = fact.where(F.col(MONTH) <= until)
    star = Star(fact.drop(MONTH), tables.read(PRODUCTS), tables.read(CUSTOMERS))
    if not rollups:
        return star
    return replace(attach_rollups(spark, star, tables), keys=read_keys(spark, tables))


#: Settings under which Spark filters stored keys by a Bloom filter of new ones, whatever the sizes it guesses.
FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0B",
}


@contextmanager
def runtime_filters(spark: SparkSession) -> Iterator[None]:
    """The session's settings with ``FILTERS``, as they were after it."""
    before = {name: spark.conf.get(name, None) for name in FILTERS}
    try:
        for name, value in FILTERS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def known_keys(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Keys of ``lines`` with their number of lines (``asked``) and the ``copies`` that the stored keys have, null if they have not the key.
    The range of the new keys skips stored row groups, a Bloom filter of them skips rows, and the stored side is not shuffled."""
    asked = lines.where("order_item_id IS NOT NULL").groupBy("order_item_id").agg(F.count("*").alias("asked"))
    low, high = lines.agg(F.min("order_item_id"), F.max("order_item_id")).first()
    within = F.col("order_item_id").between(low, high)
    found = keys.where(within).join(lines.where(within).select("order_item_id"), "order_item_id", "left_semi")
    return asked.join(found, "order_item_id", "left")


def write_result(df: DataFrame, root: str | Tables, name: str) -> None:
    """Replace one derived table."""
    with writing(df.sparkSession, root) as tables:
        tables.write(df, name)


def write_sorted(df: DataFrame, root: str | Tables, name: str, key: str, block: str = "8m") -> None:
    """Replace a table that is looked up by a key: sorted by it, in small row groups with Bloom filters, so that a
    reader of some keys skips the others."""
    kept = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(_bytes(block))}
    with writing(df.sparkSession, root) as tables:
        tables.write(df.repartitionByRange(key).sortWithinPartitions(key), name, **kept)


def _bytes(size: str) -> int:
    return int(size[:-1]) << {"k": 10, "m": 20, "g": 30}[size[-1]]


def read_rows(
    spark: SparkSession, root: str | Tables, name: str, key: str, wanted: DataFrame, most: int = 1000
) -> DataFrame:
    """Rows of a stored table that may have one of the wanted keys. Up to ``most`` different keys go into the scan, which skips row groups by
    their ranges and Bloom filters; more of them leave the table as it is. A join with ``wanted`` follows either way."""
    table = tables_of(spark, root).read(name)
    keys = [row[0] for row in wanted.select(key).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()]
    if len(keys) > most:
        return table
    any_of = F.lit(False)
    for first in range(0, len(keys), 10):  # Spark hands lists of up to ten values to Parquet as they are
        any_of = any_of | F.col(key).isin(keys[first : first + 10])
    return table.where(any_of)


def read_table(
    spark: SparkSession,
    name: str,
    columns: list[str] | None = None,
    root: str | Tables | None = None,
    load: int | None = None,
) -> DataFrame:
    """A table stored under ``root`` or, without it, a registered view; only the wanted columns."""
    if root is None:
        df = spark.table(name)
    else:
        df = tables_of(spark, root, load).read(name)
    return df.select(*columns) if columns else df
