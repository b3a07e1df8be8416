"""Order lines to dimensions and fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.schema import CUSTOMER_COLUMNS, FACT_COLUMNS, PRODUCT_COLUMNS, SOURCE_POSITION
from tidelane.star import Star


def _first_per_key(lines: DataFrame, columns: list[str], order_by: list[Column] | None) -> DataFrame:
    """First line per key. One row per key and task survives before the shuffle, so a key
    with very many lines is no hot spot."""
    order = order_by or [F.col(SOURCE_POSITION), F.col("order_item_id")]
    present = [c for c in columns if c in lines.columns]
    w = W.partitionBy(columns[0]).orderBy(*order)
    return lines.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").select(*present)


def build_dim_products(lines: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    return _first_per_key(lines, PRODUCT_COLUMNS, order_by)


def build_dim_customers(lines: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    return _first_per_key(lines, CUSTOMER_COLUMNS, order_by)


def build_fact_orders(lines: DataFrame) -> DataFrame:
    return lines.select(*[c for c in FACT_COLUMNS if c in lines.columns])


def build_star(lines: DataFrame) -> Star:
    return Star(build_fact_orders(lines), build_dim_products(lines), build_dim_customers(lines))
