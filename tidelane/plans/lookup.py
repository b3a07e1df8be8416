"""Single products from the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelane.operators import report
from tidelane.sources.loads import Tables
from tidelane.sources.store import read_rows


def lookup_skus(spark: SparkSession, root: str | Tables, requested: DataFrame) -> DataFrame:
    """``report.sku_lookup`` on the stored inventory table, reading the row groups that may hold a requested ``product_id``."""
    return report.sku_lookup(requested, read_rows(spark, root, "inventory_safety_stock_rop", "product_id", requested))
