"""Raw order-line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.schema import MALFORMED, MISSING_MARKS, SOURCE_POSITION

# How the files are written.
LAYOUT = {"encoding": "ISO-8859-1", "quote": '"', "escape": '"'}
#: Lines that a quoted field may make of one record. A quote that is never closed would swallow the rest of its file; beyond
#: this number the lines are malformed records of their own.
MOST_LINES = 10_000


def read_raw_orders(
    spark: SparkSession, path: str | list[str], position: bool = False, multiline: bool = False
) -> DataFrame:
    """Read CSV order lines: header row, ISO-8859-1, every column as text.

    Names come from the header, so column order does not matter; a file whose header differs
    from the first one fails instead of shifting columns. With ``position`` a struct column
    says where a line stood (file, offset of its block, row), which lets a later step keep the
    first copy of a line. ``multiline`` allows line breaks inside quotes (see ``records``); without it
    such a record is two malformed ones. A record with more or fewer
    fields than the header has its text in ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).options(**LAYOUT).option("enforceSchema", False)
    header = reader.csv(path).columns  # reads the first line
    fields = T.StructType([T.StructField(name, T.StringType()) for name in [*header, MALFORMED]])
    if multiline:
        raw = _parsed(records(spark, path), fields)
    else:
        # a pruned read would not see all fields of a record, and so not that some are missing
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        raw = reader.schema(fields).csv(path).select("*", _place().alias(SOURCE_POSITION))
    marks = ", ".join(f"'{mark}'" for mark in MISSING_MARKS)
    columns = [
        F.expr(f"CASE WHEN `{name}` NOT IN ({marks}) THEN `{name}` END").alias(name) for name in header
    ]
    columns.append(F.col(MALFORMED))
    if position:
        columns.append(F.col(SOURCE_POSITION))
    return raw.select(*columns)


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text with their place and whether they have an odd number of quotes."""
    text = spark.read.text(path).select(F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"), _place().alias("at"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    return text.select("line", "at", "at.file", "at.block", (quotes % 2).cast("long").alias("odd"))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files as ``text``, line breaks inside quotes kept (as \\n), with the place ``at`` of their first line;
    ``is_header`` marks the first of each file.

    A line ends inside quotes if the number of lines with an odd number of quotes up to it is odd. That number is a running sum: the
    blocks in which Spark reads a file are summed first, a block's lines then go on from the blocks before, so a
    large file is as many tasks as it has blocks. Only lines of records that span several are brought together.
    """
    lines = _lines(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("sum"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("file", "block").orderBy("at.row")
    counted = lines.withColumn("upto", F.sum("odd").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
    before = F.col("offset") + F.col("upto") - F.col("odd")
    known = counted.join(offsets, ["file", "block"]).withColumn("before", before)
    known = known.where((F.col("before") % 2 == 1) | (F.trim("line") != ""))
    first = F.row_number().over(inside) == 1
    known = known.withColumn("is_header", (F.col("block") == 0) & first)
    whole = (F.col("odd") == 0) & (F.col("before") % 2 == 0)
    single = known.where(whole).select("at", F.col("line").alias("text"), "is_header")
    parts = known.where(~whole).withColumn("pair", F.floor(F.col("before") / 2))
    sizes = parts.groupBy("file", "pair").agg(F.count("*").alias("n"))
    sized = parts.join(sizes, ["file", "pair"])
    broken = sized.where(F.col("n") > MOST_LINES).select("at", F.col("line").alias("text"), "is_header")
    ordered = F.array_sort(F.collect_list(F.struct("at", "line", "is_header")))
    joined = (
        sized.where(F.col("n") <= MOST_LINES)
        .groupBy("file", "pair")
        .agg(ordered.alias("lines"))
        .select(F.col("lines")[0]["at"].alias("at"), F.array_join("lines.line", "\n").alias("text"), F.col("lines")[0]["is_header"].alias("is_header"))
    )
    return single.unionByName(joined).unionByName(broken)


def _parsed(found: DataFrame, fields: T.StructType) -> DataFrame:
    names = [f.name for f in fields.fields if f.name != MALFORMED]
    options = LAYOUT | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in fields.fields)
    parsed = found.select("at", "is_header", F.from_csv("text", kinds, options).alias("row"))
    same = F.lit(True)
    for name in names:
        same = same & F.col("row").getField(name).eqNullSafe(F.lit(name))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("at.file"))).cast("boolean")
    rows = parsed.where(F.when(~F.col("is_header"), True).when(same, False).otherwise(other))
    return rows.select("row.*", F.col("at").alias(SOURCE_POSITION))
