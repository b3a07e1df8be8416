"""Connected components by star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.functions.lineage import settle

#: Parts that the neighbours of a node are dealt in. Where Spark broadcasts the minima, by their size before they are copied,
#: it sends this many times that size at most.
SALTS = 16


def _towards_least(edges: DataFrame) -> DataFrame:
    """Point the neighbours of each node, and itself, at the least of them. ``edges`` has ``u`` and ``v``. The least is
    found by partial minima and joined back to edges dealt by node and salt, so a node with many neighbours is no single group."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"])


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def near_roots(edges: DataFrame, hops: int = 3) -> DataFrame:
    """``node`` and ``root``: the least node within some hops along the edges ``a``-``b``. Nodes with one root are connected; connected
    ones may have several. A few joins, whatever the components."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    both = settle(both.unionByName(both.select("u", F.col("u").alias("v"))).distinct())
    roots = both.groupBy("u").agg(F.min("v").alias("root"))
    for _ in range(hops - 1):
        roots = both.join(roots.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("root").alias("root"))
    return settle(roots.withColumnRenamed("u", "node"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes that have an edge ``a``-``b``.

    Near roots stand for most of a component, so rounds are needed for what is left between them only."""
    near = near_roots(edges)
    at = lambda end: near.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    across = edges.select("a", "b").join(at("a"), "a").join(at("b"), "b").filter("root_a <> root_b")
    joined = _rounds(across.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct())
    least = joined.select(F.col("node").alias("root"), F.col("root").alias("whole"))
    return near.join(least, "root", "left").select("node", F.coalesce("whole", "root").alias("root"))


def _rounds(edges: DataFrame) -> DataFrame:
    """``components`` by rounds. Alternates a step that points larger neighbours at a node's least neighbour with one that does so for
    the smaller ones; the number of rounds grows with the logarithm of the component's size.
    """
    now = settle(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _towards_least(large)
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = near.filter("u <> m").select("u", F.col("m").alias("v"))
        now = settle(small.unionByName(own).distinct())
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
