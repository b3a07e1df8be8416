"""ABC (revenue) and XYZ (demand variability) classes and the nine-box strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.numeric import deviation, money, percent, ratio, rnd, square
from tidelane.functions.running import ladder
from tidelane.operators.revenue import PRODUCT_LABELS, average_discount_pct, labelled, product_sums, weekly_sums
from tidelane.params import DEFAULTS, SEGMENT_STRATEGY, Params
from tidelane.star import Star


def product_revenue(star: Star) -> DataFrame:
    return (
        labelled(product_sums(star), star, *PRODUCT_LABELS)
        .select(
            *PRODUCT_LABELS,
            F.col("lines").alias("total_orders"),
            F.col("units").alias("total_units_sold"),
            money(F.col("sales")).alias("total_revenue"),
            money(F.col("profit")).alias("total_profit"),
            average_discount_pct().alias("avg_discount_pct"),
        )
    )


def weekly_quantity(star: Star) -> DataFrame:
    return weekly_sums(star).select(
        "product_id",
        "order_year_week",
        F.col("units").alias("weekly_quantity"),
        money(F.col("sales")).alias("weekly_sales"),
    )


def abc_classify(revenue: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Class by the share that is reached *before* a product, in order of falling revenue
    (product_id breaks ties), so the product that crosses a bound still gets the higher class.
    With no revenue at all every product is C with shares of 0. No job runs before a row is asked for."""
    own = F.col("total_revenue")
    # products of equal revenue share a rung of the ladder; inside it they go by number. Those without revenue, who may
    # be many, need no place in theirs
    ties = W.partitionBy("total_revenue", F.when(own == 0, F.col("product_id")))
    upto = F.sum(own).over(ties.orderBy("product_id").rowsBetween(W.unboundedPreceding, W.currentRow))
    summed = ladder(revenue, "total_revenue").select(
        *revenue.columns,
        F.col("grand_total").alias("_total"),
        (F.col("cumulative") - F.sum(own).over(ties) + upto).alias("_reached"),
    )
    total = F.col("_total")
    before = F.col("_reached") - own
    some = total != 0
    return summed.select(
        *revenue.columns,
        F.coalesce(percent(own, total), F.lit(0.0)).alias("revenue_share_pct"),
        F.coalesce(percent(F.col("_reached"), total), F.lit(0.0)).alias("cumulative_revenue_pct"),
        F.when(some & (before < total * F.lit(params.abc_a)), "A")
        .when(some & (before < total * F.lit(params.abc_b)), "B")
        .otherwise("C")
        .alias("abc_class"),
    )


def xyz_classify(weekly: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Class by the coefficient of variation over the weeks that have sales."""
    q = F.col("weekly_quantity")
    sums = weekly.groupBy("product_id").agg(
        F.count(q).alias("observations"), F.sum(q).alias("_units"), F.sum(square(q)).alias("_squares")
    )
    n, units = F.col("observations"), F.col("_units")
    stats = sums.select(
        "product_id",
        "observations",
        ratio(units, n).alias("mean_demand"),
        deviation(n, units, F.col("_squares"), sample=True).alias("std_demand"),
    )
    scarce = F.col("observations") < params.min_observations
    cv = F.when(scarce | (F.col("mean_demand") <= 0), params.cv_unknown).otherwise(
        F.try_divide(F.col("std_demand"), F.col("mean_demand"))
    )
    return stats.withColumn("demand_cv", cv).withColumn(
        "xyz_class",
        F.when(scarce, "Z")
        .when(F.col("demand_cv") <= params.xyz_x, "X")
        .when(F.col("demand_cv") <= params.xyz_y, "Y")
        .otherwise("Z"),
    )


def abc_xyz(abc: DataFrame, xyz: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Both classes per product; products without weekly history are Z."""
    absent = {
        "observations": F.lit(0).cast("long"),
        "mean_demand": F.lit(0.0),
        "std_demand": F.lit(0.0),
        "demand_cv": F.lit(params.cv_unknown),
        "xyz_class": F.lit("Z"),
    }
    digits = {"mean_demand": 2, "std_demand": 2, "demand_cv": 3}
    both = abc.join(xyz, "product_id", "left").withColumns(
        {c: F.coalesce(F.col(c), default) for c, default in absent.items()}
    )
    return both.select(
        *[c for c in abc.columns if c not in ("revenue_share_pct", "cumulative_revenue_pct", "abc_class")],
        rnd(F.col("revenue_share_pct"), 2).alias("revenue_share_pct"),
        rnd(F.col("cumulative_revenue_pct"), 2).alias("cumulative_revenue_pct"),
        "abc_class",
        "observations",
        *[rnd(F.col(c), n).alias(c) for c, n in digits.items()],
        "xyz_class",
        F.concat("abc_class", "xyz_class").alias("abc_xyz_segment"),
    )


def strategy_table(spark: SparkSession) -> DataFrame:
    """Nine rows, whatever the data."""
    return spark.createDataFrame(
        SEGMENT_STRATEGY,
        "abc_xyz_segment string, operational_priority string, risk_level string, "
        "recommended_strategy string, inventory_policy string, directive string",
    )


def segment_strategy(classified: DataFrame) -> DataFrame:
    """Attach priority, risk, strategy and policy; an unknown segment gets 'N/A'."""
    attached = ["operational_priority", "risk_level", "recommended_strategy", "inventory_policy"]
    lookup = F.broadcast(strategy_table(classified.sparkSession).drop("directive"))
    return classified.join(lookup, "abc_xyz_segment", "left").select(
        *classified.columns, *[F.coalesce(F.col(c), F.lit("N/A")).alias(c) for c in attached]
    )


def classify_products(star: Star, params: Params = DEFAULTS) -> DataFrame:
    """The table of classified products with their strategy."""
    abc = abc_classify(product_revenue(star), params)
    xyz = xyz_classify(weekly_quantity(star), params)
    return segment_strategy(abc_xyz(abc, xyz, params))


def segment_distribution(classified: DataFrame) -> DataFrame:
    return classified.groupBy("abc_xyz_segment").agg(F.count("*").alias("sku_count")).orderBy("abc_xyz_segment")


def nine_box_grid(classified: DataFrame) -> DataFrame:
    """All nine cells, empty ones with zeros."""
    cells = classified.groupBy("abc_xyz_segment").agg(
        F.count("*").alias("sku_count"), F.sum("total_revenue").alias("total_revenue")
    )
    frame = strategy_table(classified.sparkSession).select(
        "abc_xyz_segment",
        F.substring("abc_xyz_segment", 1, 1).alias("abc_class"),
        F.substring("abc_xyz_segment", 2, 1).alias("xyz_class"),
        "directive",
    )
    return (
        frame.join(cells, "abc_xyz_segment", "left")
        .select(
            "abc_class",
            "xyz_class",
            F.coalesce("sku_count", F.lit(0).cast("long")).alias("sku_count"),
            F.coalesce(F.col("total_revenue"), F.lit(0)).alias("total_revenue"),
            "directive",
        )
        .withColumn("cell_text", F.concat(F.col("sku_count").cast("string"), F.lit(" SKUs | "), F.col("directive")))
        .orderBy("abc_class", "xyz_class")
    )


def az_sku_count(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("abc_xyz_segment") == "AZ").agg(F.count("*").alias("az_sku_count"))
