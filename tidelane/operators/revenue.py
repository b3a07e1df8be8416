"""Revenue concentration, weekly demand and loss-making products.

Lines are summed per product before the product dimension is joined; the product key
determines the other product columns, so this is exact and no product is a hot join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.functions.dates import week_key, week_of_year
from tidelane.functions.numeric import money, percent, ratio, rnd
from tidelane.functions.running import ladder
from tidelane.params import DEFAULTS, Params
from tidelane.star import Star

PRODUCT_LABELS = ["product_id", "product_name", "category_name", "department_name", "product_price"]


def product_sums(star: Star) -> DataFrame:
    """Demand measures per product, exact decimals."""
    names = ("lines", "units", "sales", "profit", "discount", "loss_lines")
    return star.demand().groupBy("product_id").agg(*[F.sum(c).alias(c) for c in names])


def labelled(per_product: DataFrame, star: Star, *labels: str) -> DataFrame:
    """Sums per product with columns of the product. Both sides are dealt by product: the sums are so already, and the product table
    does not pass through the driver, as one whose files are just below Spark's broadcast threshold would, many times larger."""
    return per_product.join(star.products.select(*labels).hint("merge"), "product_id")


def average_discount_pct():
    return rnd(ratio(F.col("discount"), F.col("lines")) * 100.0, 2)


def category_revenue_ranked(star: Star) -> DataFrame:
    """``total_units_sold`` counts lines, as the view of that name always did."""
    additive = ("lines", "sales", "profit", "discount")
    categories = (
        labelled(product_sums(star), star, "product_id", "department_name", "category_name")
        .groupBy("department_name", "category_name")
        .agg(*[F.sum(c).alias(c) for c in additive])
        .select(
            "department_name",
            "category_name",
            F.col("lines").alias("total_units_sold"),
            money(F.col("sales")).alias("category_revenue"),
            money(F.col("profit")).alias("category_profit"),
            average_discount_pct().alias("avg_discount_pct"),
        )
    )
    ranked = ladder(categories, "category_revenue")
    return ranked.select(
        *categories.columns,
        rnd(percent(F.col("category_revenue"), F.col("grand_total")), 2).alias("revenue_share_pct"),
        rnd(percent(F.col("cumulative"), F.col("grand_total")), 2).alias("cumulative_revenue_pct"),
        F.col("dense_rank").alias("revenue_rank"),
    )


def product_revenue_pareto(star: Star, params: Params = DEFAULTS) -> DataFrame:
    """Running share per product; products of equal revenue share one running total. The
    class test is inclusive and made on exact sums."""
    totals = (
        labelled(product_sums(star), star, *PRODUCT_LABELS)
        .select(
            *PRODUCT_LABELS,
            F.col("lines").alias("order_lines_count"),
            F.col("units").alias("total_units_ordered"),
            money(F.col("sales")).alias("total_revenue"),
            money(F.col("profit")).alias("total_profit"),
        )
    )
    ranked = ladder(totals, "total_revenue")
    within_a = F.col("cumulative") <= F.col("grand_total") * F.lit(params.abc_a)
    within_b = F.col("cumulative") <= F.col("grand_total") * F.lit(params.abc_b)
    known = F.col("grand_total") != 0
    return ranked.select(
        *totals.columns,
        rnd(percent(F.col("total_revenue"), F.col("grand_total")), 4).alias("revenue_pct_of_total"),
        rnd(percent(F.col("cumulative"), F.col("grand_total")), 2).alias("cumulative_revenue_pct"),
        F.when(known & within_a, "A").when(known & within_b, "B").otherwise("C").alias("sql_abc_class"),
    )


def weekly_sums(star: Star) -> DataFrame:
    """Demand measures per product and week, keyed by numbers until after the shuffle."""
    day = F.col("order_day")
    return (
        star.demand()
        .groupBy("product_id", F.year(day).alias("_year"), week_of_year(day).alias("_week"))
        .agg(F.sum("lines").alias("lines"), F.sum("units").alias("units"), F.sum("sales").alias("sales"))
        .select("product_id", week_key(F.col("_year"), F.col("_week")).alias("order_year_week"), "lines", "units", "sales")
    )


def product_weekly_demand(star: Star) -> DataFrame:
    return (
        weekly_sums(star)
        .join(star.products.select("product_id", "product_name", "category_name"), "product_id")
        .select(
            "product_id",
            "product_name",
            "category_name",
            "order_year_week",
            F.col("units").alias("weekly_units"),
            money(F.col("sales")).alias("weekly_sales"),
            F.col("lines").alias("weekly_order_count"),
        )
    )


def loss_making_products(star: Star, params: Params = DEFAULTS) -> DataFrame:
    """Products with a loss in total, or with too many lines at a loss."""
    losing = (F.col("profit") < 0) | (F.col("loss_lines") * 100 > F.col("lines") * params.loss_line_pct)
    return (
        labelled(product_sums(star).where(losing), star, "product_id", "product_name", "category_name")
        .select(
            "product_id",
            "product_name",
            "category_name",
            F.col("lines").alias("total_orders"),
            money(F.col("sales")).alias("total_sales"),
            money(F.col("profit")).alias("net_profit"),
            average_discount_pct().alias("avg_discount_pct"),
            F.col("loss_lines").alias("negative_profit_order_count"),
            rnd(percent(F.col("loss_lines"), F.col("lines")), 2).alias("loss_order_pct"),
        )
        .orderBy("net_profit", "product_id")
    )
