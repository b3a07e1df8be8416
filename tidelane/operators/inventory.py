"""Safety stock, reorder points and inventory health per product."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelane.functions.numeric import deviation, money, ratio, rnd, rounded, square, variance, worth
from tidelane.operators.revenue import PRODUCT_LABELS, labelled
from tidelane.params import DEFAULTS, OPTIMAL, OVERSTOCKED, REORDER, Params
from tidelane.star import Star


def route_lead_time(star: Star, params: Params = DEFAULTS) -> DataFrame:
    """Lead time by category, shipping mode and market. Summed per product first, then joined
    to the category, then summed again."""
    additive = ("lines", "days", "squared_days")
    sums = (
        star.lead_times()
        .join(star.products.select("product_id", "category_name"), "product_id")
        .groupBy("category_name", "shipping_mode", "market")
        .agg(*[F.sum(c).alias(c) for c in additive])
    )
    n, total, squares = (F.col(c) for c in additive)
    return sums.select(
        "category_name",
        "shipping_mode",
        "market",
        n.alias("route_order_count"),
        ratio(total, n).alias("avg_lead_time_days"),
        variance(n, total, squares).alias("lead_time_variance"),
        F.greatest(F.lit(params.lead_sigma_floor), deviation(n, total, squares, sample=False)).alias(
            "std_lead_time_days"
        ),
    )


def _daily_units(star: Star) -> DataFrame:
    if star.daily is not None:
        return star.daily.select("product_id", "order_day", F.col("units").alias("daily_units"))
    return star.demand().groupBy("product_id", "order_day").agg(F.sum("units").alias("daily_units"))


def daily_demand(star: Star) -> DataFrame:
    """Units per product and day, only days with sales."""
    return (
        _daily_units(star)
        .join(star.products.select(*PRODUCT_LABELS), "product_id")
        .select(*PRODUCT_LABELS, "order_day", "daily_units")
    )


def primary_route(star: Star) -> DataFrame:
    """Route with most lines per product; mode and market break ties."""
    busiest = W.partitionBy("product_id").orderBy(F.col("lines").desc(), "shipping_mode", "market")
    return (
        star.lead_times()
        .withColumn("_rank", F.row_number().over(busiest))
        .where("_rank = 1")
        .select(
            "product_id",
            F.col("shipping_mode").alias("primary_shipping_mode"),
            F.col("market").alias("primary_market"),
        )
    )


def daily_demand_stats(star: Star) -> DataFrame:
    """Total, active days, mean and sample deviation over the days with sales. The product
    columns are joined after the days have been summed up."""
    units = F.col("daily_units")
    sums = _daily_units(star).groupBy("product_id").agg(
        F.sum(units).alias("total_units"), F.count(units).alias("active_days"), F.sum(square(units)).alias("_squares")
    )
    n, total = F.col("active_days"), F.col("total_units")
    return labelled(sums, star, *PRODUCT_LABELS).select(
        *PRODUCT_LABELS,
        "total_units",
        "active_days",
        ratio(total, n).alias("mean_daily_demand"),
        deviation(n, total, F.col("_squares"), sample=True).alias("std_daily_demand"),
    )


def product_lead_time(
    stats: DataFrame, primary: DataFrame, routes: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Lead time of each product's primary route, with fallbacks where the route is unknown."""
    by_route = routes.select(
        "category_name",
        F.col("shipping_mode").alias("primary_shipping_mode"),
        F.col("market").alias("primary_market"),
        "avg_lead_time_days",
        "std_lead_time_days",
    )
    return (
        stats.join(primary, "product_id", "left")
        .join(by_route, ["category_name", "primary_shipping_mode", "primary_market"], "left")
        .select(
            *stats.columns,
            "primary_shipping_mode",
            "primary_market",
            F.coalesce("avg_lead_time_days", F.lit(params.lead_mean_fallback)).alias("avg_lead_time_days"),
            F.coalesce("std_lead_time_days", F.lit(params.lead_sigma_fallback)).alias("std_lead_time_days"),
        )
    )


def safety_stock(df: DataFrame, z: float = DEFAULTS.service_z) -> DataFrame:
    """z * sqrt(mean lead time * demand variance + mean demand squared * lead time variance),
    rounded up."""
    lead, lead_sigma = F.col("avg_lead_time_days"), F.col("std_lead_time_days")
    demand, demand_sigma = F.col("mean_daily_demand"), F.col("std_daily_demand")
    inside = lead * (demand_sigma * demand_sigma) + (demand * demand) * (lead_sigma * lead_sigma)
    units = F.ceil(F.lit(z) * F.sqrt(F.greatest(F.lit(0.0), inside)))
    return df.withColumn("safety_stock_units", units.cast("long"))


def reorder_point(df: DataFrame) -> DataFrame:
    """Lead-time demand, rounded up on its own, plus safety stock."""
    expected = F.ceil(F.col("mean_daily_demand") * F.col("avg_lead_time_days")).cast("long")
    return df.withColumn("lead_time_demand_units", expected).withColumn(
        "reorder_point_units", F.col("lead_time_demand_units") + F.col("safety_stock_units")
    )


def _stock_multiplier(product_id: Column, params: Params) -> Column:
    """A number in [low, low + span) that depends on the product alone."""
    hashed = F.pmod(F.pmod(product_id, F.lit(2147483648)) * F.lit(2654435761), F.lit(4294967296))
    return F.lit(params.stock_low) + F.lit(params.stock_span) * hashed.cast("double") / F.lit(4294967296.0)


def on_hand_stock(df: DataFrame, inventory: DataFrame | None = None, params: Params = DEFAULTS) -> DataFrame:
    """Stock from an inventory snapshot (product_id, current_stock_units; rows of one product, say one per
    warehouse, add up) where it has the product, else a stand-in around the reorder point, at least one
    unit. ``stock_source`` tells which."""
    scaled = F.col("reorder_point_units").cast("double") * _stock_multiplier(F.col("product_id"), params)
    stand_in = F.greatest(F.lit(1).cast("long"), rounded(scaled, 0).cast("long"))
    if inventory is None:
        return df.withColumn("current_stock_units", stand_in).withColumn("stock_source", F.lit("stand-in"))
    units = F.sum(F.col("current_stock_units").cast("long"))
    counted = inventory.groupBy("product_id").agg(units.alias("_counted"))
    return (
        df.join(counted, "product_id", "left")
        .withColumn("current_stock_units", F.coalesce("_counted", stand_in))
        .withColumn("stock_source", F.when(F.col("_counted").isNull(), "stand-in").otherwise("counted"))
        .select(*df.columns, "current_stock_units", "stock_source")
    )


def overstocked(params: Params = DEFAULTS) -> Column:
    return F.col("current_stock_units").cast("double") > F.lit(params.overstock_multiple) * F.col("reorder_point_units")


def stock_status(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.withColumn(
        "stock_status",
        F.when(F.col("current_stock_units") < F.col("reorder_point_units"), REORDER)
        .when(overstocked(params), OVERSTOCKED)
        .otherwise(OPTIMAL),
    )


def inventory_valuation(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    value = worth(F.col("current_stock_units"), F.col("product_price"))
    rate = F.lit(Decimal(str(params.holding_cost_rate)))
    return df.withColumn("inventory_valuation", value).withColumn(
        "annual_holding_cost", money(F.col("inventory_valuation") * rate)
    )


def excess_capital(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Units above a multiple of the reorder point, for every product whatever its status."""
    units = F.greatest(
        F.lit(0).cast("long"), F.col("current_stock_units") - F.col("reorder_point_units") * params.excess_multiple
    )
    return df.withColumn("excess_stock_units", units).withColumn(
        "excess_capital_tied_up", worth(F.col("excess_stock_units"), F.col("product_price"))
    )


def stockout_risk(df: DataFrame) -> DataFrame:
    units = F.greatest(F.lit(0).cast("long"), F.col("reorder_point_units") - F.col("current_stock_units"))
    return df.withColumn("stockout_shortage_units", units).withColumn(
        "stockout_revenue_at_risk", worth(F.col("stockout_shortage_units"), F.col("product_price"))
    )


def reorder_levels(star: Star, params: Params = DEFAULTS) -> DataFrame:
    """Demand, lead time, safety stock and reorder point per product, unrounded."""
    timed = product_lead_time(
        daily_demand_stats(star), primary_route(star), route_lead_time(star, params), params
    )
    return reorder_point(safety_stock(timed, params.service_z))


def inventory_master(
    star: Star,
    classified: DataFrame | None = None,
    inventory: DataFrame | None = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The full inventory table; class columns are added when a classification is given."""
    stocked = stock_status(on_hand_stock(reorder_levels(star, params), inventory, params), params)
    valued = stockout_risk(excess_capital(inventory_valuation(stocked, params), params))
    if classified is not None:
        classes = ["abc_class", "xyz_class", "abc_xyz_segment", "operational_priority", "risk_level"]
        valued = valued.join(classified.select("product_id", *classes).hint("merge"), "product_id", "left")
    shown = ("mean_daily_demand", "std_daily_demand", "avg_lead_time_days", "std_lead_time_days")
    return valued.withColumns({c: rnd(F.col(c), 2) for c in shown})


def stock_status_counts(master: DataFrame) -> DataFrame:
    return master.groupBy("stock_status").agg(F.count("*").alias("sku_count"))
