"""On-time delivery by route, month, segment and market.

"On time" compares days only; a line counts as on time when the real days do not exceed the
scheduled days. The measures come from the rollup that a load stores, or from one scan of the fact; sums
combine before the shuffle either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.functions.dates import month_key
from tidelane.functions.numeric import money, percent, ratio, rnd, rounded, variance
from tidelane.functions.running import ladder
from tidelane.star import Star


def otif_by_route(star: Star) -> DataFrame:
    m = star.order_measures("market", "shipping_mode")
    return m.select(
        "market",
        "shipping_mode",
        F.col("lines").alias("total_orders"),
        F.col("on_time").alias("on_time_orders"),
        F.col("late").alias("late_orders"),
        rnd(percent(F.col("on_time"), F.col("lines")), 2).alias("otif_rate_pct"),
        rnd(percent(F.col("late"), F.col("lines")), 2).alias("late_rate_pct"),
        rnd(ratio(F.col("scheduled_days"), F.col("lines")), 2).alias("avg_scheduled_days"),
        rnd(ratio(F.col("real_days"), F.col("lines")), 2).alias("avg_real_days"),
        rnd(ratio(F.col("delay"), F.col("lines")), 2).alias("avg_delay_days"),
        money(F.col("sales")).alias("total_route_sales"),
        money(F.col("late_sales")).alias("late_revenue_at_risk"),
    )


def monthly_delivery_trends(star: Star) -> DataFrame:
    m = star.order_measures("month")
    return m.select(
        month_key(F.col("month")).alias("order_year_month"),
        F.col("lines").alias("total_orders"),
        money(F.col("sales")).alias("total_sales"),
        money(F.col("profit")).alias("total_profit"),
        F.col("on_time").alias("on_time_orders"),
        F.col("late").alias("late_orders"),
        rnd(percent(F.col("on_time"), F.col("lines")), 2).alias("monthly_otif_pct"),
        rnd(ratio(F.col("delay"), F.col("lines")), 2).alias("avg_delay_days"),
        money(F.col("late_sales")).alias("monthly_late_revenue"),
    ).orderBy("order_year_month")


def segment_fulfillment(star: Star) -> DataFrame:
    """Per customer first, so the join sees one row per customer however many lines one has."""
    per_customer = star.customer_measures()
    additive = ("lines", "sales", "profit", "on_time", "late", "delay")
    per_segment = (
        per_customer.join(star.customers.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("customer_segment")
        .agg(*[F.sum(c).alias(c) for c in additive])
        .select(
            "customer_segment",
            F.col("lines").alias("total_orders"),
            money(F.col("sales")).alias("total_revenue"),
            money(F.col("profit")).alias("total_profit"),
            F.col("on_time").alias("on_time_count"),
            F.col("late").alias("late_count"),
            rnd(percent(F.col("on_time"), F.col("lines")), 2).alias("otif_rate_pct"),
            rnd(ratio(F.col("delay"), F.col("lines")), 2).alias("avg_delay_days"),
        )
    )
    ranked = ladder(per_segment, "otif_rate_pct", descending=False)
    return ranked.drop("cumulative", "grand_total").withColumnRenamed("dense_rank", "worst_fulfillment_rank")


def late_cost_impact(star: Star) -> DataFrame:
    """On-time against late lines per market, from sums by kind. Markets that have only one kind are left out."""
    both = star.order_measures("market").select(
        "market",
        F.col("on_time").alias("on_time_volume"),
        (F.col("lines") - F.col("on_time")).alias("late_volume"),
        "on_time_sales",
        "on_time_profit",
        F.col("other_sales").alias("late_sales"),
        F.col("other_profit").alias("late_profit"),
    ).where("on_time_volume > 0 and late_volume > 0")

    def average(name):
        return rounded(ratio(F.col(f"{name}_profit"), F.col(f"{name}_volume")), 2)

    def margin(name):
        return rounded(percent(F.col(f"{name}_profit"), F.col(f"{name}_sales")), 2)

    return both.select(
        "market",
        "on_time_volume",
        "late_volume",
        money(F.col("on_time_sales")).alias("on_time_sales"),
        money(F.col("late_sales")).alias("late_sales_at_risk"),
        average("on_time").alias("on_time_avg_profit"),
        average("late").alias("late_avg_profit"),
        F.round(average("on_time") - average("late"), 2).alias("profit_erosion_per_order"),
        margin("on_time").alias("on_time_margin_pct"),
        margin("late").alias("late_margin_pct"),
        F.round(margin("on_time") - margin("late"), 2).alias("margin_compression_pct"),
    )


def lead_time_distribution(star: Star) -> DataFrame:
    """Mean, range and population variance of the real days, without a second pass for the mean."""
    n, total, squares = F.col("lines"), F.col("real_days"), F.col("squared_days")
    return star.order_measures("market", "shipping_mode").select(
        "market",
        "shipping_mode",
        n.alias("sample_size"),
        rnd(ratio(total, n), 2).alias("avg_lead_time_days"),
        F.col("min_days").alias("min_lead_time_days"),
        F.col("max_days").alias("max_lead_time_days"),
        rnd(variance(n, total, squares), 3).alias("lead_time_variance"),
    )


def overall_kpis(star: Star) -> DataFrame:
    m = star.order_measures()
    return m.select(
        F.col("lines").alias("total_orders"),
        F.col("sales").alias("total_sales"),
        F.col("profit").alias("total_profit"),
        F.col("on_time").alias("on_time_orders"),
        F.col("late").alias("late_orders"),
        rnd(percent(F.col("on_time"), F.col("lines")), 2).alias("otif_pct"),
        money(F.col("late_sales")).alias("late_revenue_risk"),
        rnd(ratio(F.col("delay"), F.col("lines")), 2).alias("avg_delay_days"),
    )
