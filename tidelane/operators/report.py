"""The tables behind the report sheets: scorecards, heatmaps, rosters and lookups.

Tables with a total row read their input twice, so pass a stored or settled table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.functions.numeric import money, percent, ratio, rnd, rounded
from tidelane.operators.inventory import overstocked
from tidelane.params import (
    DEFAULTS,
    DEFICIT_HEAD,
    DEFICIT_TAIL,
    MONTH_TOTAL,
    OPTIMAL_TEXT,
    OVERSTOCK_TEXT,
    ROSTER_TOTAL,
    ROUTE_TOTAL,
    Params,
)


def kpi_cards(kpis: DataFrame, az_skus: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Six figures, each with a second figure and a colour band."""
    none = F.lit(None).cast("double")
    otif_band = F.when(F.col("otif_pct") >= params.otif_green, "green").otherwise("amber")
    late_share = rnd(percent(F.col("late_revenue_risk"), F.col("total_sales")), 1)

    def card(kpi: str, value: Column, sub: Column, band) -> Column:
        return F.struct(
            F.lit(kpi).alias("kpi"),
            value.cast("double").alias("value"),
            sub.cast("double").alias("sub_value"),
            (F.lit(band) if isinstance(band, str) else band).alias("band"),
        )

    from_orders = kpis.select(
        F.inline(
            F.array(
                card("TOTAL ORDER VOLUME", F.col("total_orders"), none, "blue"),
                card("GLOBAL NET SALES", money(F.col("total_sales")), money(F.col("total_profit")), "blue"),
                card("OVERALL OTIF RATE", F.col("otif_pct"), F.lit(params.otif_target), otif_band),
                card("LATE REVENUE AT RISK", F.col("late_revenue_risk"), late_share, "red"),
                card("AVG FULFILLMENT VARIANCE", F.col("avg_delay_days"), none, "amber"),
            )
        )
    )
    from_skus = az_skus.select(F.inline(F.array(card("CRITICAL 'AZ' SKUs", F.col("az_sku_count"), none, "red"))))
    return from_orders.unionByName(from_skus)


def _mean_of_means(c: str) -> Column:
    """Unweighted mean of already rounded figures, summed as decimals."""
    return ratio(F.sum(rounded(F.col(c), 2)), F.count(c))


def route_scorecard(routes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Routes by late revenue and a closing total row (``is_total``), whose day columns are
    plain means of the routes' means."""
    detail = routes.select(
        F.lit(0).alias("is_total"),
        "market",
        "shipping_mode",
        "total_orders",
        "on_time_orders",
        "late_orders",
        (F.col("otif_rate_pct") / 100.0).alias("otif_rate"),
        "avg_scheduled_days",
        "avg_real_days",
        "avg_delay_days",
        "total_route_sales",
        "late_revenue_at_risk",
        (F.col("otif_rate_pct") / 100.0 < params.route_otif_alarm / 100.0).alias("low_otif"),
    )
    total = routes.agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "on_time_orders", "late_orders")],
        *[_mean_of_means(c).alias(c) for c in ("avg_scheduled_days", "avg_real_days", "avg_delay_days")],
        *[F.sum(c).alias(c) for c in ("total_route_sales", "late_revenue_at_risk")],
    ).select(
        F.lit(1).alias("is_total"),
        F.lit(ROUTE_TOTAL).alias("market"),
        F.lit(None).cast("string").alias("shipping_mode"),
        "*",
        ratio(F.col("on_time_orders"), F.col("total_orders")).alias("otif_rate"),
        F.lit(False).alias("low_otif"),
    )
    return detail.unionByName(total).orderBy(
        "is_total", F.col("late_revenue_at_risk").desc(), "market", "shipping_mode"
    )


def profit_erosion_report(impact: DataFrame) -> DataFrame:
    shares = ("on_time_margin", "late_margin", "margin_compression")
    return impact.select(
        *[c for c in impact.columns if not c.endswith("_pct")],
        *[(F.col(f"{c}_pct").cast("double") / 100.0).alias(c) for c in shares],
    ).orderBy(F.col("profit_erosion_per_order").desc(), "market")


def monthly_report(months: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    margin = F.when(F.col("total_sales") > 0, ratio(F.col("total_profit"), F.col("total_sales"))).otherwise(0.0)
    detail = months.select(
        F.lit(0).alias("is_total"),
        "order_year_month",
        "total_orders",
        "total_sales",
        "total_profit",
        "on_time_orders",
        "late_orders",
        (F.col("monthly_otif_pct") / 100.0).alias("otif_rate"),
        "avg_delay_days",
        "monthly_late_revenue",
        margin.alias("profit_margin"),
        (F.col("monthly_otif_pct") / 100.0 < params.month_otif_alarm / 100.0).alias("low_otif"),
    )
    counts = ("total_orders", "total_sales", "total_profit", "on_time_orders", "late_orders", "monthly_late_revenue")
    total = months.agg(
        *[F.sum(c).alias(c) for c in counts], _mean_of_means("avg_delay_days").alias("avg_delay_days")
    ).select(
        F.lit(1).alias("is_total"),
        F.lit(MONTH_TOTAL).alias("order_year_month"),
        "*",
        ratio(F.col("on_time_orders"), F.col("total_orders")).alias("otif_rate"),
        ratio(F.col("total_profit"), F.col("total_sales")).alias("profit_margin"),
        F.lit(False).alias("low_otif"),
    )
    return detail.unionByName(total).orderBy("is_total", "order_year_month")


#: Columns of a heatmap at most.
MOST_MODES = 200


def shipping_modes(routes: DataFrame) -> list[str]:
    """The modes of a stored route table, for the heatmaps' columns. A few names; more than ``MOST_MODES`` are an
    error, as no table should get that many columns."""
    found = [r[0] for r in routes.select("shipping_mode").distinct().limit(MOST_MODES + 1).collect()]
    if len(found) > MOST_MODES:
        raise ValueError(f"more than {MOST_MODES} shipping modes")
    return sorted(m for m in found if m is not None)


def heatmap(routes: DataFrame, metric: str, modes: list[str]) -> DataFrame:
    """Market by shipping mode. Missing routes are 0."""
    cells = routes.select("market", "shipping_mode", F.col(metric).cast("double").alias("cell"))
    return (
        cells.groupBy("market").pivot("shipping_mode", modes).agg(F.first("cell")).fillna(0.0).orderBy("market")
    )


def heatmap_otif(routes: DataFrame, modes: list[str]) -> DataFrame:
    return heatmap(routes, "otif_rate_pct", modes)


def heatmap_delay(routes: DataFrame, modes: list[str]) -> DataFrame:
    return heatmap(routes, "avg_delay_days", modes)


def heatmap_late_revenue(routes: DataFrame, modes: list[str]) -> DataFrame:
    return heatmap(routes, "late_revenue_at_risk", modes)


def heatmap_bands(routes: DataFrame, modes: list[str], params: Params = DEFAULTS) -> DataFrame:
    """One row per cell of the three heatmaps with the name of its colour band. One pivot of
    the small route table gives all cells, missing routes included."""
    metrics = ("otif_rate_pct", "avg_delay_days", "late_revenue_at_risk")
    small = routes.select("market", "shipping_mode", *[F.col(m).cast("double").alias(m) for m in metrics])
    grid = (
        small.groupBy("market").pivot("shipping_mode", modes).agg(*[F.first(m).alias(m) for m in metrics]).fillna(0.0)
    )
    cells = grid.select(
        "market",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric"),
                        F.lit(column.removesuffix(f"_{metric}")).alias("shipping_mode"),
                        F.col(f"`{column}`").alias("value"),
                    )
                    for column in grid.columns
                    for metric in metrics
                    if column.endswith(f"_{metric}")
                ]
            )
        ),
    )
    value = F.col("value")
    band = (
        F.when((F.col("metric") == "otif_rate_pct") & (value < params.heat_low), "danger")
        .when((F.col("metric") == "otif_rate_pct") & (value < params.heat_mid), "warning")
        .when(F.col("metric") == "otif_rate_pct", "success")
        .when((F.col("metric") == "avg_delay_days") & (value > params.heat_delay), "danger")
        .otherwise("none")
    )
    return cells.select("metric", "market", "shipping_mode", "value", band.alias("band"))


def classification_roster(classified: DataFrame) -> DataFrame:
    """Classified products by falling revenue; shares as fractions, AZ and CZ marked."""
    return classified.select(
        "product_id",
        "product_name",
        "category_name",
        "department_name",
        "product_price",
        "total_units_sold",
        "total_revenue",
        "total_profit",
        (F.col("revenue_share_pct") / 100.0).alias("revenue_share"),
        (F.col("cumulative_revenue_pct") / 100.0).alias("cumulative_revenue"),
        "abc_class",
        "demand_cv",
        "xyz_class",
        "abc_xyz_segment",
        "operational_priority",
        "recommended_strategy",
        "inventory_policy",
        F.when(F.col("abc_xyz_segment") == "AZ", "danger")
        .when(F.col("abc_xyz_segment") == "CZ", "muted")
        .otherwise("none")
        .alias("highlight"),
    ).orderBy(F.col("total_revenue").desc(), "product_id")


ROSTER_COLUMNS = [
    "product_id", "product_name", "category_name", "department_name", "product_price", "abc_xyz_segment",
    "mean_daily_demand", "avg_lead_time_days", "safety_stock_units", "reorder_point_units",
    "current_stock_units", "stock_status", "inventory_valuation", "excess_capital_tied_up",
    "stockout_revenue_at_risk",
]


def reorder_roster(master: DataFrame) -> DataFrame:
    """Products by stock-out risk and tied-up capital, closed by a total row (``is_total``)."""
    detail = master.select(F.lit(0).alias("is_total"), *ROSTER_COLUMNS)
    summed = ["current_stock_units", "inventory_valuation", "excess_capital_tied_up", "stockout_revenue_at_risk"]
    total = master.agg(*[F.sum(c).alias(c) for c in summed])
    kinds = {f.name: f.dataType for f in detail.schema.fields}
    total_row = total.select(
        F.lit(1).alias("is_total"),
        *[
            F.lit(ROSTER_TOTAL).alias(c)
            if c == "product_name"
            else F.col(c)
            if c in summed
            else F.lit(None).cast(kinds[c]).alias(c)
            for c in ROSTER_COLUMNS
        ],
    )
    return detail.unionByName(total_row).orderBy(
        "is_total",
        F.col("stockout_revenue_at_risk").desc(),
        F.col("excess_capital_tied_up").desc(),
        "product_id",
    )


def sku_lookup(requested: DataFrame, master: DataFrame) -> DataFrame:
    """Diagnostics for the requested ``product_id`` values; unknown ones get placeholders."""
    texts = {"product_name": "SKU Not Found", "category_name": "N/A", "abc_xyz_segment": "N/A"}
    numbers = [
        "mean_daily_demand", "avg_lead_time_days", "safety_stock_units", "reorder_point_units",
        "current_stock_units", "product_price",
    ]
    found = master.select("product_id", *texts, *numbers)
    return requested.select("product_id").join(found, "product_id", "left").select(
        "product_id",
        *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in texts.items()],
        *[F.coalesce(F.col(c), F.lit(0).cast(found.schema[c].dataType)).alias(c) for c in numbers],
    )


def sku_directive(master: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """What to do about each product, as text."""
    short = F.col("reorder_point_units") - F.col("current_stock_units")
    text = (
        F.when(short > 0, F.concat(F.lit(DEFICIT_HEAD), short.cast("string"), F.lit(DEFICIT_TAIL)))
        .when(overstocked(params), F.lit(OVERSTOCK_TEXT))
        .otherwise(F.lit(OPTIMAL_TEXT))
    )
    return master.select(
        "product_id", "current_stock_units", "reorder_point_units", text.alias("operational_directive")
    )


def days_on_hand(master: DataFrame) -> DataFrame:
    """Stock divided by the shown (rounded) daily demand; null without demand."""
    demand = F.col("mean_daily_demand")
    days = F.when(demand > 0, rnd(ratio(F.col("current_stock_units"), demand), 1))
    return master.select("product_id", "current_stock_units", "mean_daily_demand", days.alias("days_on_hand"))
