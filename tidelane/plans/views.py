"""The nine named views for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidelane.functions.numeric import plain
from tidelane.operators import delivery, revenue
from tidelane.sources.catalog import place, plain_columns
from tidelane.sources.loads import published
from tidelane.star import Star

VIEWS = {
    "v_otif_by_route": delivery.otif_by_route,
    "v_monthly_delivery_trends": delivery.monthly_delivery_trends,
    "v_customer_segment_fulfillment": delivery.segment_fulfillment,
    "v_late_delivery_cost_impact": delivery.late_cost_impact,
    "v_lead_time_route_distribution": delivery.lead_time_distribution,
    "v_category_revenue_ranked": revenue.category_revenue_ranked,
    "v_product_revenue_pareto": revenue.product_revenue_pareto,
    "v_product_weekly_demand": revenue.product_weekly_demand,
    "v_loss_making_products_audit": revenue.loss_making_products,
}


def register_views(spark: SparkSession, star: Star, names: list[str] | None = None) -> list[str]:
    """Register the views of one star as temporary views and return their names. Nothing is computed before a view is read. They
    stay with that star; ``register_stored_views`` gives views that follow loads."""
    for name in names or list(VIEWS):
        plain(VIEWS[name](star)).createOrReplaceTempView(name)
    return names or list(VIEWS)


def register_stored_views(spark: SparkSession, root: str, names: list[str] | None = None) -> list[str]:
    """Register the views over the tables that a run has stored under ``root``, without computing anything anew. They are names in
    the root's database as well as temporary views, and follow later loads (see ``sources.catalog``)."""
    load = published(spark, root)
    if load is None:
        raise ValueError(f"{root} has no published load")
    database = place(load)
    for name in names or list(VIEWS):
        table = f"{database}.{VIEWS[name].__name__}"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {plain_columns(spark.table(table).schema)} FROM {table}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {database}.{name}")
    return names or list(VIEWS)
