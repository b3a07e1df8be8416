"""The star schema as one value: two dimensions, the order-line fact and, once they have
been written, the rollups that the analytics read instead of the fact."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.functions.dates import month_start
from tidelane.functions.numeric import square


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    products: DataFrame
    customers: DataFrame
    daily: DataFrame | None = None
    routes: DataFrame | None = None
    deliveries: DataFrame | None = None
    by_customer: DataFrame | None = None
    keys: DataFrame | None = None

    def demand(self) -> DataFrame:
        """Additive demand measures: the daily rollup if there is one, else one row per line."""
        return self.daily if self.daily is not None else line_demand(self.fact)

    def lead_times(self) -> DataFrame:
        """Additive lead-time measures per product and route, from the rollup if there is one."""
        return self.routes if self.routes is not None else route_rollup(self.fact)

    def order_measures(self, *keys: str) -> DataFrame:
        """Additive delivery measures per market, shipping mode, month (its first day) or any of them, from the
        rollup if there is one."""
        if self.deliveries is not None:
            return _resummed(self.deliveries, *keys)
        return _delivery_sums(self.fact.withColumn("month", month_start(F.col("order_date"))), *keys)

    def customer_measures(self) -> DataFrame:
        return self.by_customer if self.by_customer is not None else customer_rollup(self.fact)

    def lines_per(self, key: str) -> DataFrame:
        """Number of lines ``n`` per product or customer, those without one included."""
        if key == "product_id":
            return self.demand().groupBy(key).agg(F.sum("lines").alias("n"))
        return self.customer_measures().select(key, F.col("lines").alias("n"))

    def with_rollups(
        self, daily: DataFrame, routes: DataFrame, deliveries: DataFrame | None = None, by_customer: DataFrame | None = None
    ) -> Star:
        return replace(self, daily=daily, routes=routes, deliveries=deliveries, by_customer=by_customer)


def line_demand(fact: DataFrame) -> DataFrame:
    return fact.select(
        "product_id",
        F.to_date("order_date").alias("order_day"),
        F.lit(1).cast("long").alias("lines"),
        F.col("quantity_ordered").cast("long").alias("units"),
        F.col("sales_amount").alias("sales"),
        F.col("profit_per_order").alias("profit"),
        F.col("discount_rate").alias("discount"),
        F.when(F.col("profit_per_order") < 0, 1).otherwise(0).cast("long").alias("loss_lines"),
    )


def daily_rollup(fact: DataFrame) -> DataFrame:
    """Demand measures per product and day. Sums combine before the shuffle, so a product
    that holds a large share of the lines costs no more than its number of days."""
    return (
        line_demand(fact)
        .groupBy("product_id", "order_day")
        .agg(
            *[
                F.sum(name).alias(name)
                for name in ("lines", "units", "sales", "profit", "discount", "loss_lines")
            ]
        )
    )


def route_rollup(fact: DataFrame) -> DataFrame:
    """Lines, days and squared days per product, shipping mode and market."""
    return fact.groupBy("product_id", "shipping_mode", "market").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("days_real").cast("long")).alias("days"),
        F.sum(square(F.col("days_real"))).alias("squared_days"),
    )


def _delivery_lines(fact: DataFrame) -> tuple[dict[str, Column], dict[str, Column]]:
    """Additive delivery measures of lines, and the extremes of their days. ``other`` are the lines that are not
    known to be on time."""
    on_time = F.col("days_real") <= F.col("days_scheduled")
    late = F.col("days_real") > F.col("days_scheduled")
    known = F.coalesce(on_time, F.lit(False))
    real = F.col("days_real").cast("long")
    sums = {
        "lines": F.lit(1).cast("long"),
        "on_time": on_time.cast("long"),
        "late": late.cast("long"),
        "scheduled_days": F.col("days_scheduled").cast("long"),
        "real_days": real,
        "squared_days": square(real),
        "delay": (F.col("days_real") - F.col("days_scheduled")).cast("long"),
        "sales": F.col("sales_amount"),
        "late_sales": F.when(late, F.col("sales_amount")).otherwise(0),
        "profit": F.col("profit_per_order"),
        "on_time_sales": F.when(known, F.col("sales_amount")),
        "on_time_profit": F.when(known, F.col("profit_per_order")),
        "other_sales": F.when(~known, F.col("sales_amount")),
        "other_profit": F.when(~known, F.col("profit_per_order")),
    }
    return sums, {"min_days": F.min("days_real"), "max_days": F.max("days_real")}


def _delivery_sums(fact: DataFrame, *keys) -> DataFrame:
    sums, extremes = _delivery_lines(fact)
    summed = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(n) if n in ("lines", "on_time", "late") else F.sum(c).alias(n)
              for n, c in sums.items()]
    return fact.groupBy(*keys).agg(*summed, *[c.alias(n) for n, c in extremes.items()])


def _resummed(rollup: DataFrame, *keys) -> DataFrame:
    how = {"min_days": F.min, "max_days": F.max}
    measures = [c for c in rollup.columns if c not in ("market", "shipping_mode", "month", "customer_id")]
    totals = [how.get(c, F.sum)(c).alias(c) for c in measures]
    counts = ("lines", "on_time", "late")
    return rollup.groupBy(*keys).agg(*totals).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in counts}
    )


def delivery_rollup(fact: DataFrame) -> DataFrame:
    """Delivery measures per market, shipping mode and month."""
    return _delivery_sums(fact, "market", "shipping_mode", month_start(F.col("order_date")).alias("month"))


def customer_rollup(fact: DataFrame) -> DataFrame:
    """Delivery measures per customer."""
    return _delivery_sums(fact, "customer_id")


_DELIVERY = {
    n: n
    for n in (
        "lines", "on_time", "late", "scheduled_days", "real_days", "squared_days", "delay", "sales", "late_sales", "profit",
        "on_time_sales", "on_time_profit", "other_sales", "other_profit", "min_days", "max_days",
    )
}
#: Per rollup its keys and its measures with their names in ``all_rollups``.
ROLLUPS = {
    "product_daily": (
        ("product_id", "order_day"),
        {n: n for n in ("lines", "units", "sales", "profit", "discount", "loss_lines")},
    ),
    "product_routes": (
        ("product_id", "shipping_mode", "market"),
        {"lines": "lines", "days": "real_days", "squared_days": "squared_days"},
    ),
    "delivery_months": (("market", "shipping_mode", "month"), _DELIVERY),
    "customer_orders": (("customer_id",), _DELIVERY),
}
EXTREMES = {"min_days": F.min, "max_days": F.max}


def all_rollups(fact: DataFrame) -> DataFrame:
    """All four rollups from one scan, as grouping sets: ``rollup`` names the set, keys of other sets are null. Each line is
    summed once per set before the shuffle."""
    sums, _ = _delivery_lines(fact)
    keys = list(dict.fromkeys(k for names, _ in ROLLUPS.values() for k in names))
    made = {"order_day": F.to_date("order_date"), "month": month_start(F.col("order_date"))}
    measures = sums | {
        "units": F.col("quantity_ordered").cast("long"),
        "discount": F.col("discount_rate"),
        "loss_lines": F.when(F.col("profit_per_order") < 0, 1).otherwise(0).cast("long"),
    }
    lines = fact.select(
        *[made.get(k, F.col(k)).alias(k) for k in keys],
        *[c.alias(f"_{n}") for n, c in measures.items()],
        F.col("days_real").alias("_days"),
    )
    names = {sum((k not in wanted) << (len(keys) - 1 - i) for i, k in enumerate(keys)): name for name, (wanted, _) in ROLLUPS.items()}
    which = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.grouping_id().cast("int"))
    counts = ("lines", "on_time", "late")
    summed = [F.coalesce(F.sum(f"_{n}"), F.lit(0).cast("long")).alias(n) if n in counts else F.sum(f"_{n}").alias(n) for n in measures]
    return lines.groupingSets([[F.col(k) for k in wanted] for wanted, _ in ROLLUPS.values()], *keys).agg(
        which.alias("rollup"), *summed, *[how("_days").alias(n) for n, how in EXTREMES.items()]
    )


def separate_rollups(fact: DataFrame) -> DataFrame:
    """The table of ``all_rollups`` from a scan for each: every rollup reads and shuffles its own columns, the measures that only others hold
    are null. Grouping sets read the fact once, but carry all measures with each line, four times."""
    sums, _ = _delivery_lines(fact)
    keys = list(dict.fromkeys(k for names, _ in ROLLUPS.values() for k in names))
    made = {"order_day": F.to_date("order_date"), "month": month_start(F.col("order_date"))}
    measures = sums | {
        "units": F.col("quantity_ordered").cast("long"),
        "discount": F.col("discount_rate"),
        "loss_lines": F.when(F.col("profit_per_order") < 0, 1).otherwise(0).cast("long"),
    }
    counts = ("lines", "on_time", "late")
    parts = []
    for name, (wanted, held) in ROLLUPS.items():
        stored = [*held.values()]
        lines = fact.select(
            *[made.get(k, F.col(k)).alias(k) for k in wanted],
            *[measures[n].alias(f"_{n}") for n in stored if n in measures],
            *([F.col("days_real").alias("_days")] if {*stored} & {*EXTREMES} else []),
        )
        totals = [
            EXTREMES[n]("_days") if n in EXTREMES else F.coalesce(F.sum(f"_{n}"), F.lit(0).cast("long")) if n in counts else F.sum(f"_{n}")
            for n in stored
        ]
        summed = lines.groupBy(*wanted).agg(*[c.alias(n) for c, n in zip(totals, stored, strict=True)])
        parts.append(summed.withColumn("rollup", F.lit(name)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every.select(*keys, "rollup", *measures, *EXTREMES)


def merged_rollups(parts: DataFrame) -> DataFrame:
    """Rollups of disjoint lines, as ``all_rollups`` gives them, added up."""
    keys = list(dict.fromkeys(k for names, _ in ROLLUPS.values() for k in names))
    measures = [c for c in parts.columns if c not in (*keys, "rollup")]
    return parts.groupBy("rollup", *keys).agg(*[EXTREMES.get(c, F.sum)(c).cast(parts.schema[c].dataType).alias(c) for c in measures])
