"""Audits of the order lines and of the constraints between the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.functions.numeric import percent, ratio, rnd
from tidelane.schema import CUSTOMER_REQUIRED, FACT_REQUIRED, PRODUCT_REQUIRED
from tidelane.star import Star

# Names of the audits' counts.
_NULL_COUNTS = {
    "null_order_ids": "order_id",
    "null_product_ids": "product_id",
    "null_customer_ids": "customer_id",
    "null_order_dates": "order_date",
    "null_sales": "sales_amount",
    "null_profit": "profit_per_order",
    "null_scheduled_days": "days_scheduled",
    "null_real_days": "days_real",
}


def _range_tests() -> dict[str, Column]:
    return {
        "non_positive_quantities": F.col("quantity_ordered") <= 0,
        "non_positive_prices": F.col("product_price") <= 0,
        "invalid_discount_rates": (F.col("discount_rate") < 0) | (F.col("discount_rate") > 1),
        "non_positive_scheduled_days": F.col("days_scheduled") <= 0,
        "negative_real_days": F.col("days_real") < 0,
        "negative_sales": F.col("sales_amount") < 0,
    }


def _audit_counts() -> list[Column]:
    return [
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in _NULL_COUNTS.items()],
        *[F.count_if(test).alias(name) for name, test in _range_tests().items()],
    ]


def line_audit(fact: DataFrame) -> DataFrame:
    """Null and range counts in one pass, one row. The two audits below select from it, so
    each of them computes only its own counts."""
    return fact.agg(*_audit_counts())


def line_audit_of(counts: DataFrame) -> DataFrame:
    """The columns of ``line_audit`` from stored ``fact_counts``."""
    return counts.select("total_records", *_NULL_COUNTS, *_range_tests())


def dq_null_audit(fact: DataFrame) -> DataFrame:
    return line_audit(fact).select(F.lit("fact_orders").alias("table_name"), "total_records", *_NULL_COUNTS)


def dq_range_audit(fact: DataFrame) -> DataFrame:
    return line_audit(fact).select(F.lit("Range & Logic Anomalies").alias("audit_type"), *_range_tests())


def dq_duplicate_keys(fact: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Keys of several lines. ``keys`` are the stored line keys, which need no shuffle."""
    counted = fact.groupBy("order_item_id").agg(F.count("*").alias("occurrence_count")) if keys is None else _per_key(keys)
    return counted.where("occurrence_count > 1")


def _per_key(keys: DataFrame) -> DataFrame:
    return keys.groupBy("order_item_id").agg(F.sum("copies").alias("occurrence_count"))


def _delay_counts() -> list[Column]:
    delay = F.col("days_real") - F.col("days_scheduled")
    return [
        F.count(delay).alias("_n"),
        F.sum(delay.cast("long")).alias("_delay"),
        F.min(delay).alias("min_delay_variance"),
        F.max(delay).alias("max_delay_variance"),
    ]


def raw_counts(lines: DataFrame) -> DataFrame:
    """All audits of lines as they came in, from one scan: grouping sets by status and flag (``by_key`` false) and by key (true), of
    which only keys of several lines are kept, and the lines without a key."""
    keys = ["delivery_status", "late_delivery_risk", "order_item_id"]
    sets = [[F.col(keys[0]), F.col(keys[1])], [F.col(keys[2])]]
    counted = lines.groupingSets(sets, *keys).agg(
        (F.grouping("order_item_id") == 0).alias("by_key"), *_audit_counts(), *_delay_counts()
    )
    return counted.where("NOT by_key OR total_records > 1 OR order_item_id IS NULL")


def added_raw_counts(before: DataFrame, counts: DataFrame, asked: DataFrame) -> DataFrame:
    """Stored ``raw_counts`` and those of more lines. ``asked`` has the keys of the added lines with their number and
    the stored ``copies``; a stored key that was not counted as several came in once."""
    every = counts.columns
    old = before.where("by_key").select("order_item_id", F.col("total_records").alias("_before"))
    several = (
        asked.join(old, "order_item_id", "left")
        .withColumn("_total", F.col("asked") + F.coalesce("_before", F.when(F.col("copies").isNotNull(), 1).otherwise(0)))
        .where("_total > 1")
        .select("order_item_id", F.lit(True).alias("by_key"), F.col("_total").cast("long").alias("total_records"))
    )
    kept = before.where("by_key").join(asked, "order_item_id", "left_anti").select(every)
    # lines without a key are one group in both
    keyless = before.where("by_key AND order_item_id IS NULL").unionByName(counts.where("by_key AND order_item_id IS NULL"))
    keyless = keyless.groupBy("order_item_id", "by_key").agg(F.sum("total_records").alias("total_records"))
    parts = [counts.where("NOT by_key"), kept.where("order_item_id IS NOT NULL"), several, keyless]
    out = before.where("NOT by_key").select(every)
    for part in parts:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(every)


def line_audit_of_raw(counts: DataFrame) -> DataFrame:
    """The columns of ``line_audit`` from stored ``raw_counts``."""
    names = ["total_records", *_NULL_COUNTS, *_range_tests()]
    return counts.where("NOT by_key").agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in names])


def duplicates_of_raw(counts: DataFrame) -> DataFrame:
    """``dq_duplicate_keys`` from stored ``raw_counts``."""
    repeated = counts.where("by_key AND total_records > 1")
    return repeated.select("order_item_id", F.col("total_records").alias("occurrence_count"))


def concordance_of_raw(counts: DataFrame) -> DataFrame:
    """``dq_status_concordance`` from stored ``raw_counts``."""
    delays = [F.sum(c).alias(c) for c in ("_n", "_delay")]
    extremes = [F.min("min_delay_variance").alias("min_delay_variance"), F.max("max_delay_variance").alias("max_delay_variance")]
    groups = counts.where("NOT by_key").groupBy("delivery_status", "late_delivery_risk")
    return _concordance(groups.agg(F.sum("total_records").alias("record_count"), *delays, *extremes))


def dq_status_concordance(fact: DataFrame) -> DataFrame:
    return _concordance(
        fact.groupBy("delivery_status", "late_delivery_risk").agg(F.count("*").alias("record_count"), *_delay_counts())
    )


def _concordance(counted: DataFrame) -> DataFrame:
    return (
        counted.select(
            "delivery_status",
            "late_delivery_risk",
            "record_count",
            rnd(ratio(F.col("_delay"), F.col("_n")), 2).alias("avg_delay_variance"),
            "min_delay_variance",
            "max_delay_variance",
        )
        .orderBy("delivery_status", "late_delivery_risk")
    )


def _orphans(per_key: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return per_key.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphans")
    )


def orphan_lines(fact: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row ``orphans``: fact lines whose key has no parent. The lines are counted per key
    before the anti-join, so the join sees one row per key."""
    return _orphans(fact.groupBy(key).agg(F.count("*").alias("n")), parent, key)


def dq_orphan_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    return orphan_lines(fact, products, "product_id").select(
        F.lit("Orphaned Fact Records").alias("check_name"), F.col("orphans").alias("orphan_count")
    )


def dq_orphan_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return orphan_lines(fact, customers, "customer_id").select(
        F.lit("Orphaned Customer Records").alias("check_name"), F.col("orphans").alias("orphan_count")
    )


def _long_form(one_row: DataFrame, cells: list[tuple[str, str, str]]) -> DataFrame:
    """One row of named counts to rows (check_name, metric, value)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(metric).alias("metric"),
                F.col(column).cast("double").alias("value"),
            )
            for check, metric, column in cells
        ]
    )
    return one_row.select(F.inline(rows))


def fact_counts(fact: DataFrame) -> DataFrame:
    """All counts of lines that audits, scorecard and constraints need, one row from one scan."""
    rules = [F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(_line_rules())]
    on_time = F.count_if(F.col("days_real") <= F.col("days_scheduled")).alias("on_time")
    return fact.agg(*_audit_counts(), on_time, *rules)


def added_counts(*counts: DataFrame) -> DataFrame:
    """Stored ``fact_counts`` of disjoint lines, added up."""
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return every.agg(*[F.sum(c).alias(c) for c in every.columns])


def dq_scorecard(star: Star, counts: DataFrame | None = None) -> DataFrame:
    """The five checks that follow each load, one row per figure. ``counts`` are stored ``fact_counts``."""
    counted = fact_counts(star.fact) if counts is None else counts
    totals = counted.select(
        F.col("total_records").alias("records"),
        "null_sales",
        F.col("non_positive_quantities").alias("invalid_qty"),
        "on_time",
    ).withColumn("otif_pct", rnd(percent(F.col("on_time"), F.col("records")), 2))
    figures = _long_form(
        totals,
        [
            ("Null Fact Check", "records", "records"),
            ("Null Fact Check", "null_sales", "null_sales"),
            ("Negative Quantities", "invalid_qty", "invalid_qty"),
            ("OTIF Overall Summary", "total_orders", "records"),
            ("OTIF Overall Summary", "otif_pct", "otif_pct"),
        ],
    )
    products = _long_form(
        _orphans(star.lines_per("product_id"), star.products, "product_id"), [("Orphan Products", "orphans", "orphans")]
    )
    customers = _long_form(
        _orphans(star.lines_per("customer_id"), star.customers, "customer_id"), [("Orphan Customers", "orphans", "orphans")]
    )
    return figures.unionByName(products).unionByName(customers)


def scorecard_text(scorecard: DataFrame) -> DataFrame:
    """The scorecard with the figures of a check written as one tuple."""
    figure = F.when(F.col("metric") == "otif_pct", F.col("value").cast("string")).otherwise(
        F.col("value").cast("long").cast("string")
    )
    # the count that leads a pair sorts first; no check has more than two figures
    place = F.when(F.col("metric").isin("records", "total_orders"), 0).otherwise(1)
    figures = F.array_sort(F.collect_list(F.struct(place.alias("place"), figure.alias("figure"))))["figure"]
    closing = F.when(F.count("*") == 1, ",)").otherwise(")")
    return scorecard.groupBy("check_name").agg(
        F.concat(F.lit("("), F.array_join(figures, ", "), closing).alias("result")
    )


def _line_rules() -> list[tuple[str, str, Column]]:
    """(rule, column, condition of a violation) for a single fact line."""
    rules = [("not_null", c, F.col(c).isNull()) for c in FACT_REQUIRED]
    rules += [
        ("check", "quantity_ordered", F.col("quantity_ordered") <= 0),
        ("check", "late_delivery_risk", ~F.col("late_delivery_risk").isin(0, 1)),
        ("not_null", "order_item_id", F.col("order_item_id").isNull()),
    ]
    return rules


def _broken(rules: list[tuple[str, str, Column]]) -> Column:
    broken = F.lit(False)
    for _, _, condition in rules:
        broken = broken | F.coalesce(condition, F.lit(False))
    return broken


def passing_lines(fact: DataFrame) -> DataFrame:
    return fact.where(~_broken(_line_rules()))


def quarantine_lines(fact: DataFrame) -> DataFrame:
    """Lines that break a NOT NULL or CHECK rule."""
    return fact.where(_broken(_line_rules()))


def _violations(
    df: DataFrame, table: str, rules: list[tuple[str, str, Column]], counted: DataFrame | None = None
) -> DataFrame:
    if counted is None:
        counted = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("long").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(rules)
        ]
    )
    return counted.select(F.inline(rows))


def _repeated_keys(df: DataFrame, table: str, key: str, keys: DataFrame | None = None) -> DataFrame:
    n = df.groupBy(key).agg(F.count("*").alias("occurrence_count")) if keys is None else _per_key(keys)
    surplus = n.agg(F.coalesce(F.sum(F.greatest(F.col("occurrence_count") - 1, F.lit(0))), F.lit(0)).alias("n"))
    return surplus.select(
        F.lit(table).alias("table_name"),
        F.lit("primary_key").alias("rule"),
        F.lit(key).alias("column_name"),
        F.col("n").cast("long").alias("violations"),
    )


def _unmatched(star: Star, parent: DataFrame, key: str) -> DataFrame:
    return _orphans(star.lines_per(key).where(F.col(key).isNotNull()), parent, key).select(
        F.lit("fact_orders").alias("table_name"),
        F.lit("foreign_key").alias("rule"),
        F.lit(key).alias("column_name"),
        F.col("orphans").alias("violations"),
    )


def dq_constraints(star: Star, counts: DataFrame | None = None) -> DataFrame:
    """Violations of every declared rule: keys, references, NOT NULL and CHECK. ``counts`` are stored
    ``fact_counts``."""
    product_rules = [("not_null", c, F.col(c).isNull()) for c in ["product_id", *PRODUCT_REQUIRED]]
    product_rules.append(("check", "product_price", F.col("product_price") < 0))
    customer_rules = [("not_null", c, F.col(c).isNull()) for c in ["customer_id", *CUSTOMER_REQUIRED]]
    parts = [
        _violations(star.fact, "fact_orders", _line_rules(), counts),
        _violations(star.products, "dim_products", product_rules),
        _violations(star.customers, "dim_customers", customer_rules),
        _repeated_keys(star.fact, "fact_orders", "order_item_id", star.keys),
        _repeated_keys(star.products, "dim_products", "product_id"),
        _repeated_keys(star.customers, "dim_customers", "customer_id"),
        _unmatched(star, star.products, "product_id"),
        _unmatched(star, star.customers, "customer_id"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
