"""The whole run: raw lines to star, audits, classification, inventory model and report tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.functions.numeric import plain
from tidelane.operators import classify, delivery, inventory, quality, report, revenue
from tidelane.operators.cleaning import (
    REASONS,
    REJECTED,
    clean_lines,
    date_layouts,
    dedupe_order_items,
    etl_audit,
    normalize_risk_flag,
    rejected_lines,
    settle_dates,
    typed_lines,
)
from tidelane.operators.star import build_star
from tidelane.params import DEFAULTS, Params
from tidelane.plans.views import register_stored_views
from tidelane.schema import CUSTOMER_COLUMNS, DAY_READING, FACT_COLUMNS, MALFORMED, PRODUCT_COLUMNS, SOURCE_POSITION
from tidelane.sources.loads import Draft, Tables, new_draft, publish, writing
from tidelane.sources.raw_orders import read_raw_orders
from tidelane.sources.store import (
    CUSTOMERS,
    FACT,
    KEYS,
    MONTH,
    PRODUCTS,
    REJECTS,
    SUMS,
    by_month,
    count_keys,
    known_keys,
    read_keys,
    read_star,
    runtime_filters,
    store_keys,
    write_keys,
    write_rollups,
    write_sorted,
    write_star,
)
from tidelane.star import Star, all_rollups, merged_rollups

#: Tables that are written at the same time; each is a small job, so a run waits for jobs rather than for work.
WRITERS = 4


def _stored_columns(lines: DataFrame) -> DataFrame:
    """Lines without the columns that no table of the star holds."""
    loaded = {*PRODUCT_COLUMNS, *CUSTOMER_COLUMNS, *FACT_COLUMNS, SOURCE_POSITION, REJECTED, REASONS, MALFORMED, DAY_READING}
    return lines.select(*[c for c in lines.columns if c in loaded])


def write_all(jobs: list[Callable[[], None]]) -> None:
    """Run independent writes from a few threads; the first error is raised when all have ended."""
    inherited = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(inherited(job)) for job in jobs]:
            done.result()


def stage_star(raw: DataFrame, tables: Tables, params: Params = DEFAULTS, order_by: list[Column] | None = None) -> None:
    """Clean raw lines and write the star, its rollups and keys, the rejected lines and the audits of what came in.

    The raw text is parsed once: typed lines are written with their copies. A scan of their dates settles the layout of each file's
    dates, one scan counts all audits and one removes the copies. The unique lines are written once as well; dimensions, fact and rejects read
    them, so the shuffle that removes copies runs once. All rollups come from one scan of the stored fact.
    """
    spark = raw.sparkSession
    typed = typed_lines(raw, both=True)
    kept = [c for c in clean_lines(typed, params).columns if not c.startswith("_")]
    tables.write(_stored_columns(typed), "typed_lines")
    tables.write(date_layouts(tables.read("typed_lines")), "dq_date_layouts")
    typed = settle_dates(tables.read("typed_lines"), tables.read("dq_date_layouts"))
    write_all(
        [
            lambda: tables.write(dedupe_order_items(typed, order_by), "staged_lines"),
            lambda: tables.write(quality.raw_counts(normalize_risk_flag(typed)), "dq_raw_counts"),
        ]
    )
    staged = tables.read("staged_lines")
    star = build_star(clean_lines(staged, params))
    write_all(
        [
            lambda: tables.write(by_month(star.fact), FACT, MONTH),
            *_raw_audits(tables),
            lambda: tables.write(star.products, PRODUCTS),
            lambda: tables.write(star.customers, CUSTOMERS),
            lambda: tables.write(rejected_lines(staged), REJECTS),
        ],
    )
    write_all(
        [
            lambda: write_rollups(spark, tables),
            lambda: write_keys(spark, tables),
            lambda: tables.write(_load_audit(tables, tables.read(REJECTS), raw.columns, kept), "etl_audit"),
        ],
    )


def _load_audit(tables: Tables, rejected: DataFrame, raw_columns: list[str], kept: list[str]) -> DataFrame:
    counts = tables.read("dq_raw_counts").where("NOT by_key")
    fact = tables.read(FACT)
    return etl_audit(counts, fact, rejected, raw_columns, rows=F.sum("total_records")).withColumn("columns_retained", F.lit(len(kept)))


def _raw_audits(tables: Tables) -> list[Callable[[], None]]:
    counts = tables.read("dq_raw_counts")
    return [
        lambda: tables.write(quality.line_audit_of_raw(counts), "dq_raw_line_audit"),
        lambda: tables.write(quality.duplicates_of_raw(counts), "dq_raw_duplicate_keys"),
        lambda: tables.write(quality.concordance_of_raw(counts), "dq_raw_status_concordance"),
    ]


def load_star(raw: DataFrame, root: str, params: Params = DEFAULTS, order_by: list[Column] | None = None) -> Star:
    """The load step by itself: a load of the star without result tables, published at the end."""
    draft = new_draft(raw.sparkSession, root)
    stage_star(raw, draft, params, order_by)
    return read_star(raw.sparkSession, publish(draft), rollups=True)


def append_star(raw: DataFrame, draft: Draft, params: Params = DEFAULTS, order_by: list[Column] | None = None) -> None:
    """Add lines to the star that a draft keeps; ``raw`` comes later in the source than what is stored.

    A stored line stays the first copy of its key, also where it was rejected. Of the stored fact nothing is read:
    keys come from the table of line keys, filtered by the range and by a Bloom filter of the new keys and not shuffled; new lines are folders of
    their own; rollups, counts and keys are sums to which those of the new lines are added.
    """
    spark = raw.sparkSession
    if not draft.has(KEYS):
        raise ValueError(f"{draft.root} has no load to append to")
    before = read_keys(spark, draft)
    buckets = draft.bucketed_path(KEYS)[1]
    old_rollups = draft.read(SUMS)
    old_counts = draft.read("dq_fact_counts") if draft.has("dq_fact_counts") else None
    old_audit, old_raw = draft.read("etl_audit"), draft.read("dq_raw_counts")
    products, customers = draft.read(PRODUCTS), draft.read(CUSTOMERS)

    draft.extend(_stored_columns(typed_lines(raw, both=True)), "typed_lines")
    draft.extend(date_layouts(draft.newest("typed_lines")), "dq_date_layouts")
    typed = settle_dates(draft.newest("typed_lines"), draft.newest("dq_date_layouts"))
    with runtime_filters(spark):
        draft.write(known_keys(typed, before), "appended_keys")
    asked = draft.read("appended_keys")
    known = asked.where("copies IS NOT NULL").select("order_item_id")
    unseen = typed.join(known, "order_item_id", "left_anti").select(typed.columns)
    draft.extend(dedupe_order_items(unseen, order_by), "staged_lines")
    staged = draft.newest("staged_lines")
    star = build_star(clean_lines(staged, params))
    counts = quality.raw_counts(normalize_risk_flag(typed))
    draft.extend(by_month(star.fact), FACT, MONTH)
    fact = draft.newest(FACT).drop(MONTH)
    write_all(
        [
            lambda: draft.extend(rejected_lines(staged), REJECTS),
            lambda: draft.extend(star.products.join(products, "product_id", "left_anti").select(star.products.columns), PRODUCTS),
            lambda: draft.extend(star.customers.join(customers, "customer_id", "left_anti").select(star.customers.columns), CUSTOMERS),
            lambda: draft.write(merged_rollups(old_rollups.unionByName(all_rollups(fact))).hint("rebalance", F.col("rollup")), SUMS, "rollup"),
            lambda: draft.write(quality.added_raw_counts(old_raw, counts, asked), "dq_raw_counts"),
        ]
    )
    new_keys = count_keys(fact, draft.newest(REJECTS)).repartition(buckets, "order_item_id")
    jobs = [lambda: store_keys(draft, before.unionByName(new_keys), buckets)]
    if old_counts is not None:
        jobs.append(lambda: draft.write(quality.added_counts(old_counts, quality.fact_counts(fact)), "dq_fact_counts"))
    sums = ("initial_rows", "cleaned_rows", "rejected_rows")
    audit = etl_audit(typed, fact, draft.newest(REJECTS), raw.columns)
    both = old_audit.unionByName(audit.withColumn("columns_retained", F.lit(None).cast(old_audit.schema["columns_retained"].dataType)))
    added = both.agg(*[(F.sum if c in sums else F.max)(c).cast(old_audit.schema[c].dataType).alias(c) for c in old_audit.columns])
    write_all([*jobs, lambda: draft.write(added, "etl_audit"), *_raw_audits(draft)])
    draft.drop("appended_keys")


def stage_results(
    spark: SparkSession, tables: Tables, params: Params = DEFAULTS, inventory_snapshot: DataFrame | None = None
) -> None:
    """Audits, classification and inventory table from a stored star, then the report tables
    from those two. Each table is stored once and read by the tables that follow."""
    star = read_star(spark, tables, rollups=True)
    if not tables.fresh("dq_fact_counts"):
        tables.write(quality.fact_counts(star.fact), "dq_fact_counts")
    counts = tables.read("dq_fact_counts")

    def models() -> None:
        tables.write(classify.classify_products(star, params), "inventory_abc_xyz_analysis")
        classified = tables.read("inventory_abc_xyz_analysis")
        write_sorted(inventory.inventory_master(star, classified, inventory_snapshot, params), tables, "inventory_safety_stock_rop", "product_id")

    single = {
        "dq_line_audit": quality.line_audit_of(counts),
        "dq_scorecard": quality.dq_scorecard(star, counts),
        "dq_constraints": quality.dq_constraints(star, counts),
        "otif_by_route": delivery.otif_by_route(star),
        "monthly_delivery_trends": delivery.monthly_delivery_trends(star),
        "segment_fulfillment": delivery.segment_fulfillment(star),
        "lead_time_distribution": delivery.lead_time_distribution(star),
        "late_cost_impact": delivery.late_cost_impact(star),
        "category_revenue_ranked": revenue.category_revenue_ranked(star),
        "product_revenue_pareto": revenue.product_revenue_pareto(star),
        "product_weekly_demand": revenue.product_weekly_demand(star),
        "loss_making_products": revenue.loss_making_products(star),
    }
    write_all([models, *[partial(tables.write, df, name) for name, df in single.items()]])
    build_report(spark, tables, star, params)


def build_results(
    spark: SparkSession, root: str | Tables, params: Params = DEFAULTS, inventory_snapshot: DataFrame | None = None
) -> None:
    """All results from a stored star. For a root with loads they become one more load, which keeps the star as it is."""
    with writing(spark, root) as tables:
        stage_results(spark, tables, params, inventory_snapshot)


def build_report(spark: SparkSession, stored: Tables, star: Star, params: Params = DEFAULTS) -> None:
    classified = stored.read("inventory_abc_xyz_analysis")
    master = stored.read("inventory_safety_stock_rop")
    routes = stored.read("otif_by_route")
    tables = {
        "kpi_cards": report.kpi_cards(delivery.overall_kpis(star), classify.az_sku_count(classified), params),
        "route_scorecard": report.route_scorecard(routes, params),
        "profit_erosion_report": report.profit_erosion_report(stored.read("late_cost_impact")),
        "monthly_report": report.monthly_report(stored.read("monthly_delivery_trends"), params),
        "heatmap_bands": report.heatmap_bands(routes, report.shipping_modes(routes), params),
        "nine_box_grid": classify.nine_box_grid(classified),
        "classification_roster": report.classification_roster(classified),
        "reorder_roster": report.reorder_roster(master),
        "sku_directive": report.sku_directive(master, params),
        "days_on_hand": report.days_on_hand(master),
    }
    write_all([partial(stored.write, plain(df), f"report_{name}") for name, df in tables.items()])


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    params: Params = DEFAULTS,
    inventory_snapshot: DataFrame | None = None,
    multiline: bool = False,
    append: bool = False,
) -> None:
    """Raw files to report tables as one load, and the named views over the stored tables. Readers see the load before until
    everything is written; if a step fails, they keep it. With ``append`` the files hold more lines for the last load."""
    raw = read_raw_orders(spark, raw_path, position=True, multiline=multiline)
    draft = new_draft(spark, root, keep=append)
    (append_star if append else stage_star)(raw, draft, params)
    stage_results(spark, draft, params, inventory_snapshot)
    publish(draft)
    register_stored_views(spark, root)
