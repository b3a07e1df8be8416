"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest

from checks.registry import queries
from tests.conftest import SMALL
from tests.frames import line, star
from tidelane.functions.lineage import shared_path
from tidelane.operators import classify, cleaning, delivery, inventory, quality, revenue
from tidelane.sources.store import by_month, read_star, write_star
from tidelane.star import Star

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark):
    root = shared_path(spark, "plans")
    write_star(star(spark, [line(i, product_id=i % 9, customer_id=i % 5) for i in range(50)]), root)
    return read_star(spark, root)


@pytest.fixture(scope="module")
def large(spark, stored):
    """The same star with automatic broadcasts off, as for dimensions beyond the threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scan_reads_only_what_a_query_needs(stored):
    text = plan(delivery.otif_by_route(stored))
    schema = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert len(schema) == 1
    assert set(re.findall(r"(\w+):", schema[0])) == {"market", "shipping_mode", "sales_amount", "profit_per_order", "days_scheduled", "days_real"} - {"profit_per_order"}


@pytest.mark.parametrize(
    "operator",
    [delivery.otif_by_route, delivery.late_cost_impact, delivery.lead_time_distribution],
)
def test_one_scan_and_one_shuffle(stored, operator):
    text = plan(operator(stored))
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 1
    assert "keys=[" not in text or "partial" in text


def test_copies_are_cut_before_the_shuffle(spark, stored):
    df = stored.fact.withColumn("_source_position", stored.fact.order_id)
    text = plan(cleaning.dedupe_order_items(df))
    limit, exchange = text.index("WindowGroupLimit"), text.index("Exchange")
    assert text.count("Partial\n") == 1 and limit < exchange


@pytest.mark.parametrize(
    "operator",
    [
        classify.product_revenue, revenue.product_weekly_demand, revenue.loss_making_products,
        inventory.route_lead_time, inventory.daily_demand, inventory.reorder_levels,
        lambda s: quality.dq_orphan_products(s.fact, s.products),
    ],
)
def test_lines_are_summed_before_a_join(large, operator):
    text = plan(operator(large))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "BroadcastHashJoin" not in text
    tree = text.split("\n\n")[0]
    fact = max(text.split("ReadSchema: "), key=lambda part: part.count("quantity_ordered"))
    assert fact
    joins = [len(re.match(r"[\s:|+-]*", row).group()) for row in tree.splitlines() if "Join" in row]
    sums = [len(re.match(r"[\s:|+-]*", row).group()) for row in tree.splitlines() if "HashAggregate" in row]
    assert joins and max(sums) > max(joins)


def test_no_registered_query_crosses_tables(spark):
    for name in ("category_revenue_ranked", "product_revenue_pareto", "inventory_master", "kpi_cards", "route_scorecard"):
        text = plan(queries()[name](spark, SMALL))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_months_are_rebalanced_before_the_write(stored):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(by_month(stored.fact))


def test_running_totals_collect_one_row_per_slice_only(large):
    """The one-task window sits on the slice totals, never on the products."""
    text = plan(classify.abc_classify(classify.product_revenue(large)))
    single = text.split("\n\n")[0].split("SinglePartition")
    assert len(single) <= 2
    details = [d for d in text.split("\n\n") if "SinglePartition" in d and "Arguments" in d]
    assert len(details) == 1 and "_slice" in details[0] and "product_id" not in details[0]


def test_no_query_runs_python_in_tasks(spark, large):
    text = plan(inventory.inventory_master(Star(large.fact, large.products, large.customers)))
    assert "Python" not in text and "Pandas" not in text
